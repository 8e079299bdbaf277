"""Access-dependent views: group lookup, column redaction, row policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_member(members: DataFrame, group: str, user: Column | None = None) -> Column:
    """Whether the querying user belongs to ``group``.

    ``members`` has the columns ``group_name`` and ``user_name``. The answer is an
    uncorrelated scalar subquery: Spark evaluates it once per query, at run time,
    so the same view gives different users different results.
    """
    who = F.current_user() if user is None else user
    rows = members.where((F.col("group_name") == group) & (F.col("user_name") == who))
    return rows.agg(F.count(F.lit(1)) > 0).scalar()


def redact(df: DataFrame, columns: list[str], allowed: Column, mask: str = "REDACTED") -> DataFrame:
    """Replace ``columns`` by ``mask`` unless ``allowed`` holds; column order is kept.

    A redacted column is text, whatever its type was, so that every reader gets the same schema.
    """
    return df.withColumns(
        {c: F.when(allowed, F.col(c).cast("string")).otherwise(F.lit(mask)) for c in columns}
    )


def row_policy(df: DataFrame, allowed: Column, condition: Column | str) -> DataFrame:
    """All rows when ``allowed`` holds, otherwise only those meeting ``condition``."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(F.when(allowed, F.lit(True)).otherwise(condition))
