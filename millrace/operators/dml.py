"""UPDATE, DELETE and insert-only statements as DataFrame functions.

They return the table's new content; nothing is changed in place. A predicate
that is NULL for a row leaves that row alone, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def update_rows(df: DataFrame, assignments: dict[str, Column | str], where: Column | str) -> DataFrame:
    """``UPDATE df SET ... WHERE where``; every right-hand side sees the old row."""
    hit = _column(where)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: F.when(hit, _column(value).cast(types[name])).otherwise(F.col(name))
            for name, value in assignments.items()
        }
    )


def delete_rows(df: DataFrame, where: Column | str) -> DataFrame:
    """``DELETE FROM df WHERE where``."""
    return df.where(~F.coalesce(_column(where), F.lit(False)))


def delete_matching(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE FROM df WHERE keys IN (SELECT keys FROM doomed)``."""
    return df.join(doomed.select(keys), keys, "left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: the target plus the source rows whose key it lacks."""
    return target.unionByName(rows_not_in(source, target, keys).select(target.columns))


def rows_not_in(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key does not occur in ``target``.

    The target is first cut to the keys the source asks for: Spark broadcasts those of a
    small batch, so a large target is only scanned; when both are large, the second
    join finds both sides partitioned by the key already.
    """
    present = target.select(keys).join(source.select(keys), keys, "left_semi")
    return source.join(present, keys, "left_anti")
