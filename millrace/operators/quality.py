"""Row constraints: adding, enforcing on write, quarantine, assertions.

A set of constraints is a plain dict from name to ``Check``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckViolation(ValueError):
    """Existing rows do not satisfy a constraint."""


@dataclass(frozen=True)
class Check:
    """A named condition. NULL passes, as in SQL, unless ``strict``."""

    name: str
    condition: str
    strict: bool = False

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(not self.strict))


def not_null(column: str) -> Check:
    return Check(f"{column}_not_null", f"`{column}` IS NOT NULL", strict=True)


def violations(df: DataFrame, check: Check) -> DataFrame:
    """Rows that break ``check``."""
    return df.where(check.violated())


def add_check(df: DataFrame, checks: dict[str, Check], check: Check) -> dict[str, Check]:
    """``checks`` with one more, after verifying that every existing row satisfies it."""
    if check.name in checks:
        raise ValueError(f"constraint {check.name} exists already")
    bad = violations(df, check).count()
    if bad:
        raise CheckViolation(f"{bad} rows violate the new CHECK constraint ({check.condition})")
    return checks | {check.name: check}


def drop_check(checks: dict[str, Check], name: str) -> dict[str, Check]:
    if name not in checks:
        raise KeyError(f"no constraint {name}")
    return {k: c for k, c in checks.items() if k != name}


def enforce(df: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """``df`` with the constraints built into its plan.

    Any violating row fails the job that evaluates it, so a write of the result
    commits either all rows or none.
    """
    guard = F.lit(True)
    for check in checks.values():
        message = F.lit(f"CHECK constraint {check.name} ({check.condition}) violated")
        guard = F.when(check.violated(), F.raise_error(message)).otherwise(guard)
    return df.where(guard)


def with_failed_checks(df: DataFrame, checks: dict[str, Check]) -> DataFrame:
    """``df`` plus ``failed_checks``, the names of the constraints a row breaks."""
    names = [F.when(c.violated(), F.lit(c.name)) for c in checks.values()]
    return df.withColumn("failed_checks", F.array_compact(F.array(*names)))


def split_valid(df: DataFrame, checks: dict[str, Check]) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``failed_checks``)."""
    marked = with_failed_checks(df, checks)
    good = marked.where(F.size("failed_checks") == 0).drop("failed_checks")
    return good, marked.where(F.size("failed_checks") > 0)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of rows and number of distinct keys.

    Two counting steps, the first with a partial count before its shuffle, so a
    key with very many copies is reduced to one row per task on the way.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("key_count")
    )


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    rows, distinct = key_counts(df, keys).first()
    if rows != distinct:
        raise AssertionError(f"{rows} rows but {distinct} distinct {keys}")
