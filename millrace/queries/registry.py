"""The catalog of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.inputs import Tables
from millrace.session import apply_settings


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        apply_settings(spark)
        return self.build(Tables(spark, folder))


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function of ``Tables`` under its own name.

    ``covers`` lists rows of the operator inventory; ``sql`` gives the same result on
    the same tables.
    """

    def register(build: Callable[[Tables], DataFrame]):
        if build.__name__ in CATALOG:
            raise ValueError(f"query {build.__name__} exists already")
        CATALOG[build.__name__] = Query(build.__name__, covers, build, sql)
        return build

    return register
