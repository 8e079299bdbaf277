"""Settings and small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import SETTINGS, new_folder, written

#: Texts in one Arrow batch; small, as one text may be long.
BATCH_ROWS = 128
#: Bytes of a batch, after which it is closed.
BATCH_BYTES = 4 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Session settings of these operators: adaptive plans, and small Arrow batches as texts can be long."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def registered(sql: str | None = None):
    """Register a function of (spark, folder) as a query under its own name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return build(spark, folder)

        run.__name__, run.__doc__, run.covers = build.__name__, build.__doc__, ""
        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, so that it is computed once."""
    return written(df, new_folder(df.sparkSession, name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
