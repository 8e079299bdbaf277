"""Full replacement of a named table while readers keep going."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, name: str, folder: str, snapshot: str | None = None,
                  spark: SparkSession | None = None) -> str:
    """``CREATE OR REPLACE TABLE name AS df`` on parquet.

    Writes a new snapshot below ``folder`` and then points the table ``name`` at it, so INSERT
    statements work on it like on any table. A failed write leaves the table as it was,
    earlier snapshots stay readable under their paths (``snapshots``), and ``df`` may read
    ``name`` itself. Only a change of the columns drops the name for a moment. Sessions keep
    what they know about a table: from within a micro-batch, give the session that reads it.
    """
    spark = spark or df.sparkSession
    path = f"{folder.rstrip('/')}/snapshot={snapshot or f'{time.time_ns()}-{uuid.uuid4().hex[:8]}'}"
    df.write.mode("overwrite").parquet(path)
    if spark.catalog.tableExists(name) and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet", schema=df.schema)
    return path


def snapshots(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Rows and time of every snapshot below ``folder``, oldest first by name."""
    rows = spark.read.schema(schema).option("basePath", folder).parquet(folder)
    return rows.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("snapshot")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max("_metadata.file_modification_time").alias("written_at"))
