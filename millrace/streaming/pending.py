"""A stream-static join whose unmatched rows wait for their partner.

Below ``path``:

* ``result/batch=n`` - joined rows of micro-batch n, and ``result/repair=m`` those of repair m;
* ``pending/batch=n/bucket=b`` - rows of micro-batch n without a partner, by a hash of their key;
* ``resolved/repair=m`` - keys that repair m found, and the newest micro-batch it looked at.

A repair is given the new static rows only. It reads the buckets their keys fall in, not the stream's
table and not the result. Batches and repairs write folders of their own, so a replay writes over itself;
a repair counts once its row in ``repairs`` is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import checked_broadcast
from millrace.session import read_if_present, written
from millrace.streaming.sinks import each_batch

_REPAIRS = "repair BIGINT, upto BIGINT"


class PendingJoin:
    """An inner equi join of a stream with a static table that grows; both sides have the columns ``keys``.

    NULL keys have no partner and do not wait. ``buckets`` is fixed when the folder is first used.
    """

    def __init__(self, spark: SparkSession, path: str, stream_schema: str, static_schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        empty = spark.createDataFrame([], stream_schema), spark.createDataFrame([], static_schema)
        self.waiting = empty[0].schema
        self.joined = empty[0].join(empty[1], self.keys, "inner").schema

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def run(self, stream: DataFrame, static: Callable[[], DataFrame], checkpoint: str) -> DataFrame:
        """Join what is new in the stream with the static side as it is now; returns the result so far."""

        def write(batch: DataFrame, batch_id: int) -> None:
            found = static()
            batch.join(found, self.keys, "inner").select(self.joined.fieldNames()).write.mode("overwrite").parquet(
                f"{self.path}/result/batch={batch_id}")
            alone = batch.dropna(subset=self.keys).join(found.select(self.keys), self.keys, "left_anti")
            alone.select(self.waiting.fieldNames()).withColumn("bucket", self._bucket()).write.mode("overwrite").partitionBy(
                "bucket").parquet(f"{self.path}/pending/batch={batch_id}")

        each_batch(stream, write, checkpoint)
        return self.result()

    def _repairs(self) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/repairs", _REPAIRS)

    def pending(self, buckets: list[int] | None = None) -> DataFrame:
        """Rows that still wait, with ``batch`` and ``bucket``; ``buckets`` limits the folders that are read."""
        rows = read_if_present(self.spark, f"{self.path}/pending", f"{_ddl(self.waiting)}, batch BIGINT, bucket INT")
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        done = self._repairs().select("repair")
        resolved = read_if_present(self.spark, f"{self.path}/resolved", f"{_ddl(self.waiting, self.keys)}, upto BIGINT, repair BIGINT")
        resolved = resolved.join(F.broadcast(done), "repair", "left_semi")  # one row for each repair
        named = resolved.select(*[F.col(k).alias(f"_{k}") for k in self.keys], "upto")
        same = F.col("batch") <= F.col("upto")
        for k in self.keys:
            same = same & (F.col(k) == F.col(f"_{k}"))
        return rows.join(named, same, "left_anti")

    def repair(self, new_static: DataFrame) -> int:
        """Join waiting rows with static rows that are new since the last repair; returns the repair's number.

        Also right with static rows that were there before: rows wait only for keys that had no partner.
        """
        number = (self._repairs().agg(F.max("repair")).first()[0] or 0) + 1
        asked = new_static.select(self.keys).dropna().distinct()
        buckets = [r[0] for r in asked.select(self._bucket().alias("b")).distinct().collect()]  # at most self.buckets
        rows = self.pending(buckets)
        found = written(rows.join(checked_broadcast(new_static), self.keys, "inner").select(*self.joined.fieldNames(), "batch"),
                        f"{self.path}/found/repair={number}")
        found.select(self.joined.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/result/repair={number}")
        newest = found.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
        keys = found.select(*self.keys).distinct().withColumn("upto", F.lit(newest).cast("long"))
        keys.write.mode("overwrite").parquet(f"{self.path}/resolved/repair={number}")
        row = self.spark.range(0, 1, 1, 1).select(F.lit(number).cast("long").alias("repair"), F.lit(newest).cast("long").alias("upto"))
        row.write.mode("append").parquet(f"{self.path}/repairs")
        return number

    def result(self) -> DataFrame:
        """All joined rows, of micro-batches and of finished repairs."""
        names = self.joined.fieldNames()
        rows = read_if_present(self.spark, f"{self.path}/result/batch=*", self.joined)
        repairs = [r[0] for r in self._repairs().select("repair").collect()]  # one row for each repair
        for number in repairs:
            rows = rows.unionByName(self.spark.read.schema(self.joined).parquet(f"{self.path}/result/repair={number}"))
        return rows.select(names)


def _ddl(schema, only: list[str] | None = None) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if only is None or f.name in only)
