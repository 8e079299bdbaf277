"""Rows behind the watermark are kept aside instead of being dropped.

A stateful step of Spark drops rows that come too late and only counts them. ``LateSplit`` stands before it and
parts each micro-batch by a mark, the newest event time of all earlier micro-batches less the delay:

* ``changes/_commit_version=n`` - rows of micro-batch n - 1 that are on time;
* ``late/version=n`` - those that are not;
* ``commits`` - a row per finished micro-batch with its counts, and the newest event time so far.

The rows on time are streamed on by commit, so a micro-batch that failed half-way and is written again is
delivered once. A watermark of the same delay on that stream never passes one of its rows: whatever micro-batches it
is cut into, those before a row hold nothing newer than what the row's mark was made of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import read_if_present
from millrace.sources.versions import VERSION, version_stream
from millrace.streaming.sinks import each_batch

_COMMITS = "version BIGINT, is_base BOOLEAN, all_rows BIGINT, late_rows BIGINT, newest BIGINT"


class RowsDropped(RuntimeError):
    """A stateful step dropped rows behind its watermark."""


def dropped_rows(query: StreamingQuery) -> int:
    """How many rows the stateful steps of ``query`` dropped, in the micro-batches it still reports."""
    return sum(state.numRowsDroppedByWatermark for p in query.recentProgress for state in p.stateOperators)


class LateSplit:
    """Parts a stream by ``event_time``; ``delay`` is that of the watermark behind it.

    A row without an event time is on time, as is every row of the first micro-batch. A row exactly at the mark is on time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, event_time: str, delay: str = "10 minutes"):
        self.spark, self.path, self.event_time, self.delay = spark, path.rstrip("/"), event_time, delay
        self.schema = spark.createDataFrame([], schema).schema
        self._delay = F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {delay})")

    def _time(self) -> Column:
        return F.unix_micros(F.col(self.event_time).cast("timestamp"))

    def _commits(self) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/commits", _COMMITS)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        reached, newest = self._commits().agg(F.max("version"), F.max("newest")).first()
        if reached is not None and reached >= version:
            return  # a replay of what is committed
        late = F.coalesce(self._time() < F.lit(newest).cast("long") - self._delay, F.lit(False))
        rows, seen = batch.select(self.schema.fieldNames()), Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(late).alias("late"), F.max(self._time()).alias("newest"))
        counted.where(~late).write.mode("overwrite").parquet(f"{self.path}/changes/{VERSION}={version}")
        rows.where(late).write.mode("overwrite").parquet(f"{self.path}/late/version={version}")
        counts = seen.get
        values = [version, False, counts["all"], counts["late"], max((n for n in (counts["newest"], newest) if n is not None), default=None)]
        names = self.spark.createDataFrame([], _COMMITS).schema
        commit = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, names)])
        commit.write.mode("append").parquet(f"{self.path}/commits")

    def run(self, stream: DataFrame, checkpoint: str) -> DataFrame:
        """Part what is new in the stream; returns ``figures()``."""
        each_batch(stream, self._write, checkpoint)
        return self.figures()

    def on_time_stream(self) -> DataFrame:
        """The rows on time as a stream that has the watermark; follow it with any stateful step."""
        return version_stream(self.spark, self.path, self.schema).withWatermark(self.event_time, self.delay)

    def late(self) -> DataFrame:
        """The rows that came too late."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        rows = read_if_present(self.spark, f"{self.path}/late", f"{ddl}, version BIGINT")
        done = self._commits().select("version")  # one row for each micro-batch
        return rows.join(F.broadcast(done), "version", "left_semi").select(self.schema.fieldNames())

    def figures(self) -> DataFrame:
        """(version, all_rows, late_rows) of finished micro-batches."""
        return self._commits().select("version", "all_rows", "late_rows")

    def check(self, query: StreamingQuery) -> None:
        """Raise if ``query``, which ends ``on_time_stream``, dropped rows all the same."""
        dropped = dropped_rows(query)
        if dropped:
            raise RowsDropped(f"{dropped} rows of {self.path} were dropped behind the watermark")
