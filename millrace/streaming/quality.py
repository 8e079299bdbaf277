"""Quality figures of running streams: rows that break rules, per micro-batch, and a stop above a rate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.session import read_if_present
from millrace.streaming.sinks import each_batch

_FIGURES = "batch BIGINT, rule STRING, all_rows BIGINT, broken BIGINT"


class RateExceeded(RuntimeError):
    """A micro-batch broke a rule more often than allowed."""


class WatchedStream:
    """Appends micro-batches to ``path/rows/batch=n`` and their figures to ``path/figures/batch=n``.

    ``rules`` maps names to SQL conditions (NULL passes). The rows are counted while they are written, by observed
    metrics, so no batch is read twice. ``most`` gives, per rule, the share of rows that may break it: a batch above it
    stays invisible and ends the stream with ``RateExceeded``. Its checkpoint has not moved on then, so the same
    rows are tried again by the next run, with other rules or limits if the caller chooses. A batch of less than
    ``least`` rows is not judged, as rates say little there.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, rules: Mapping[str, str],
                 most: Mapping[str, float] | None = None, least: int = 1):
        self.spark, self.path, self.rules, self.least = spark, path.rstrip("/"), dict(rules), least
        self.most = dict(most or {})
        self.schema = spark.createDataFrame([], schema).schema
        unknown = set(self.most) - set(self.rules)
        if unknown:
            raise ValueError(f"no rules {sorted(unknown)}")

    def _broken(self):
        return {name: F.count_if(~F.coalesce(F.expr(sql), F.lit(True))) for name, sql in self.rules.items()}

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        observed = batch.select(self.schema.fieldNames()).observe(
            seen, F.count(F.lit(1)).alias("_all"), *[count.alias(name) for name, count in self._broken().items()])
        observed.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        counts = seen.get
        if not counts["_all"]:
            return
        above = {name: counts[name] / counts["_all"] for name, share in self.most.items()
                 if counts["_all"] >= self.least and counts[name] > share * counts["_all"]}
        if above:
            raise RateExceeded(f"batch {batch_id} breaks rules too often: {above}")
        rows = [F.struct(F.lit(name).alias("rule"), F.lit(counts["_all"]).cast("long").alias("all_rows"),
                         F.lit(counts[name]).cast("long").alias("broken")) for name in self.rules]
        figures = self.spark.range(0, 1, 1, 1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        figures.write.mode("overwrite").parquet(f"{self.path}/figures/batch={batch_id}")

    def run(self, stream: DataFrame, checkpoint: str) -> DataFrame:
        """Take in what is new in the stream; returns the accepted rows so far."""
        each_batch(stream, self._write, checkpoint, reads=1)
        return self.rows()

    def figures(self) -> DataFrame:
        """(batch, rule, all_rows, broken) of accepted batches."""
        return read_if_present(self.spark, f"{self.path}/figures", _FIGURES).select("batch", "rule", "all_rows", "broken")

    def rows(self) -> DataFrame:
        """The rows of accepted batches: those that have figures."""
        names = self.schema.fieldNames()
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        rows = read_if_present(self.spark, f"{self.path}/rows", f"{ddl}, batch BIGINT")
        return rows.join(F.broadcast(self.figures().select("batch").distinct()), "batch", "left_semi").select(names)
