"""Deduplication within, between and beyond micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import STORED, read_if_present
from millrace.streaming.sinks import each_batch


def dedup_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str = "30 seconds",
                 salt_from: list[str] | None = None, salts: int = 16) -> DataFrame:
    """One row per key, with state bounded by a watermark on ``event_time``.

    ``keys`` must contain the event time, so that expired state can go. With
    ``salt_from`` - columns that differ between copies, such as a message offset - a key
    with very many copies is first reduced on ``salts`` partitions in parallel.
    """
    if event_time not in keys:
        raise ValueError("the event time must be one of the keys")
    marked = stream.withWatermark(event_time, delay)
    if salt_from:
        salt = F.pmod(F.xxhash64(*salt_from), F.lit(salts))
        marked = marked.withColumn("_salt", salt).dropDuplicates([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicates(keys)


def dedup_within(stream: DataFrame, keys: list[str], event_time: str, delay: str = "30 seconds") -> DataFrame:
    """One row per key among rows whose event times lie within ``delay`` of the first one.

    The event time need not be a key, so copies may carry other times than their firsts. State is bounded by the
    watermark; the result does not depend on how rows are cut into micro-batches, as long as none comes later than ``delay``.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def _range_filter(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Target rows within the batch's range of ``column``, as a filter the scan can use."""
    low, high = batch.agg(F.min(column), F.max(column)).first()
    return target.where(F.col(column).between(F.lit(low), F.lit(high)))


def dedup_upsert(stream: DataFrame, path: str, schema, keys: list[str], checkpoint: str,
                 event_time: str | None = None) -> DataFrame:
    """Append rows whose key is neither repeated in the stream nor in the table at ``path``.

    Each micro-batch is reduced to one row per key (a partial step runs before the
    shuffle) and anti-joined with the table. ``event_time``, if it is one of the keys,
    limits the part of the table that is looked at to the batch's own time range.
    A replayed micro-batch finds its rows present and adds nothing. The batch stands in the
    plan once: a second copy of one that comes out of state is not read from what is kept, but
    made again, with all of its state.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        present = read_if_present(spark, path, schema)
        if event_time in keys:
            present = _range_filter(present, batch, event_time)
        fresh = batch.dropDuplicates(keys).join(present.select(keys), keys, "left_anti")
        fresh.select(present.columns).write.mode("append").options(**STORED).parquet(path)

    each_batch(stream, write, checkpoint)
    return read_if_present(spark, path, schema)
