"""Joins with a streaming side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from millrace.operators.joins import salted_join
from millrace.session import STORED, read_if_present
from millrace.streaming.sinks import each_batch


def stream_static_join(stream: DataFrame, static: Callable[[], DataFrame], on: Column | list[str],
                       path: str, checkpoint: str, how: str = "inner") -> DataFrame:
    """Join each micro-batch with the static side as it is at that moment; append to ``path``.

    ``static`` is called once per micro-batch, so changes by any writer are seen. Only
    new stream rows produce output, and rows without a partner are not kept (see
    ``missed_rows``). Each batch writes its own sub-folder, so a replay writes over it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.join(static(), on, how).write.mode("overwrite").options(**STORED).parquet(f"{path}/batch={batch_id}")

    each_batch(stream, write, checkpoint, reads=1)
    schema = stream.join(static(), on, how).schema
    return read_if_present(stream.sparkSession, path, schema).select(schema.fieldNames())


def stream_stream_join(left: DataFrame, right: DataFrame, keys: list[str], salt_from: list[str] | None = None,
                       salts: int = 16, left_watermark: tuple[str, str] | None = None,
                       right_watermark: tuple[str, str] | None = None,
                       time_bound: Column | None = None) -> DataFrame:
    """Inner equi join of two streams.

    Both sides are kept as state so that any later row can meet an earlier one. The
    state only stays bounded with watermarks and a ``time_bound`` between the two event
    times. ``salt_from`` names left columns whose hash spreads a hot key.
    """
    if left_watermark:
        left = left.withWatermark(*left_watermark)
    if right_watermark:
        right = right.withWatermark(*right_watermark)
    if salt_from:
        joined = salted_join(left, right, keys, salt_from, salts)
    else:
        joined = left.join(right, keys, "inner")
    return joined if time_bound is None else joined.where(time_bound)
