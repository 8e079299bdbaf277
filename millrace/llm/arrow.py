"""Rows made in Python tasks, as Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def give_back() -> None:
    """Return freed memory to the system, at the end of a task: its process goes on to other tasks beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """A function of batches that returns its memory when the task is over."""

    def through(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return through


def batches_of(rows: Iterator[dict], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most 4,096 rows, closed once their strings and bytes pass ``most``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
        if size > most or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def rows_where(df: DataFrame, wanted: Callable[[], Callable[[pa.RecordBatch], list[bool]]]) -> DataFrame:
    """The rows of ``df`` for which a test made once per task says so, with all their columns as they are."""

    def run(batches):
        test = wanted()
        for batch in batches:
            yield batch.filter(pa.array(test(batch), type=pa.bool_()))

    return df.mapInArrow(giving_back(run), df.schema)
