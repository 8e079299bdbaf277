"""Ways to end a stream. Unless said otherwise they run what is available and then return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.operators.tables import replace_table
from millrace.session import STORED


def run_available_now(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Start ``writer``, wait until all present data is processed, return the ended query."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_every(writer: DataStreamWriter, checkpoint: str, interval: str) -> StreamingQuery:
    """Start ``writer`` with a batch every ``interval`` and return the running query."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def append_to(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> DataFrame:
    """Append the stream to a parquet folder; returns that folder as a batch frame.

    A partitioned write is rebalanced: each micro-batch is shuffled by the partition columns, its bytes are counted
    for every value, and adaptive planning, which Spark also does for streams without state, gives a large value as
    many tasks as its bytes need and joins the small ones. A small value that shares a shuffle partition with a large
    one is dealt out along with it.
    """
    dealt = stream.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else stream
    writer = dealt.writeStream.outputMode("append").format("parquet").options(path=path, **STORED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    run_available_now(writer, checkpoint)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", reads: int = 2) -> StreamingQuery:
    """Run ``write(micro_batch, batch_id)`` for every micro-batch that has rows.

    A ``write`` that reads its micro-batch once says so by ``reads=1``: nothing is kept or counted for it then, and
    it gets empty micro-batches too.

    The micro-batch is kept for the duration of the call, since upserts read it more
    than once; a lost copy is recomputed from the stream's logged offsets. Counting it
    first moves the stream's state on even if ``write`` skips a replayed batch, and
    tells the planner how small it is. Streams with state switch adaptive planning off
    for their own plan; the batch plans inside ``write`` get it back, so that they can
    split hot partitions.
    """

    def keep_and_write(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        adaptive = conf.get("spark.sql.adaptive.enabled")
        if reads > 1:
            batch.persist()
        try:
            if reads == 1 or batch.count():
                conf.set("spark.sql.adaptive.enabled", "true")
                write(batch, batch_id)
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)
            batch.unpersist()

    return run_available_now(stream.writeStream.outputMode(mode).foreachBatch(keep_and_write), checkpoint)


def complete_writer(stream: DataFrame, name: str, folder: str) -> DataStreamWriter:
    """A writer that overwrites the table ``name`` with the full result of a streaming aggregate.

    The snapshot is named after the batch, so a replayed batch writes over itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_table(batch, name, folder, snapshot=f"{batch_id:012d}", spark=stream.sparkSession)

    return stream.writeStream.outputMode("complete").foreachBatch(write)


def complete_to(stream: DataFrame, name: str, folder: str, checkpoint: str) -> DataFrame:
    """Bring the table ``name`` up to date with a streaming aggregate and return it."""
    run_available_now(complete_writer(stream, name, folder), checkpoint)
    return stream.sparkSession.table(name)


def stop_all(spark: SparkSession) -> int:
    """Stop every running query of the session; returns how many there were."""
    active = spark.streams.active
    for query in active:
        query.stop()
        query.awaitTermination()
    return len(active)
