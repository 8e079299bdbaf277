"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more shuffle later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a commit of RocksDB state writes what changed; whole stores, 200 and more of them, are copied in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # for new checkpoints; older ones note the codec that they began with
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITION_BYTES = 128 << 20
UNSET_PARTITIONS = "200"
# what a flow keeps: half of Spark's default codec, for about the same time
STORED = {"compression": "zstd"}
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# file streams skip files older than this next to the newest; back-fills may have any date
ANY_AGE = "36500d"

_local_roots: dict[str, str] = {}


def cluster_settings(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    Shuffle partitions start at 128 MB each, so that a task's share fits in memory, and
    adaptive execution joins the small ones. Streaming state goes to disk-backed stores;
    their number is fixed when a checkpoint is first used, so set this before.
    """
    partitions = max(200, -(-shuffle_bytes // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    }


def apply_settings(spark: SparkSession) -> None:
    """Give a session made elsewhere the library's settings.

    Its number of shuffle partitions is only touched if nobody has chosen one: one per
    core in local mode, three per core on a cluster with many.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if not spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)  # state on disk, not in the heap
    if spark.conf.get("spark.sql.shuffle.partitions") == UNSET_PARTITIONS:
        context = spark.sparkContext
        cores = context.defaultParallelism
        wanted = cores if context.master.startswith("local") else max(int(UNSET_PARTITIONS), 3 * cores)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a fresh
    temporary folder. On a cluster a missing setting is an error, because a
    machine-local folder would lose data with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="millrace-")
    return _local_roots[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared root that no earlier run has used."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an execution go as it ends; otherwise they stay until the driver collects garbage.

    Streams started within it do so for each micro-batch. For code that runs no frame twice: its shuffles would be made again.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def written(df: DataFrame, path: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to ``path`` and reading it back."""
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def emptied(spark: SparkSession, path: str) -> None:
    """Give back the room of an intermediate that nothing will read any more; the parquet folder at ``path`` stays, without rows."""
    spark.createDataFrame([], spark.read.parquet(path).schema).coalesce(1).write.mode("overwrite").parquet(path)


def read_if_present(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The parquet folder at ``path``, or an empty frame before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
