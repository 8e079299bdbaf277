"""Line deduplication that can be taken back: reference counts per line, with cuckoo filters before them.

``LineIndex`` is a folder that grows by insertions and deletions of documents:

* ``entries/batch=n`` - which document holds which line, as (shard, key, doc_id); a key is a digest.
* ``removed/batch=n`` - documents deleted by a batch.
* ``counts/batch=n`` - the exact table: for keys that a batch touched, their number of documents and
  the largest of them; the newest row of a key holds, 0 documents means gone.
* ``filters/batch=n`` - per touched shard a cuckoo filter of the keys that some document holds.
* ``batches`` - one row per finished batch; what a batch wrote counts once its row is there, and a
  batch that did not finish is written over.

An insertion sums its own keys first, so a line of a third of all documents is one row per task. The
filter of a shard then tells which keys are certainly new: these need no look at the exact table, and
as most lines are new, few do. The others are joined with it, which settles false alarms. A deletion
finds its keys by the entries, looks for the next largest document only where the largest one
goes, and takes keys that no one holds any more out of the filters: that is why they are cuckoo
filters. The verdict depends on the documents that are there, not on the way they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import giving_back
from millrace.llm.common import registered, shuffle_partitions, table
from millrace.llm.cuckoo import CuckooFilter
from millrace.operators.latest import latest_per_key
from millrace.session import new_folder, read_if_present, written

#: Shortest line (code points) that can be repeated, and in how many documents it has to be.
SHORTEST, LEAST = 20, 3
#: Bytes of text for which an index gets one shard.
SHARD_BYTES = 32 << 20
#: Buckets of a filter's tables.
BUCKETS = 1 << 14

# fixed values: white space of lines, and the letters that are lowered
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = -(1 << 63)

_ENTRIES = "shard int, key binary, doc_id long"
_COUNTS = "shard int, key binary, refs long, largest long"
_FILTERS = "shard int, filter binary"
_BATCHES = "batch int, operation string"


def _document(doc_id: str):
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))


def _filtered(buckets: int, answer: bool):
    """Stream shards: the filter of a shard, then keys to look up (``answer``) or to add and remove."""
    schema = pa.schema([("shard", pa.int32()), ("key", pa.binary()), ("known", pa.bool_()), ("filter", pa.binary())])

    def keys_of(values: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(values), dtype="V16")

    def run(batches) -> Iterator[pa.RecordBatch]:
        shard, held = None, None

        def closed():
            return pa.RecordBatch.from_pylist([{"shard": shard, "key": None, "known": None, "filter": held.stored()}], schema=schema)

        for batch in batches:
            numbers, kinds = np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))
            cuts = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(numbers)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if numbers[i] != shard:
                    if shard is not None and not answer:
                        yield closed()
                    shard, held = int(numbers[i]), None
                part = batch.slice(i, j - i)
                if kinds[i] == 0:
                    held = CuckooFilter(buckets, part.column("filter")[0].as_py())
                    continue
                held = held or CuckooFilter(buckets)
                values = part.column("key").to_pylist()
                if answer:
                    yield pa.RecordBatch.from_arrays([
                        part.column("shard").cast(pa.int32()), pa.array(values, type=pa.binary()),
                        pa.array(held.contains(keys_of(values))), pa.nulls(len(values), pa.binary())], schema=schema)
                elif kinds[i] == 1:
                    held.add(keys_of(values))
                else:
                    held.remove(keys_of(values))
        if shard is not None and not answer:
            yield closed()

    return run


def _kept_lines():
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])

    def run(batches):
        import hashlib

        lower = str.maketrans(_UPPER, _LOWER)
        for batch in batches:
            done = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                lines = (text or "").split("\n")
                left = lines
                if gone:
                    gone = set(gone)
                    keys = (line.strip(_SPACE).translate(lower) for line in lines)
                    left = [line for line, key in zip(lines, keys) if len(key) < SHORTEST or hashlib.md5(key.encode()).digest() not in gone]
                done.append((len(lines), len(lines) - len(left), "\n".join(left)))
            columns = list(zip(*done)) if done else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, type=f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema)

    return run


class LineIndex:
    """Lines of a growing and shrinking set of documents; see the module text for its folders.

    Rows that share a doc_id are one document, and so are those without one, which comes before all others.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int, buckets: int = BUCKETS):
        self.spark, self.path, self.shards, self.buckets = spark, path.rstrip("/"), shards, buckets

    # -- reading ---------------------------------------------------------------

    def batches(self) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/batches", _BATCHES)

    def _newest(self) -> int:
        return self.batches().agg(F.max("batch")).first()[0] or 0

    def _read(self, name: str, schema: str) -> DataFrame:
        """What finished batches wrote; a refused one may have left folders that its successor has no use for."""
        wrote = {"entries": ["INSERT"], "removed": ["DELETE"]}.get(name, ["INSERT", "DELETE"])
        finished = self.batches().where(F.col("operation").isin(wrote)).select("batch")
        return read_if_present(self.spark, f"{self.path}/{name}", f"{schema}, batch int").join(finished, "batch", "left_semi")

    def entries(self) -> DataFrame:
        """(shard, key, doc_id) of the documents that are there."""
        removed = self._read("removed", "doc_id long").select(F.col("doc_id").alias("_id"), F.col("batch").alias("_batch"))
        live = self._read("entries", _ENTRIES)
        return live.join(removed, (F.col("doc_id") == F.col("_id")) & (F.col("batch") < F.col("_batch")), "left_anti").drop("batch")

    def counts(self) -> DataFrame:
        """(shard, key, refs, largest) of every line that some document holds."""
        return latest_per_key(self._read("counts", _COUNTS), ["key"], [F.col("batch").desc()]).where("refs > 0").drop("batch")

    def filters(self) -> DataFrame:
        return latest_per_key(self._read("filters", _FILTERS), ["shard"], [F.col("batch").desc()]).drop("batch")

    def repeated(self, least: int = LEAST) -> DataFrame:
        """(key, largest) of the lines that at least ``least`` documents hold."""
        return self.counts().where(F.col("refs") >= least).select("key", "largest")

    # -- changing --------------------------------------------------------------

    def _write(self, rows: DataFrame, name: str, batch: int) -> DataFrame:
        return written(rows, f"{self.path}/{name}/batch={batch}")

    def _finish(self, batch: int, operation: str) -> int:
        row = self.spark.range(0, 1, 1, 1).select(F.lit(batch).alias("batch"), F.lit(operation).alias("operation"))
        row.write.mode("append").parquet(f"{self.path}/batches")
        return batch

    def lines(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """(shard, key, doc_id), once for each long line a document holds."""
        line = F.translate(F.btrim("line", F.lit(_SPACE)), _UPPER, _LOWER)
        rows = docs.select(_document(doc_id).alias("doc_id"), F.explode(F.split(F.col(text).cast("string"), "\n")).alias("line"))
        rows = rows.select("doc_id", line.alias("line")).where(F.length("line") >= SHORTEST)
        keyed = rows.select(F.unhex(F.md5("line")).alias("key"), "doc_id").distinct()
        return keyed.select(F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard"), "key", "doc_id")

    def _through_filters(self, keys: DataFrame, answer: bool) -> DataFrame:
        """Send rows (shard, kind, key) to the filters of their shards."""
        filters = self.filters().select("shard", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), "filter")
        touched = keys.select("shard").distinct()
        rows = keys.select("shard", "kind", "key", F.lit(None).cast("binary").alias("filter")).unionByName(filters.join(touched, "shard", "left_semi"))
        dealt = rows.repartition(shuffle_partitions(self.spark), "shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(giving_back(_filtered(self.buckets, answer)), "shard int, key binary, known boolean, filter binary")

    def _update_filters(self, keys: DataFrame, batch: int) -> None:
        self._write(self._through_filters(keys, answer=False).select("shard", "filter"), "filters", batch)

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> int:
        """Add documents, whose ids must be new; returns the number of the batch."""
        newest = self._newest()
        batch = newest + 1
        new = self._write(self.lines(docs, text, doc_id), "entries", batch)
        if newest:
            present = new.select("doc_id").distinct().join(self.entries(), "doc_id", "left_semi").first()
            if present is not None:
                raise ValueError(f"document {present[0]} is there already")
        sums = new.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("more"), F.max("doc_id").alias("newest"))
        if not newest:
            fresh = self._write(sums.select("shard", "key", F.col("more").alias("refs"), F.col("newest").alias("largest")), "counts", batch)
        else:
            sums = written(sums, new_folder(self.spark, "line-sums"))
            told = self._through_filters(sums.withColumn("kind", F.lit(1)), answer=True)
            maybe = told.where("known").select("key")
            found = self.counts().join(maybe, "key", "left_semi").select("key", "refs", "largest")
            counts = self._write(sums.join(found, "key", "left").select(
                "shard", "key", (F.coalesce("refs", F.lit(0)) + F.col("more")).alias("refs"),
                F.greatest("largest", "newest").alias("largest")), "counts", batch)
            fresh = counts.join(sums, "key").where("refs = more").select(counts["shard"], "key")
        self._update_filters(fresh.select("shard", "key", F.lit(1).alias("kind")), batch)
        return self._finish(batch, "INSERT")

    def delete(self, docs: DataFrame, doc_id: str = "doc_id") -> int:
        """Take documents out again, as if they had never been inserted; unknown ids do nothing."""
        batch = self._newest() + 1
        gone = written(docs.select(_document(doc_id).alias("doc_id")).distinct(), new_folder(self.spark, "gone"))
        live = self.entries()
        less = live.join(gone, "doc_id", "left_semi").groupBy("shard", "key").agg(F.count(F.lit(1)).alias("less"), F.max("doc_id").alias("highest"))
        changed = written(less.join(self.counts().drop("shard"), "key"), new_folder(self.spark, "line-changes"))
        orphaned = changed.where("highest = largest AND refs > less").select("key")
        heirs = live.join(orphaned, "key", "left_semi").join(gone, "doc_id", "left_anti").groupBy("key").agg(F.max("doc_id").alias("heir"))
        counts = changed.join(heirs, "key", "left").select("shard", "key", (F.col("refs") - F.col("less")).alias("refs"),
                                                           F.coalesce("heir", "largest").alias("largest"))
        counts = self._write(counts, "counts", batch)
        self._update_filters(counts.where("refs = 0").select("shard", "key", F.lit(2).alias("kind")), batch)
        self._write(gone, "removed", batch)
        return self._finish(batch, "DELETE")

    # -- applying --------------------------------------------------------------

    def without_repeats(self, docs: DataFrame, least: int = LEAST, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept) of documents that are in the index, one row per input row.

        A line goes if at least ``least`` documents of the index hold it and one with a larger id does. Null and empty
        texts are one empty line; short lines stay. Other columns are ignored.
        """
        repeated = written(self.repeated(least), new_folder(self.spark, "repeated-lines"))  # its size decides on the join
        gone = self.entries().join(repeated, "key").where("doc_id < largest")
        gone = gone.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("key").alias("gone"))  # at most the lines of one document
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        joined = rows.join(gone, _document("doc_id") == F.col("_id"), "left").select("doc_id", "text", "gone")
        return joined.mapInArrow(giving_back(_kept_lines()), "doc_id long, n_lines long, n_dropped long, kept string")


def new_index(docs: DataFrame, text: str = "text") -> LineIndex:
    """An empty index with shards for about as much text as ``docs`` has."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return LineIndex(spark, new_folder(spark, "line-index"), max(shuffle_partitions(spark), -(-size // SHARD_BYTES)))


_SQL = f"""
WITH l AS (
  SELECT doc_id, line, i, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)
), k AS (
  SELECT key, max(doc_id) AS largest FROM l WHERE length(key) >= {SHORTEST} GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST}
), j AS (
  SELECT l.*, coalesce(doc_id < largest, FALSE) AS gone FROM l LEFT JOIN k USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@registered(_SQL)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, inserted into a new index, without their repeated lines."""
    docs = table(spark, folder, "documents")
    index = new_index(docs)
    index.insert(docs)
    out = index.without_repeats(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
