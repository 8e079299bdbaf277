"""Token ids as files of Huffman-coded blocks.

Canonical Huffman codes of at most ``MAX_BITS`` bits come from the corpus's id counts; only the
code lengths are stored. A block holds whole documents, can be decoded alone, and has the bit
offset of every ``STEP``-th id, so that a decoder runs over all checkpoints of a block at once,
one table look-up an id. Blocks lie in ascending order of doc_id over the part files.

A folder has two Parquet data sets, as Spark's writers reach any store: ``codebook`` (lengths)
and ``blocks`` (part, block, ids_before, n_ids, docs, sizes, checkpoints, payload).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import batches_of, giving_back
from millrace.llm.common import kept, new_folder, registered, shuffle_partitions, table
from millrace.llm.tokens import crc, default_vocabulary, encoder, packed, unpacked

MAX_BITS = 18
STEP = 512
#: Ids after which a block is closed; a single longer document makes a longer block.
BLOCK_IDS = 1 << 18

_TOKENS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
_BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("ids_before", pa.int64()), ("n_ids", pa.int64()),
    ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("checkpoints", pa.binary()), ("payload", pa.binary()),
])
_BLOCKS_DDL = ("part int, block long, ids_before long, n_ids long, docs array<long>, sizes array<long>, "
               "checkpoints binary, payload binary")


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """The optimal code length of each symbol, none above ``most``; 0 for symbols that don't occur.

    Package-merge: the coins of a level are the symbols and the pairs of the level below; a
    symbol's length is the number of chosen coins it is in. Coins carry, instead of lists of
    symbols, how many of the level's symbols are among the first ones taken.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols don't fit codes of {most} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    levels, pairs = [], np.empty(0)
    for _ in range(most):
        coins = np.concatenate([weights, pairs])
        order = np.argsort(coins, kind="stable")
        levels.append(order < len(weights))  # whether the coin is a symbol of its own
        coins = coins[order]
        pairs = coins[:len(coins) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(used) - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        lengths[used[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


class Codebook:
    """Canonical codes: shorter ones first, equal lengths by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        order = np.lexsort((np.arange(len(lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        spans = 1 << (self.bits - self.lengths[order])
        begins = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = (begins >> (self.bits - self.lengths[order])).astype(np.uint64)
        self.symbols = np.repeat(order, spans).astype(np.uint32)
        self.symbols = np.pad(self.symbols, (0, (1 << self.bits) - len(self.symbols)))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Bit offsets of every STEP-th id, and the bits, most significant first."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = ends - sizes
        if not len(ids):
            return at, b""
        words = np.zeros(int(ends[-1]) // 64 + 2, dtype=np.uint64)
        word, room = at >> 6, 64 - (at & 63)
        over = sizes - room
        codes = self.codes[ids]
        here = np.where(over > 0, codes >> np.maximum(over, 0).astype(np.uint64), codes << np.maximum(-over, 0).astype(np.uint64))
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[firsts]] = np.bitwise_or.reduceat(here, firsts)
        split = np.flatnonzero(over > 0)
        words[word[split] + 1] |= codes[split] << (64 - over[split]).astype(np.uint64)
        return at[::STEP], words.astype(">u8").tobytes()[:(int(ends[-1]) + 7) // 8]

    def decode(self, n: int, checkpoints: np.ndarray, payload: bytes) -> np.ndarray:
        data = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.uint32)
        ahead = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        out = np.zeros((len(checkpoints), STEP), dtype=np.uint32)
        at, mask = checkpoints.astype(np.int64).copy(), np.uint32((1 << self.bits) - 1)
        left = n - STEP * np.arange(len(checkpoints))
        for k in range(min(STEP, n)):
            lanes = slice(None) if k < left[-1] else slice(0, len(checkpoints) - 1)
            here = at[lanes]
            found = self.symbols[(ahead[here >> 3] >> (32 - self.bits - (here & 7)).astype(np.uint32)) & mask]
            out[lanes, k] = found
            at[lanes] += self.lengths[found]
        return out.ravel()[:n]


def tokens(docs: DataFrame, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n, ids): the ids of each whole text and the end id, compressed for the way."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            ids, first = encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(first), type=pa.int64()),
                pa.array([packed(ids[a:b]) for a, b in zip(first[:-1], first[1:])], type=pa.binary()),
            ], schema=_TOKENS)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        giving_back(run), "doc_id long, n long, ids binary")


def _histogram(batches):
    counts = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        ids = np.concatenate([unpacked(x) for x in batch.column("ids").to_pylist()]) if len(batch) else np.empty(0, dtype=np.uint32)
        got = np.bincount(ids, minlength=len(counts))
        counts = np.pad(counts, (0, max(0, len(got) - len(counts)))) + np.pad(got, (0, max(0, len(counts) - len(got))))
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int64()), pa.array(counts[used], type=pa.int64())], names=["id", "count"])


def _written_blocks(lengths: np.ndarray):
    def rows(batches):
        book, part = Codebook(lengths), TaskContext.get().partitionId()
        number, before, held, docs, size = 0, 0, [], [], 0

        def block() -> dict:
            ids = np.concatenate(held)
            checkpoints, payload = book.encode(ids)
            return {"part": part, "block": number, "ids_before": before, "n_ids": len(ids), "docs": docs,
                    "sizes": [len(h) for h in held], "checkpoints": checkpoints.astype("<u8").tobytes(), "payload": payload}

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                ids = unpacked(ids)
                held.append(ids)
                docs.append(doc)
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    number, before, held, docs, size = number + 1, before + size, [], [], 0
        if held:
            yield block()

    return lambda batches: batches_of(rows(batches), _BLOCKS)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write the ids of all texts, each with the end id, in ascending order of doc_id.

    Null and empty texts are the end id alone. Rows with the same id lie next to each other in the
    order of their ids' checksum; null ids come first. Other columns are ignored. An empty table makes a codebook without codes.
    """
    spark = docs.sparkSession
    coded = kept(tokens(docs, vocabulary, text, doc_id), "tokens")
    counted = coded.mapInArrow(_histogram, "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, dtype=np.int64)  # bounded by the vocabulary
    for r in counted:
        counts[r["id"]] = r["count"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{folder}/codebook")
    tie = F.crc32("ids")
    ordered = coded.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(_written_blocks(lengths), _BLOCKS_DDL).write.option("compression", "none").parquet(f"{folder}/blocks")


def _decoded(spark: SparkSession, folder: str, field: str, value) -> DataFrame:
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/codebook").first()["lengths"], dtype=np.uint8)
    blocks = spark.read.schema(_BLOCKS_DDL).parquet(f"{folder}/blocks")
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a number for each part file
    begins, before = {}, 0
    for part in sorted(totals):
        begins[part], before = before, before + totals[part]
    kind = pa.list_(pa.uint32()) if field.endswith("array<long>") else pa.int64()

    def run(batches):
        book = Codebook(lengths)
        for batch in batches:
            for r in batch.to_pylist():
                ids = book.decode(r["n_ids"], np.frombuffer(r["checkpoints"], dtype="<u8"), r["payload"])
                ends = np.cumsum(r["sizes"])
                starts = ends - np.array(r["sizes"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["docs"], type=pa.int64()), pa.array(starts + begins[r["part"]] + r["ids_before"], type=pa.int64()),
                    pa.array(r["sizes"], type=pa.int64()), pa.array([value(ids[a:b]) for a, b in zip(starts, ends)], type=kind).cast(
                        pa.list_(pa.int64()) if field.endswith("array<long>") else kind),
                ], names=["doc_id", "start", "n_tokens", field.split()[0]])

    return blocks.mapInArrow(run, f"doc_id long, start long, n_tokens long, {field}")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): what the files hold, one row per document."""
    return _decoded(spark, folder, "ids array<long>", lambda ids: ids)


def token_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), from the decoded ids."""
    return _decoded(spark, folder, "ids_crc32 long", crc)


@registered()
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids, written as coded blocks and read back."""
    place = new_folder(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), place)
    return token_checksums(spark, place)
