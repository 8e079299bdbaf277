"""Packing documents into training sequences with their lexical neighbours.

Documents are dealt into shards of bounded size by a hash. A shard has an inverted index with
BM25 weights over token ids. A document first fills whole sequences alone; what is left of it
seeds a sequence, and the unused documents that score highest for the seed's heaviest terms
fill it up, the last one being cut. Only the end of a shard stays short: it becomes sequences whose
lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import give_back
from millrace.llm.common import registered, table
from millrace.llm.token_store import tokens
from millrace.llm.tokens import crc, unpacked

LENGTH = 1024
#: Bytes of text in a shard, about; what one task indexes.
SHARD_BYTES = 8 << 20
#: A seed's terms that are looked up, and the usual constants of BM25.
QUERY_TERMS, K1, B = 16, 1.2, 0.75

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Index:
    """The postings of a shard: documents and BM25 weights by term."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        sizes = np.array([len(d) for d in docs])
        terms, counts = zip(*(np.unique(d, return_counts=True) for d in docs))
        owners = np.repeat(np.arange(self.n), [len(t) for t in terms])
        terms, counts = np.concatenate(terms), np.concatenate(counts)
        order = np.argsort(terms, kind="stable")
        self.names, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(terms))
        df = np.diff(self.first)
        idf = np.log(1 + (self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        number = np.searchsorted(self.names, terms)
        weights = idf[number] * counts * (K1 + 1) / (counts + norm[owners])
        self.owners, self.weights = owners[order], weights[order]
        # the heaviest terms of each document that another one has too
        self.queries, begin = [], 0
        for size in np.bincount(owners, minlength=self.n):
            mine, heavy = number[begin:begin + size], weights[begin:begin + size].copy()
            heavy[df[mine] < 2] = 0
            best = np.argpartition(-heavy, min(QUERY_TERMS, size - 1))[:QUERY_TERMS]
            self.queries.append(mine[best[heavy[best] > 0]])
            begin += size

    def scores(self, doc: int) -> np.ndarray:
        """The BM25 score of every document for a document's heaviest terms."""
        spans = [slice(self.first[t], self.first[t + 1]) for t in self.queries[doc]]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.owners[s] for s in spans]),
                           weights=np.concatenate([self.weights[s] for s in spans]), minlength=self.n)


def pack(docs: list[np.ndarray], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, size, sequence, offset) of the ids of a shard's documents."""
    pieces, sequence = [], 0
    begin = np.zeros(len(docs), dtype=np.int64)
    for i, ids in enumerate(docs):
        while len(ids) - begin[i] >= length:
            pieces.append((i, int(begin[i]), length, sequence, 0))
            begin[i] += length
            sequence += 1
    left = np.array([len(d) for d in docs], dtype=np.int64) - begin
    if not left.any():
        return pieces
    index, next_one = Index(docs), 0
    while True:
        while next_one < len(docs) and not left[next_one]:
            next_one += 1
        if next_one == len(docs):
            return pieces
        seed, parts, room = next_one, [], length
        if left.sum() >= length:
            scores = index.scores(seed)
            scores[left == 0] = 0
            scores[seed] = np.inf
            scored = np.flatnonzero(scores)
            queue = iter(scored[np.argsort(-scores[scored], kind="stable")])
            while room:
                doc = next(queue, None)
                if doc is None:  # no unused neighbour: the next documents in order
                    queue = iter(np.flatnonzero(left))
                    continue
                size = int(min(left[doc], room))
                if size:
                    parts.append((int(doc), int(begin[doc]), size))
                    begin[doc] += size
                    left[doc] -= size
                    room -= size
            sizes = [length]
        else:  # the end of the shard
            for doc in np.flatnonzero(left):
                parts.append((int(doc), int(begin[doc]), int(left[doc])))
                left[doc] = 0
            total = sum(p[2] for p in parts)
            sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        offset = 0
        for doc, start, size in parts:
            while size:
                some = min(size, sizes[0] - offset)
                pieces.append((doc, start, some, sequence, offset))
                start, size, offset = start + some, size - some, offset + some
                if offset == sizes[0]:
                    sizes.pop(0)
                    sequence, offset = sequence + 1, 0


def _shard(length: int, with_ids: bool):
    def packed_group(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("tie", "ascending")])
        docs = [unpacked(x) for x in group.column("ids").to_pylist()]
        names, base = group.column("doc_id").to_pylist(), group.column("shard")[0].as_py() << 32
        rows = pack(docs, length)
        cut = [docs[d][s:s + n] for d, s, n, _, _ in rows]
        return pa.table([
            pa.array([names[r[0]] for r in rows], type=pa.int64()), pa.array([r[1] for r in rows], type=pa.int64()),
            pa.array([r[2] for r in rows], type=pa.int64()), pa.array([crc(c) for c in cut], type=pa.int64()),
            pa.array([len(docs[r[0]]) for r in rows], type=pa.int64()), pa.array([base + r[3] for r in rows], type=pa.int64()),
            pa.array([r[4] for r in rows], type=pa.int64()),
            pa.array([c.astype("<u4").tobytes() if with_ids else None for c in cut], type=pa.binary()),
        ], schema=_PIECES)

    def run(group: pa.Table) -> pa.Table:
        try:
            return packed_group(group)
        finally:
            give_back()  # a shard's index, before the next shard's

    return run


def packed_sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None, text: str = "text",
                     doc_id: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids).

    Every id, the end ids included, lies in one piece; ``ids`` holds little-endian 32-bit ids. Null
    and empty texts are the end id alone. Rows with the same id, or with a null one, are documents of
    their own. An empty table has no pieces. Other columns are ignored.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")) + 16)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    coded = tokens(docs, vocabulary, text, doc_id).withColumn("tie", F.xxhash64("ids")).withColumn(
        "shard", F.pmod(F.xxhash64(F.coalesce("doc_id", "tie")), F.lit(shards)))
    return coded.groupBy("shard").applyInArrow(_shard(length, with_ids), _DDL)


@registered()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1,024 ids."""
    return packed_sequences(table(spark, folder, "documents"), with_ids=False).drop("ids")
