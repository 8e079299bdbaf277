"""Substring deduplication: every window of words is hashed and counted; repeated windows go.

1. A task hashes every window of its texts (Rabin-Karp, two independent values: one chooses
   the bucket, one is the key), finds those that repeat among its own texts, and sends each
   remaining key once per chunk to its bucket. A passage in a third of all texts thus costs
   one entry per chunk, not one per text.
2. A bucket sorts its keys and answers, per text, with the windows that repeat.
3. Each text merges the answers into maximal removal intervals.

A window is told apart by 64 key bits within its bucket: with b buckets, n windows give about
n * n / (b * 2**65) chance pairs, 4e-6 for 124 million windows in 200 buckets and 4 among the
28 trillion windows of 100 TB. Buckets grow with the text, and with the number of shuffle partitions,
and every partition has its own, so the keys a task sorts stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import batches_of, giving_back
from millrace.llm.common import registered, shuffle_partitions, table
from millrace.llm.words import U64, ByteHash, Words, covered, from_planes, planes

WINDOW = 35
#: Windows gathered before a task sends their keys.
CHUNK = 1 << 21
#: Most text whose keys one shuffle partition gets, whatever their number is set to.
PARTITION_BYTES = 48 << 20
#: Buckets in each shuffle partition, worked off one after the other.
SUB_BUCKETS = 4

_KEY, _PLACE = ByteHash(11), ByteHash(12)
_ENTRIES = "route int, answer boolean, texts binary, counts binary, keys binary, again binary, places binary"
_ENTRY_SCHEMA = pa.schema([
    ("route", pa.int32()), ("answer", pa.bool_()), ("texts", pa.binary()), ("counts", pa.binary()),
    ("keys", pa.binary()), ("again", pa.binary()), ("places", pa.binary()),
])
_ANSWER_SCHEMA = pa.schema([("text_key", pa.binary()), ("places", pa.binary())])


class _Chunk:
    """Windows of consecutive texts of one task."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.texts: list[bytes] = []
        self.keys, self.routes, self.places, self.owners = [], [], [], []
        self.size = 0

    def add(self, batch: pa.RecordBatch, window: int) -> None:
        words = Words(batch.column("text"))
        first = words.whole_windows(window)
        owners = words.owners()[first]
        self.keys.append(_KEY.windows(words.hashes(_KEY), window)[first])
        self.routes.append((_PLACE.windows(words.hashes(_PLACE), window)[first] % U64(self.buckets)).astype(np.uint32))
        self.places.append((first - words.first[owners]).astype(np.uint32))
        self.owners.append(owners + len(self.texts))
        self.texts += batch.column("text_key").to_pylist()
        self.size += len(first)

    def rows(self) -> Iterator[dict]:
        """Answers for windows that repeat here, then one row of keys for each bucket."""
        if not self.size:
            return
        keys, routes = np.concatenate(self.keys), np.concatenate(self.routes)
        places, owners = np.concatenate(self.places), np.concatenate(self.owners)
        order = np.argsort(keys, kind="stable")
        equal = (keys[order][1:] == keys[order][:-1]) & (routes[order][1:] == routes[order][:-1])
        head = np.concatenate([[True], ~equal])
        more = np.concatenate([equal, [False]]) & head
        repeated = np.zeros(len(keys), dtype=bool)
        repeated[order] = ~head | more
        yield from self._answers(owners[repeated], places[repeated])
        once = np.flatnonzero(~repeated)
        once = once[np.argsort(routes[once], kind="stable")]
        twice = order[more]
        twice = twice[np.argsort(routes[twice], kind="stable")]
        cuts = np.arange(self.buckets + 1)
        a, b = np.searchsorted(routes[once], cuts), np.searchsorted(routes[twice], cuts)
        names = np.frombuffer(b"".join(self.texts), dtype="V16")
        for route in range(self.buckets):
            mine, also = once[a[route]:a[route + 1]], twice[b[route]:b[route + 1]]
            if len(mine) or len(also):
                at = np.flatnonzero(np.diff(owners[mine], prepend=-1))
                yield {
                    "route": route, "answer": False, "texts": names[owners[mine][at]].tobytes(),
                    "counts": planes(np.diff(at, append=len(mine))), "keys": keys[mine].tobytes(),
                    "again": keys[also].tobytes(), "places": planes(places[mine]),
                }

    def _answers(self, owners: np.ndarray, places: np.ndarray) -> Iterator[dict]:
        cuts = np.flatnonzero(np.diff(owners, prepend=-1, append=-1)) if len(owners) else []
        sent: set[bytes] = set()
        for i, j in zip(cuts[:-1], cuts[1:]):
            name = self.texts[owners[i]]
            if name not in sent:  # copies have all their windows here, so one answer serves them
                sent.add(name)
                yield {"route": int.from_bytes(name[:4], "little") % self.buckets, "answer": True, "texts": name,
                       "counts": b"", "keys": b"", "again": b"", "places": planes(places[i:j])}


def _window_entries(buckets: int, window: int):
    def run(batches):
        def rows():
            chunk = _Chunk(buckets)
            for batch in batches:
                chunk.add(batch, window)
                if chunk.size >= CHUNK:
                    yield from chunk.rows()
                    chunk = _Chunk(buckets)
            yield from chunk.rows()

        return batches_of(rows(), _ENTRY_SCHEMA)

    return run


def _repeated(rows: list[dict]) -> Iterator[tuple[bytes, np.ndarray]]:
    """Of one bucket's rows, the windows whose key occurs more than once, by text."""
    keys = np.concatenate([np.frombuffer(r["keys"], dtype=U64) for r in rows])
    again = np.concatenate([np.frombuffer(r["again"], dtype=U64) for r in rows])
    both = np.sort(np.concatenate([keys, again]))
    found = np.unique(both[1:][both[1:] == both[:-1]])
    if not len(found):
        return
    begin = 0
    at = np.searchsorted(found, keys)
    hit_all = found[np.minimum(at, len(found) - 1)] == keys
    for r in rows:
        names = np.frombuffer(r["texts"], dtype="V16")
        counts = from_planes(r["counts"]).astype(np.int64)
        n = int(counts.sum())
        hit = hit_all[begin:begin + n]
        begin += n
        if hit.any():
            owners, places = np.repeat(np.arange(len(names)), counts)[hit], from_planes(r["places"])[hit]
            cuts = np.flatnonzero(np.diff(owners, prepend=-1, append=-1))
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield names[owners[i]].tobytes(), places[i:j]


def _answers(batches) -> Iterator[pa.RecordBatch]:
    """Rows arrive by bucket; what a text is told by all buckets of the task is sent as one row."""
    told: dict[bytes, list[np.ndarray]] = {}

    def take(pairs) -> None:
        for name, places in pairs:
            got = told.setdefault(name, [])
            got.append(places)
            if len(got) > 64:  # the same text is answered by many chunks: keep each place once
                told[name] = [np.unique(np.concatenate(got))]

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["answer"]:
                take([(row["texts"], from_planes(row["places"]))])
                continue
            if held and held[0]["route"] != row["route"]:
                take(_repeated(held))
                held = []
            held.append(row)
    if held:
        take(_repeated(held))
    yield from batches_of(
        ({"text_key": k, "places": planes(np.unique(np.concatenate(v)))} for k, v in told.items()), _ANSWER_SCHEMA
    )


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(text_key, places): for each text with repeats, rows of first words of its repeated windows.

    ``texts`` has ``text`` and ``text_key``, a 16-byte digest of it; each row is one occurrence.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(4, shuffle_partitions(spark) // 3, -(-size // PARTITION_BYTES))
    buckets = partitions * SUB_BUCKETS
    entries = texts.select("text", "text_key").mapInArrow(giving_back(_window_entries(buckets, window)), _ENTRIES)
    dealt = entries.repartitionById(partitions, F.expr(f"CAST(route div {SUB_BUCKETS} AS INT)")).sortWithinPartitions("route", "answer")
    return dealt.mapInArrow(giving_back(_answers), "text_key binary, places binary")


def _cut(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.list_(pa.int32()))), ("kept", pa.string())])

    def one(text: bytes | None, places: list[bytes] | None) -> tuple[int, int, list, str]:
        words = (text or b"").split()
        if not places:
            return len(words), 0, [], b" ".join(words).decode("utf-8", "replace")
        gone = covered(np.unique(np.concatenate([from_planes(p) for p in places])), window, len(words))
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        kept, at = [], 0
        for i, j in edges:
            kept += words[at:i]
            at = j
        kept += words[at:]
        return len(words), int(gone.sum()), edges.tolist(), b" ".join(kept).decode("utf-8", "replace")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            done = [one(t, p) for t, p in zip(texts, batch.column("places").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array([d[k] for d in done], type=schema.types[k + 1]) for k in range(4))],
                schema=schema,
            )

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Remove every word that lies in a window of words which also starts anywhere else.

    Returns (doc_id, n_words, n_removed, spans, kept), one row per input row; ``spans`` are the
    maximal removed intervals of words, end exclusive, ``kept`` the other words joined by one
    space. Null, empty and short texts keep all their words. Rows with the same text, also with
    the same or a null id, count as separate occurrences. Other columns are ignored.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    told = repeated_windows(texts, window).groupBy("text_key").agg(F.collect_list("places").alias("places"))
    joined = texts.join(told, "text_key", "left").select("doc_id", "text", "places")
    return joined.mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, spans array<array<int>>, kept string")


_SQL = f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - {WINDOW - 2})) AS i, ws FROM w WHERE len(ws) >= {WINDOW}
), hashed AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS h FROM starts
), hits AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM hashed) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM hits
), lists AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN ps IS NULL THEN ws
         ELSE list_filter(ws, lambda x, k: NOT list_contains(ps, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists ON w.doc_id = lists.doc_id
"""


@registered(_SQL)
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words of windows that repeat anywhere."""
    out = without_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
