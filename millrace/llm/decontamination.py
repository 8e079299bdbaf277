"""Benchmark passages in documents, found by greedy string tiling.

A document and a benchmark item that share a run of ``SEED`` words are tiled: the longest matches not yet
marked in either are marked, then the next longest, down to ``LEAST`` words; matches are looked for by
Karp-Rabin values of the words. The share of an item's words in tiles counts, wherever the tiles lie, so
passages in another order are caught. Words are lower-cased and parted by ASCII signs and white space.

Candidates come from a join of seeds. A filter of bits, of bounded size whatever the benchmark, goes to every
task and drops document seeds that no item has; the rest meet the items' seeds in Spark. Equal texts are one
text from there on, so only different texts that share a seed with an item are shuffled and tiled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import giving_back
from millrace.llm.common import kept, registered, table
from millrace.llm.words import SIGNS, U64, ByteHash, Words

#: Words of the seeds that bring a document and an item together, and of the shortest tile.
SEED, LEAST = 5, 5
#: The share of an item's words in tiles from which a document is contaminated.
COVERAGE = 0.6
#: The filter of seeds has about 32 bits a seed, from 2**20 to 2**28 bits (32 MB); beyond that it lets more pass.
LEAST_BITS, MOST_BITS = 20, 28
#: Bits in one row of the filter, as the bitmap functions have it.
_ROW_BITS = 8 * 4096

_HASH = ByteHash(61)


def normal_words(column: pa.Array) -> Words:
    return Words(pc.utf8_lower(column), SIGNS)


def tiles(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two arrays of word values: (start in a, start in b, length).

    In each pass the longest matches between unmarked words are marked, in order of their starts; a match that an
    earlier one of the pass has eaten into is left for a later, shorter pass.
    """
    free_a, free_b, out = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool), []
    while True:
        found = _longest(a, b, free_a, free_b, least)
        if not found:
            return out
        for i, j, n in found:
            if free_a[i:i + n].all() and free_b[j:j + n].all():
                free_a[i:i + n] = free_b[j:j + n] = False
                out.append((i, j, n))


def _longest(a, b, free_a, free_b, least) -> list[tuple[int, int, int]]:
    """All longest matches of at least ``least`` unmarked words, by doubling and halving the window of running hashes."""
    pairs = _equal(a, b, _runs(free_a, least), _runs(free_b, least), least)
    if not len(pairs[0]):
        return []
    low, high = least, min(len(a), len(b)) + 1
    while high - low > 1:  # the longest size that still has matches: a match has matches of all smaller sizes
        middle = min(2 * low, (low + high) // 2)
        tried = _equal(a, b, _runs(free_a, middle), _runs(free_b, middle), middle)
        if len(tried[0]):
            low, pairs = middle, tried
        else:
            high = middle
    return [(int(i), int(j), low) for i, j in zip(*pairs) if (a[i:i + low] == b[j:j + low]).all()]


def _runs(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of ``size`` unmarked words in a row."""
    if len(free) < size:
        return np.empty(0, dtype=np.int64)
    used = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(used[size:] == used[:-size])


def _equal(a, b, starts_a, starts_b, size) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of starts whose windows of ``size`` words have equal values; each start of b meets the first few of a."""
    if not len(starts_a) or not len(starts_b):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    va, vb = _HASH.windows(a, size)[starts_a], _HASH.windows(b, size)[starts_b]
    order = np.argsort(va, kind="stable")
    first, last = np.searchsorted(va[order], vb, side="left"), np.searchsorted(va[order], vb, side="right")
    hit = np.flatnonzero(last > first)
    # a tile of b needs one place in a: the k-th start of a value in b takes its k-th place in a
    rank = _rank(vb[hit]) % np.maximum(last[hit] - first[hit], 1)
    return starts_a[order[first[hit] + rank]], starts_b[hit]


def _rank(values: np.ndarray) -> np.ndarray:
    """How many equal values come before each."""
    order = np.argsort(values, kind="stable")
    head = np.concatenate([[True], values[order][1:] != values[order][:-1]]) if len(values) else np.empty(0, dtype=bool)
    place = np.arange(len(values))
    out = np.empty(len(values), dtype=np.int64)
    out[order] = place - np.maximum.accumulate(np.where(head, place, 0)) if len(values) else place
    return out


def _text_seeds(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The seeds of each text, repeated ones once: their texts, in order, and their values."""
    words = normal_words(column)
    first = words.whole_windows(SEED)
    keys = _HASH.windows(words.hashes(_HASH), SEED)[first]
    owners = words.owners()[first]
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return owners[new], keys[new]


def _seed_rows(texts: DataFrame, name: str, held=None) -> DataFrame:
    """(``name``, key): the seeds of ``texts`` (``name``, text); with ``held``, a filter, those that pass it."""

    def run(batches):
        bits = np.frombuffer(held.value, dtype=np.uint8) if held is not None else None
        for batch in batches:
            owners, keys = _text_seeds(batch.column("text"))
            if bits is not None:
                at = keys & U64(8 * len(bits) - 1)
                passed = (bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0
                owners, keys = owners[passed], keys[passed]
            for k in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name).take(pa.array(owners[k:k + (1 << 16)])), pa.array(keys[k:k + (1 << 16)].view(np.int64))], names=[name, "key"])

    return texts.select(name, "text").mapInArrow(giving_back(run), f"{name} binary, key long")


def _filter(seeds: DataFrame) -> bytes:
    """A bit for the low end of every key, packed; at most ``2 ** MOST_BITS`` bits."""
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (32 * seeds.count()).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(size - 1)) + 1  # buckets of bitmap functions begin at 1
    rows = seeds.groupBy(F.bitmap_bucket_number(at).alias("row")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = bytearray(max(size, _ROW_BITS) // 8)
    for r in rows:
        begin = (r["row"] - 1) * _ROW_BITS // 8
        out[begin:begin + len(r["bits"])] = r["bits"]
    return bytes(out[:max(size // 8, 1)])


def _tiled(batches):
    """Coverage and tiles of pairs of texts."""
    last, mine = None, None
    for batch in batches:
        items = normal_words(batch.column("item_text"))
        own = items.hashes(_HASH)
        texts, covers, counts = batch.column("digest").to_pylist(), [], []
        for k, digest in enumerate(texts):
            if digest != last:
                last, mine = digest, normal_words(batch.column("text").slice(k, 1)).hashes(_HASH)
            words = own[items.first[k]:items.first[k + 1]]
            found = tiles(mine, words)
            covers.append(sum(n for _, _, n in found) / len(words))
            counts.append(len(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), batch.column("item"), pa.array(covers, type=pa.float64()), pa.array(counts, type=pa.int32())],
            names=["digest", "item", "coverage", "tiles"])


def _digest(text) -> F.Column:
    return F.unhex(F.sha2(text, 256))


def covered_texts(texts: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(digest, item_id, coverage, tiles) of the texts (digest, text) that share a seed with an item; repeated rows count once.

    A seed of very many texts is as many rows, which adaptive execution splits; it is never a group.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("item_text")).where(
        "item_text IS NOT NULL").withColumn("item", _digest(F.col("item_text")))
    different = items.groupBy("item").agg(F.any_value("item_text").alias("item_text"))
    seeds = kept(_seed_rows(different.select("item", F.col("item_text").alias("text")), "item"), "item-seeds")
    held = texts.sparkSession.sparkContext.broadcast(_filter(seeds))
    hits = _seed_rows(texts, "digest", held)
    pairs = kept(hits.join(seeds, "key").select("digest", "item").distinct(), "candidates")
    few = kept(pairs.select("digest").distinct(), "candidate-texts")  # written, so that its size is known before texts are shuffled
    wanted = texts.join(few, "digest", "left_semi").groupBy("digest").agg(F.any_value("text").alias("text"))
    both = pairs.join(wanted, "digest").join(different, "item").select("digest", "item", "text", "item_text")
    found = both.mapInArrow(giving_back(_tiled), "digest binary, item binary, coverage double, tiles int")
    return found.join(items.select("item", "item_id").distinct(), "item").select("digest", "item_id", "coverage", "tiles")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, items, coverage, tiles, contaminated), one row per row of ``docs``.

    ``items`` are the ids of those of which at least the share ``coverage`` of words lies in tiles, each once, without null
    ids; ``coverage`` and ``tiles`` are those of the item covered best. Null and empty texts contain nothing; null items and
    items of fewer than SEED words are too short to tell a leak from chance and match nothing. Rows with the same or a null
    id are judged one by one. An empty benchmark contaminates nothing. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("digest", _digest(F.col("text")))
    found = covered_texts(rows.select("digest", "text"), benchmark).groupBy("digest").agg(
        F.sort_array(F.collect_set(F.when(F.col("coverage") >= coverage, F.col("item_id")))).alias("items"),
        F.max(F.struct("coverage", "tiles")).alias("best"))
    judged = rows.select("doc_id", "digest").join(kept(found, "covered"), "digest", "left")
    best = F.coalesce(F.col("best.coverage"), F.lit(0.0))
    return judged.select(
        "doc_id", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), best.alias("coverage"),
        F.coalesce("best.tiles", F.lit(0)).alias("tiles"), F.coalesce(F.col("best.coverage") >= coverage, F.lit(False)).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item of the benchmark, unchanged.

    Rows with null or empty texts stay, repeated rows stay or go alike, and all columns keep their names and values,
    whatever they are called. An empty benchmark leaves all rows, an empty table stays empty.
    """
    name = "digest"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    rows = docs.withColumn(name, _digest(F.col(f"`{text}`").cast("string")))
    texts = rows.select(F.col(name).alias("digest"), F.col(f"`{text}`").cast("string").alias("text"))
    bad = kept(covered_texts(texts, benchmark).where(F.col("coverage") >= coverage).select("digest").distinct(), "contaminated")
    return rows.join(bad.withColumnRenamed("digest", name), name, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


@registered()
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the benchmark items they contain."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
