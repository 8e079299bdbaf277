"""Similarity join of word shingle sets with prefix filters under several global orders.

Two texts link when 100 * intersection >= 80 * union of their sets of distinct 5-word
shingles (of A-Z lower-cased words). The result is exact for the links' components:

1. Texts with equal sets form a class; only classes take part from here on.
2. One count over all shingles tells which of them occur in two classes or more. As every
   global order puts the others first, they never match, and a class with less than 80 % of
   shared shingles is done: it links with nothing.
3. Three global orders arrange the shared shingles by three hashes. Linked classes must have
   a token in common in their prefixes under each order.
4. Hub rounds: every class is verified against one hub it shares a prefix token with, so that a
   large group of near copies becomes few components with as many pairs as it has classes.
5. Full round: classes of different components that share a prefix token and can reach the needed
   overlap form families. A family's sets meet in a task, block by block; pairs that share prefix tokens
   under all three orders are verified there. Pairs are never rows; only links that join components are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import batches_of, giving_back
from millrace.llm.common import kept, registered, shuffle_partitions, table
from millrace.llm.graph import components
from millrace.llm.words import U64, ByteHash, Words, from_planes, mix, planes

SHINGLE = 5
PERCENT = 80
#: Seeds of the hashes that arrange the shared shingles, one for each global order.
ORDERS = (101, 202, 303)
#: Rounds that verify each class against one hub before the full round.
HUB_ROUNDS = 2
#: Classes of one token, or of one family, that a task holds from each of two blocks.
BLOCK = 1024
#: Digests of rows that are sent to every task, in bytes; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Most shingles that a bucket gets on average, whatever the number of shuffle partitions; each bucket is a partition of its own.
BUCKET_KEYS = 1 << 23
#: Shingles gathered before a task sends them.
CHUNK = 1 << 19

_HASH = ByteHash(21, lower=True)
#: A class on its way: its digest and the size of its set.
_CLASS = np.dtype([("digest", "V16"), ("n", "<u4")])
_ENTRY_SCHEMA = pa.schema([("route", pa.int32()), ("classes", pa.binary()), ("counts", pa.binary()),
                           ("keys", pa.binary()), ("again", pa.binary())])
_ENTRIES = "route int, classes binary, counts binary, keys binary, again binary"
_SHARED_SCHEMA = pa.schema([("gather", pa.int32()), ("classes", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary())])
_NODE_SCHEMA = pa.schema([("class", pa.binary()), ("n", pa.int64()), ("keys", pa.binary())])


def needed(n: int) -> int:
    """The smallest overlap a set of n shingles needs with a set of any size."""
    return -(-PERCENT * n // 100)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words = Words(column)
    hashes = words.hashes(_HASH)
    shingles = _HASH.windows(hashes, SHINGLE)
    for i in range(len(words)):
        a, n = int(words.first[i]), int(words.counts[i])
        if n >= SHINGLE:
            yield np.unique(shingles[a:a + n - SHINGLE + 1])
        elif n:  # the whole sequence; its length keeps it apart from longer ones
            yield mix(_HASH.windows(hashes[a:a + n], n) + U64(n))
        else:
            yield np.empty(0, dtype=U64)


def _class_of(keys: np.ndarray) -> bytes:
    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()


def _classes(others: list[str]):
    def run(batches):
        for batch in batches:
            sets = list(_sets(batch.column("text")))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in others), pa.array([len(s) for s in sets], type=pa.int64()),
                pa.array([_class_of(s) if len(s) else None for s in sets], type=pa.binary()),
            ], names=[*others, "n_shingles", "class"])

    return run


def _named(keys_of: dict[bytes, np.ndarray]) -> np.ndarray:
    out = np.empty(len(keys_of), dtype=_CLASS)
    out["digest"] = np.frombuffer(b"".join(keys_of), dtype="V16")
    out["n"] = [len(k) for k in keys_of.values()]
    return out


def _parts(routes: np.ndarray, owners: np.ndarray, keys: np.ndarray, names: np.ndarray, n: int) -> list[dict | None]:
    """For each route: the classes with keys there, how many each has, and the keys."""
    order = np.lexsort((owners, routes))
    routes, owners, keys = routes[order], owners[order], keys[order]
    cuts, out = np.searchsorted(routes, np.arange(n + 1)), []
    for i, j in zip(cuts[:-1], cuts[1:]):
        at = np.flatnonzero(np.diff(owners[i:j], prepend=-1))
        out.append({"classes": names[owners[i:j][at]].tobytes(), "counts": planes(np.diff(at, append=j - i)),
                    "keys": keys[i:j].tobytes()} if j > i else None)
    return out


_NOTHING = {"classes": b"", "counts": b"", "keys": b""}


class _Chunk:
    """The sets of the distinct classes among consecutive texts of one task."""

    def __init__(self, buckets: int):
        self.buckets, self.size = buckets, 0
        self.classes: dict[bytes, np.ndarray] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        for keys in _sets(batch.column("text")):
            if len(keys) and (name := _class_of(keys)) not in self.classes:
                self.classes[name] = keys
                self.size += len(keys)

    def rows(self) -> Iterator[dict]:
        """What two classes here share is known at once and goes to the first bucket of each class, marked by a
        negative route; of the rest, and once for what they share, the keys go to the keys' buckets."""
        if not self.size:
            return
        names, keys = _named(self.classes), np.concatenate(list(self.classes.values()))
        owners = np.repeat(np.arange(len(names)), names["n"].astype(np.int64))
        order = np.argsort(keys, kind="stable")
        equal = keys[order][1:] == keys[order][:-1]
        follows, leads = np.concatenate([[False], equal]), np.concatenate([equal, [False]])
        shared = np.zeros(len(keys), dtype=bool)
        shared[order] = follows | leads
        again = np.sort(keys[order[leads & ~follows]])
        home = np.frombuffer(names["digest"].tobytes(), dtype="<u4").reshape(-1, 4)[:, 0] % np.uint32(self.buckets)
        for route, part in enumerate(_parts(home[owners[shared]], owners[shared], keys[shared], names, self.buckets)):
            if part:
                yield {"route": -1 - route, "again": b"", **part}
        more = (again % U64(self.buckets)).astype(np.int64)
        again = again[np.argsort(more, kind="stable")]
        cuts = np.searchsorted(np.sort(more), np.arange(self.buckets + 1))
        routes = (keys[~shared] % U64(self.buckets)).astype(np.int64)
        for route, part in enumerate(_parts(routes, owners[~shared], keys[~shared], names, self.buckets)):
            also = again[cuts[route]:cuts[route + 1]]
            if part or len(also):
                yield {"route": route, "again": also.tobytes(), **(part or _NOTHING)}


def _entries(buckets: int):
    def run(batches):
        def rows():
            chunk = _Chunk(buckets)
            for batch in batches:
                chunk.add(batch)
                if chunk.size >= CHUNK:
                    yield from chunk.rows()
                    chunk = _Chunk(buckets)
            yield from chunk.rows()

        return batches_of(rows(), _ENTRY_SCHEMA)

    return run


class _Owned:
    """Keys with their owners, of rows of classes, counts and keys."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.keys, self.owners = [np.empty(0, dtype=U64)], [np.empty(0, dtype=np.int32)]

    def add(self, row: dict) -> None:
        names = row["classes"]
        own = [self.numbers.setdefault(names[i:i + _CLASS.itemsize], len(self.numbers)) for i in range(0, len(names), _CLASS.itemsize)]
        self.owners.append(np.repeat(np.array(own, dtype=np.int32), from_planes(row["counts"]).astype(np.int64)))
        self.keys.append(np.frombuffer(row["keys"], dtype=U64))

    def names(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.numbers), dtype=_CLASS)

    def distinct(self, slices: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted keys and owners, each pair once, a slice of the keys at a time to bound the memory. Uses up what was added."""
        keys, self.keys = np.concatenate(self.keys), []
        owners, self.owners = np.concatenate(self.owners), []
        part = (keys >> U64(61)).astype(np.int8)
        for k in range(slices):
            mine = np.flatnonzero(part == k)
            mine = mine[np.lexsort((owners[mine], keys[mine]))]
            a, b = keys[mine], owners[mine]
            if len(a):
                first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
                yield a[first], b[first]


def _shared_in(held: _Owned, again: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket, the keys that occur in two classes or more, their owners, and the classes."""
    again = np.unique(np.concatenate(again))
    keys_out, owners_out = [np.empty(0, dtype=U64)], [np.empty(0, dtype=np.int32)]
    for keys, owners in held.distinct():
        equal = keys[1:] == keys[:-1]
        shared = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])
        if len(again):
            shared |= again[np.minimum(np.searchsorted(again, keys), len(again) - 1)] == keys
        keys_out.append(keys[shared])
        owners_out.append(owners[shared])
    return np.concatenate(keys_out), np.concatenate(owners_out), held.names()


def _shared(gatherers: int):
    """The shared keys of each bucket, sent on by class: one row for each bucket and gathering task."""

    def rows(batches):
        def done(held: _Owned, again: list[np.ndarray]) -> Iterator[dict]:
            keys, owners, names = _shared_in(held, again)
            home = (np.frombuffer(names["digest"].tobytes(), dtype="<u4").reshape(-1, 4)[:, 1] % np.uint32(gatherers)).astype(np.int64)
            for gather, part in enumerate(_parts(home[owners], owners, keys, names, gatherers)):
                if part:
                    yield {"gather": gather, **part}

        held, again, route = _Owned(), [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["route"] < 0:
                    own = _Owned()
                    own.add(row)
                    names = own.names()
                    home = (np.frombuffer(names["digest"].tobytes(), dtype="<u4").reshape(-1, 4)[:, 1] % np.uint32(gatherers)).astype(np.int64)
                    owners = own.owners[-1]
                    for gather, part in enumerate(_parts(home[owners], owners, own.keys[-1], names, gatherers)):
                        if part:
                            yield {"gather": gather, **part}
                    continue
                if route not in (None, row["route"]):
                    yield from done(held, again)
                    held, again = _Owned(), []
                route = row["route"]
                held.add(row)
                again.append(np.frombuffer(row["again"], dtype=U64))
        if route is not None:
            yield from done(held, again)

    return lambda batches: batches_of(rows(batches), _SHARED_SCHEMA)


def _candidates(batches) -> Iterator[pa.RecordBatch]:
    """Classes whose shared shingles reach 80 % of their set; rows come by gathering number."""

    def done(held: _Owned) -> Iterator[dict]:
        names = held.names()
        pairs = list(held.distinct())
        if not pairs:
            return
        keys, owners = (np.concatenate(x) for x in zip(*pairs))
        order = np.lexsort((keys, owners))
        keys, owners = keys[order], owners[order]
        cuts = np.searchsorted(owners, np.arange(len(names) + 1))
        for i, (digest, n) in enumerate(names.tolist()):
            if cuts[i + 1] - cuts[i] >= needed(n):
                yield {"class": bytes(digest), "n": n, "keys": keys[cuts[i]:cuts[i + 1]].tobytes()}

    def rows():
        held, number = _Owned(), None
        for batch in batches:
            for row in batch.to_pylist():
                if row["gather"] != number:
                    yield from done(held)
                    held, number = _Owned(), row["gather"]
                held.add(row)
        yield from done(held)

    return batches_of(rows(), _NODE_SCHEMA)


def _prefix(keys: np.ndarray, n: int, order: int) -> np.ndarray:
    """The shared part of a set's prefix under an order, in that order."""
    return np.sort(mix(keys + U64(ORDERS[order])))[:max(0, n - needed(n) + 1 - (n - len(keys)))]


def _prefixes(batches) -> Iterator[pa.RecordBatch]:
    """Prefix tokens of the first order; ``left``: shared shingles from the token on."""
    for batch in batches:
        out = {"token": [], "class": [], "n": [], "left": []}
        for row in batch.to_pylist():
            keys, n = np.frombuffer(row["keys"], dtype=U64), row["n"]
            first = _prefix(keys, n, 0).view(np.int64)
            out["token"] += first.tolist()
            out["class"] += [row["class"]] * len(first)
            out["n"] += [n] * len(first)
            out["left"] += range(len(keys), len(keys) - len(first), -1)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("token", pa.int64()), ("class", pa.binary()), ("n", pa.int64()), ("left", pa.int64())]))


def _links(batches) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets really overlap enough."""
    for batch in batches:
        out = {"a": [], "b": []}
        last, ours = None, None
        for row in batch.to_pylist():
            if row["keys_b"] is not last:
                last, ours = row["keys_b"], np.frombuffer(row["keys_b"], dtype=U64)
            both = len(np.intersect1d(np.frombuffer(row["keys_a"], dtype=U64), ours, assume_unique=True))
            if 100 * both >= PERCENT * (row["n_a"] + row["n_b"] - both):
                out["a"].append(row["a"])
                out["b"].append(row["b"])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("a", pa.binary()), ("b", pa.binary())]))


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    left = nodes.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    right = nodes.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(giving_back(_links), "a binary, b binary")


def _reachable(left_a, n_a, left_b, n_b):
    """Whether the overlap can still reach what the two sizes need."""
    return F.least(left_a, left_b) * (100 + PERCENT) >= (n_a + n_b) * PERCENT


def _with_component(prefixes: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return prefixes.withColumn("comp", F.col("class"))
    return prefixes.join(found, prefixes["class"] == found["node"], "left").withColumn(
        "comp", F.coalesce("root", "class")).drop("node", "root")


def _hub_pairs(members: DataFrame, turn: int) -> DataFrame:
    """For each class, the hub of another component it shares most tokens with; other hubs in every turn."""
    drawn = F.struct(F.xxhash64("class", F.lit(turn)).alias("draw"), "class", "n", "left", "comp")
    hubs = members.groupBy("token").agg(F.min(drawn).alias("hub"))
    close = members.join(hubs, "token").where(F.col("comp") != F.col("hub.comp")).where(
        _reachable(F.col("left"), F.col("n"), F.col("hub.left"), F.col("hub.n")))
    counted = close.groupBy("class", F.col("hub.class").alias("b")).agg(F.count("*").alias("tokens"))
    return counted.groupBy(F.col("class").alias("a")).agg(F.max(F.struct("tokens", "b")).alias("best")).select("a", "best.b")


def _partners(rows: list[dict], comp: np.ndarray, bound: np.ndarray, n: np.ndarray, block: np.ndarray, i: int) -> np.ndarray:
    """Rows before i of another component (and, between two blocks, of the other one) that can reach the overlap."""
    out = (comp[:i] != comp[i]) & (np.minimum(bound[:i], bound[i]) * (100 + PERCENT) >= (n[:i] + n[i]) * PERCENT)
    return out & (block[:i] != block[i]) if rows[0]["low"] != rows[0]["high"] else out


def _columns(rows: list[dict]) -> tuple[np.ndarray, ...]:
    number = {c: i for i, c in enumerate(dict.fromkeys(r["comp"] for r in rows))}
    return (np.array([number[r["comp"]] for r in rows]), np.array([r["left"] for r in rows]),
            np.array([r["n"] for r in rows]), np.array([r["block"] for r in rows]))


def _meet(rows: list[dict]) -> Iterator[dict]:
    """Members of a token with a possible partner, each tied to the first of them."""
    comp, left, n, block = _columns(rows)
    meets = np.zeros(len(rows), dtype=bool)
    for i in range(1, len(rows)):
        partners = _partners(rows, comp, left, n, block, i)
        if partners.any():
            meets[i] = True
            meets[:i] |= partners
    found = np.flatnonzero(meets)
    for i in found[1:]:
        yield {"a": rows[i]["class"], "b": rows[found[0]]["class"]}


def _join_components(rows: list[dict]) -> Iterator[dict]:
    """Links of a family that join components, at most one fewer than there are components."""
    comp, shared, n, block = _columns(rows)
    sets = [np.frombuffer(r["keys"], dtype=U64) for r in rows]
    orders = [_Postings([_prefix(k, int(m), o) for k, m in zip(sets, n)]) for o in range(len(ORDERS))]
    whole = _Postings(sets)
    for i in range(1, len(rows)):
        partners = _partners(rows, comp, shared, n, block, i)
        for order in orders:  # a link shares a prefix token under each order
            if partners.any():
                partners &= order.common(i)[:i] > 0
        if not partners.any():
            continue
        both = whole.common(i)[:i]
        for j in np.flatnonzero(partners & (100 * both >= PERCENT * (n[:i] + n[i] - both))):
            if comp[i] != comp[j]:
                comp[comp == comp[j]] = comp[i]
                yield {"a": rows[i]["class"], "b": rows[j]["class"]}


class _Postings:
    """An inverted index of a group's sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = len(sets)
        owners = np.repeat(np.arange(self.size), [len(k) for k in sets])
        flat, number = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(number, kind="stable")
        self.owners, self.first = owners[order], np.searchsorted(number[order], np.arange(len(flat) + 1))
        ends = np.cumsum([len(k) for k in sets])
        self.tokens = [number[e - len(k):e] for k, e in zip(sets, ends)]

    def common(self, i: int) -> np.ndarray:
        """How many elements each set has in common with set i."""
        if not len(self.tokens[i]):
            return np.zeros(self.size, dtype=np.int64)
        return np.bincount(np.concatenate([self.owners[self.first[t]:self.first[t + 1]] for t in self.tokens[i]]), minlength=self.size)


_PAIR, _PAIR_DDL = pa.schema([("a", pa.binary()), ("b", pa.binary())]), "a binary, b binary"


def _by_group(result):
    """Pairs that ``result`` makes of every run of rows with equal group, low and high."""

    def rows(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and any(held[0][k] != row[k] for k in ("group", "low", "high")):
                    yield from result(held) if len(held) > 1 else ()
                    held = []
                held.append(row)
        yield from result(held) if len(held) > 1 else ()

    return lambda batches: batches_of(rows(batches), _PAIR)


def _dealt(members: DataFrame, more: list[str]) -> DataFrame:
    """Rows of (group, size, class, comp, n, left) such that every two blocks of a group meet in a task."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["group", "low", "high"]
    placed = other.select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                          "block", "class", "comp", "n", "left", *more)
    return placed.repartition(shuffle_partitions(members.sparkSession), *keys).sortWithinPartitions(*keys)


def _cross_links(prefixes: DataFrame, nodes: DataFrame, found: DataFrame | None) -> DataFrame:
    """All that still joins components: pairs from different ones that share a prefix token under every order.

    First the members of a token meet without their sets, in one task or, where there are more than BLOCK,
    in one for every two blocks. Those with a possible partner form families, connected by such tokens; a
    family's sets then meet the same way, so that a set is sent once per block, not once per token.
    """
    members = _with_component(prefixes, found)
    mixed = members.groupBy("token").agg(
        F.min("comp").alias("lowest"), F.max("comp").alias("highest"), F.count("*").alias("size")).where("lowest <> highest")
    inside = members.join(mixed.select("token", "size"), "token").withColumnRenamed("token", "group")
    met = _dealt(inside, []).mapInArrow(giving_back(_by_group(_meet)), _PAIR_DDL).distinct()
    families = components(met).select(F.col("node").alias("class"), F.col("root").alias("group"))
    sizes = families.groupBy("group").agg(F.count("*").alias("size"))
    sets = _with_component(nodes, found).join(families, "class").join(sizes, "group").withColumn(
        "left", F.octet_length("keys") / 8)
    return _dealt(sets, ["keys"]).mapInArrow(giving_back(_by_group(_join_components)), _PAIR_DDL)


def jaccard_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all links among ``nodes`` (class, n, keys)."""
    prefixes = kept(nodes.mapInArrow(giving_back(_prefixes), "token long, class binary, n long, left long"), "prefixes")
    links, found = None, None
    for turn in range(HUB_ROUNDS):
        more = _verified(_hub_pairs(_with_component(prefixes, found), turn), nodes)
        links = kept(more if links is None else links.unionByName(more), "links")
        found = components(links)
    crossing = _cross_links(prefixes, nodes, found)
    return kept(crossing if links is None else links.unionByName(crossing), "links")


def _labelled(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (all columns of ``texts`` but the text, n_shingles, class) and (class, component_id, root)."""
    spark = texts.sparkSession
    others = [f for f in texts.schema.fields if f.name != "text"]
    rows = kept(texts.mapInArrow(giving_back(_classes([f.name for f in others])), T.StructType(
        [*others, T.StructField("n_shingles", T.LongType()), T.StructField("class", T.BinaryType())])), "classes")
    classes = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first_id"))
    least = -(-(rows.agg(F.sum("n_shingles")).first()[0] or 0) // BUCKET_KEYS)
    gatherers = max(4, shuffle_partitions(spark), least)
    partitions = max(4, gatherers // 2, least)  # a class is named once in each of these
    dealt = texts.select("text").mapInArrow(giving_back(_entries(partitions)), _ENTRIES).repartitionById(
        partitions, F.expr("CASE WHEN route < 0 THEN -1 - route ELSE route END")).sortWithinPartitions("route")
    shared = dealt.mapInArrow(giving_back(_shared(gatherers)), "gather int, classes binary, counts binary, keys binary")
    nodes = kept(shared.repartitionById(gatherers, "gather").sortWithinPartitions("gather").mapInArrow(
        giving_back(_candidates), "class binary, n long, keys binary"), "candidates")
    found = components(jaccard_links(nodes))
    rooted = classes.join(found, classes["class"] == found["node"], "left").select(
        "class", "first_id", F.coalesce("root", "class").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, rooted.join(smallest, "root").select("class", "component_id", "root")


def similar_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Components of near-duplicate texts: (doc_id, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest id reachable by links. Texts of fewer than five words are one
    shingle; null texts and texts without words have none, link with nothing and keep their own
    id. Rows with equal texts always link, also rows with the same id. A null id never is the
    smallest, so it gets another's id or, alone, null. Other columns are ignored.
    """
    rows, labels = _labelled(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    linked = rows.where("class IS NOT NULL").join(labels, "class").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("class IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, unchanged; texts without words all stay.

    A row is known by a digest of its id and text, so rows that repeat both leave one row. A component in which
    all ids are null keeps one of its rows.
    """
    row = F.md5(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.col(text).cast("string")))
    keyed = docs.withColumn("__row", F.unhex(row))
    worded = F.coalesce(F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows, labels = _labelled(keyed.where(worded).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), "__row"))
    named = rows.join(labels, "class").select("__row", "doc_id", "root")
    first = named.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row"))["__row"].alias("first"))
    others = kept(named.join(first, "root").where(F.col("__row") != F.col("first")).select("__row"), "others")
    if others.count() * 16 <= BROADCAST_BYTES:  # then the texts needn't be shuffled
        others = F.broadcast(others)
    chosen = keyed.where(worded).join(others, "__row", "left_anti")
    if not rows.groupBy("__row").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        chosen = chosen.dropDuplicates(["__row"])
    return chosen.select(docs.columns).unionByName(docs.where(~worded))


_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {SHINGLE - 2}),
                                      lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' '))) END AS sh FROM w
), t AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), rare AS (
  SELECT * FROM t QUALIFY count(*) OVER (PARTITION BY g) > 1
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM rare a JOIN rare b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs WHERE 100 * c >= {PERCENT} * (na + nb - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.seen) AS component_id
FROM s JOIN reach r ON r.node = s.doc_id GROUP BY ALL
"""


@registered(_SQL)
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their component of near-duplicate links."""
    return similar_documents(table(spark, folder, "documents"))
