"""The prefix trie of conversations, with totals of every subtree by time-forward processing.

1. **Paths.** Turns are cut to a digest and a length, sorted by conversation and scanned. A scan
   names every prefix by a polynomial of its digests modulo 2**127 - 1. A conversation may span
   partitions: one row per partition says how it ends, and from these the state at the start of
   each partition follows, so a conversation with a third of all turns is scanned by many tasks.
2. **Shards.** A node is the top of a shard at depth 0 and 1, below a node with more than ``heavy``
   conversations, and at every ``band``-th depth. So a shard has at most ``heavy * band`` nodes,
   however many conversations share a turn or however long one is.
3. **Time-forward processing.** The nodes of a shard are sorted deepest first (Spark's sort spills) and
   streamed; each sends its totals to its parent through a priority queue that spills as well.
   The first pass gives the totals of the tops within their shards. The tops' own tree, which has
   at most rows / heavy + rows / band inner nodes, is streamed the same way. The second pass hands
   each top's whole total to its parent's shard and gives the totals of all nodes.

A node's conversation ids that end there are hashed in ascending order: a sort over all partitions
joins them to pieces of 256 KB, and the second pass hashes the pieces of a node in order.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept, registered, shuffle_partitions, table
from millrace.llm.spilling import SpillingQueue

#: Conversations of a node from which its children are shards of their own, and depths of a shard.
HEAVY, BAND = 1000, 512
#: Conversations are rebuilt from the first of so many ids, with fewer than so many shared turns.
FAMILY, SHARED = 100, 6

_PRIME = (1 << 127) - 1
_BASE = 0x3243F6A8885A308D313198A2E0370734
_LOW = (1 << 63) - 1
_PIECE = 256 << 10


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its family."""
    return zlib.crc32(str(conv_id).encode()) % SHARED


def _family(conv_id: int) -> int:
    return conv_id - (abs(conv_id) % FAMILY) * (1 if conv_id >= 0 else -1)


def _halves(key: int) -> tuple[int, int]:
    return (key >> 63) - (1 << 63), key & _LOW


# -- paths -----------------------------------------------------------------------


class _Scan:
    """The state of a scan over sorted turns: the family's first turns, and where the conversation stands."""

    def __init__(self):
        self.family: int | None = None
        self.head: list[tuple[int, int]] = []  # the first turns of the family's first conversation
        self.conv: int | None = None
        self.seen = self.skip = self.depth = self.key = 0

    def begin(self, conv: int) -> list[tuple[int, int]]:
        """Turn to another conversation; returns the turns it takes from its family."""
        family = _family(conv)
        if family != self.family:
            self.family, self.head = family, []
        self.conv, self.seen, self.depth, self.key = conv, 0, 0, 0
        self.skip = 0 if conv == family else shared_turns(conv)
        return self.head[:self.skip]

    def step(self, g: int) -> None:
        self.depth += 1
        self.key = (self.key + g * pow(_BASE, self.depth, _PRIME)) % _PRIME

    def own(self, g: int, chars: int) -> bool:
        """Take the conversation's next turn; whether it belongs to the rebuilt conversation."""
        self.seen += 1
        if self.conv == self.family and len(self.head) < SHARED:
            self.head.append((g, chars))
        if self.seen <= self.skip:
            return False
        self.step(g)
        return True


_TURNS = "conv_id long, digest binary, chars int"
_TAIL = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64()), ("first_n", pa.int64()),
                   ("total", pa.binary()), ("heads", pa.list_(pa.binary())), ("head_of", pa.int64()), ("head_chars", pa.list_(pa.int32()))])


def _tails(batches) -> Iterator[pa.RecordBatch]:
    """How a partition ends, as one row: what of its last conversation and family it holds."""
    first = last = head_of = None
    n = first_n = total = 0
    heads, lead = [], []  # of the last family's first conversation; of the last conversation
    for batch in batches:
        for conv, digest, chars in zip(*(c.to_pylist() for c in batch.columns)):
            g = int.from_bytes(digest, "big") % _PRIME
            if conv != last:
                first = conv if first is None else first
                last, n, total, lead = conv, 0, 0, []
                if _family(conv) != head_of:
                    head_of, heads = _family(conv), []
            n += 1
            first_n += conv == first
            total = (total + g * pow(_BASE, n, _PRIME)) % _PRIME
            if len(lead) < SHARED:
                lead.append((g, chars))
            if conv == head_of and len(heads) < SHARED:
                heads.append((g, chars))
    if n:
        # of the last conversation: its first turns here, so that those not its own can be taken off again
        row = {"part": TaskContext.get().partitionId(), "first": first, "last": last, "n": n, "first_n": first_n,
               "total": total.to_bytes(16, "big"), "head_of": head_of,
               "heads": [g.to_bytes(16, "big") for g, _ in [*heads, *lead]], "head_chars": [len(heads), *(c for _, c in heads)]}
        yield pa.RecordBatch.from_pylist([row], schema=_TAIL)


def _carried(tails: list[dict]) -> dict[int, tuple]:
    """For each partition the state it starts from, and how many turns of its last conversation follow later."""
    out, state = {}, (None, [], None, 0, 0)
    for t in sorted(tails, key=lambda t: t["part"]):
        out[t["part"]] = state
        family, head, conv, seen, _ = state
        k = t["head_chars"][0]
        values = [int.from_bytes(b, "big") for b in t["heads"]]
        found, lead = list(zip(values[:k], t["head_chars"][1:])), values[k:]
        head = ((head if family == t["head_of"] else []) + found)[:SHARED]
        going_on = t["first"] == t["last"] and conv == t["last"]
        before = seen if going_on else 0
        skip = 0 if t["last"] == t["head_of"] else shared_turns(t["last"])
        taken = head[:skip]
        key = state[4] if going_on else sum(g * pow(_BASE, i, _PRIME) for i, (g, _) in enumerate(taken, 1)) % _PRIME
        off = max(0, min(t["n"], skip - before))  # of the turns here, those replaced by the family's
        own = int.from_bytes(t["total"], "big") - sum(g * pow(_BASE, i, _PRIME) for i, g in enumerate(lead[:off], 1))
        # the turn at place i here stands at depth taken + before + i - skip
        key = (key + own * pow(_BASE, len(taken) + before - skip, _PRIME)) % _PRIME
        state = (t["head_of"], head, t["last"], before + t["n"], key)
    later, following = {}, None
    for t in sorted(tails, key=lambda t: -t["part"]):
        on = following is not None and following["first"] == t["last"]
        later[t["part"]] = (following["first_n"] + (following["first"] == following["last"]) * later[following["part"]]) if on else 0
        following = t
    return {part: (*state, later[part]) for part, state in out.items()}


_PATH = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, chars int, ends boolean"
_PATH_SCHEMA = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()),
                          ("p2", pa.int64()), ("chars", pa.int32()), ("ends", pa.bool_())])


def _paths(carried: dict[int, tuple]):
    """Every prefix of every rebuilt conversation, the empty one included: (conversation, depth, key, parent's key ...)."""

    def rows(batches) -> Iterator[tuple]:
        scan, later = _Scan(), 0
        state = carried.get(TaskContext.get().partitionId())
        if state is not None:
            family, head, conv, seen, key, later = state
            if conv is not None:
                scan.begin(conv)
                scan.family, scan.head, scan.seen, scan.key = family, list(head), seen, key
                scan.depth = len(scan.head[:scan.skip]) + max(0, seen - scan.skip)
        held = None  # the newest prefix, as a following one decides whether the conversation ends with it
        for batch in batches:
            for conv, digest, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != scan.conv:
                    if held:
                        yield (*held, True)
                    taken = scan.begin(conv)
                    held = (conv, 0, *_halves(0), None, None, 0)
                    for g, length in taken:
                        yield (*held, False)
                        before = scan.key
                        scan.step(g)
                        held = (conv, scan.depth, *_halves(scan.key), *_halves(before), length)
                before = scan.key
                if scan.own(int.from_bytes(digest, "big") % _PRIME, chars):
                    if held:
                        yield (*held, False)
                    held = (conv, scan.depth, *_halves(scan.key), *_halves(before), chars)
        if held:
            yield (*held, not (later and scan.seen + later > scan.skip))

    def run(batches):
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), _PATH_SCHEMA)], schema=_PATH_SCHEMA)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), _PATH_SCHEMA)], schema=_PATH_SCHEMA)

    return run


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars, ends): the prefixes of all rebuilt conversations, written."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("int").alias("chars"))
    family = F.expr(f"conv_id - conv_id % {FAMILY}")
    order = [family, family != F.col("conv_id"), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ordered = turns.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    ordered = ordered.select("conv_id", "digest", "chars").persist(StorageLevel.DISK_ONLY)
    try:  # both scans see the same partitions
        tails = ordered.mapInArrow(_tails, "part int, first long, last long, n long, first_n long, total binary, "
                                           "heads array<binary>, head_of long, head_chars array<int>").collect()
        return kept(ordered.mapInArrow(_paths(_carried([t.asDict() for t in tails])), _PATH), "paths")
    finally:
        ordered.unpersist()


# -- time-forward processing -----------------------------------------------------

_INBOX, _ENDS, _NODE = 0, 1, 2
_STREAM = ("td long, t1 long, t2 long, depth long, k1 long, k2 long, kind int, p1 long, p2 long, is_top boolean, first long, "
           "ids binary, conv_id long, parent_conv_id long, n_convs long, leaves long, saved long, children long")


def _forward(emit_all: bool, out: pa.Schema, most: int):
    """Stream the rows of whole shards, deepest first, and add up what is sent to each node.

    Before a node come what other shards sent it and the pieces of its ids. A top keeps its totals;
    any other node sends them to its parent.
    """

    def rows(batches) -> Iterator[dict]:
        queue, shard = SpillingQueue(most), None
        at, sums, digest = None, [0, 0, 0], None
        for batch in batches:
            for row in batch.to_pylist():
                address = (-row["depth"], row["k1"], row["k2"])
                if (row["td"], row["t1"], row["t2"]) != shard:
                    if queue:
                        raise AssertionError("a message reached no node")
                    shard = (row["td"], row["t1"], row["t2"])
                if address != at:
                    at, sums, digest = address, [0, 0, 0], None
                if row["kind"] == _INBOX:
                    sums = [sums[0] + row["leaves"], sums[1] + row["saved"], sums[2] + row["children"]]
                elif row["kind"] == _ENDS:
                    if digest is None:
                        digest = hashlib.sha256(row["ids"])
                    else:
                        digest.update(b"," + row["ids"])
                else:
                    while (first := queue.first()) is not None and first[:3] <= address:
                        if first[:3] != address:
                            raise AssertionError("a message reached no node")
                        queue.pop()
                        sums = [s + v for s, v in zip(sums, first[3:])]
                    leaves, saved, children = sums[0] + row["leaves"], sums[1] + row["saved"], sums[2]
                    if not row["is_top"]:
                        queue.push((1 - row["depth"], row["p1"], row["p2"], leaves, saved, 1))
                    if emit_all or row["is_top"]:
                        yield row | {"leaves": leaves, "saved": saved, "children": children,
                                     "ends_sha256": (digest or hashlib.sha256()).hexdigest()}
        if queue:
            raise AssertionError("a message reached no node")

    def run(batches):
        held = []
        for row in rows(batches):
            held.append(row)
            if len(held) == 4096:
                yield pa.RecordBatch.from_pylist(held, schema=out)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=out)

    return run


_TOTALS = pa.schema([(n, pa.int64()) for n in ("td", "t1", "t2", "depth", "k1", "k2", "p1", "p2", "leaves", "saved")])
_RESULT = pa.schema([*((n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "children", "leaves", "saved")),
                     ("ends_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def _streamed(rows: DataFrame, emit_all: bool, out: pa.Schema, most: int, partitions: int) -> DataFrame:
    names = [c.split()[0] for c in _STREAM.split(", ")]
    types = dict(c.split() for c in _STREAM.split(", "))
    full = rows.select(*[(F.col(n) if n in rows.columns else F.lit(None)).cast(types[n]).alias(n) for n in names])
    order = ["td", "t1", "t2", F.col("depth").desc(), "k1", "k2", "kind", "first"]
    return full.repartition(partitions, "td", "t1", "t2").sortWithinPartitions(*order).mapInArrow(_forward(emit_all, out, most), _ddl(out))


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """Ids in ascending order, joined by commas within a node to pieces of bounded size."""
    schema = pa.schema([*((n, pa.int64()) for n in ("td", "t1", "t2", "depth", "k1", "k2", "first")), ("ids", pa.binary())])
    out, node, first, ids, size = [], None, None, [], 0
    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if key != node or size > _PIECE:
                if ids:
                    out.append(dict(zip(schema.names, [*node, first, ",".join(ids).encode()])))
                if len(out) >= 4096 or size > _PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        out.append(dict(zip(schema.names, [*node, first, ",".join(ids).encode()])))
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def prefix_trie(conversations: DataFrame, heavy: int = HEAVY, band: int = BAND, queue: int = 200_000) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, with their subtree totals.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored. A conversation's turns
    are ordered by turn, null first, and turns of the same number by a digest of role and text, so
    repeated rows are turns of their own. Null roles and texts count as empty; rows without a conv_id
    belong to no conversation and are left out. Without conversations there are no nodes.

    Returns, per node, conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. ``queue`` bounds the messages a task holds in memory.
    """
    spark = conversations.sparkSession
    partitions = shuffle_partitions(spark)
    node, top, above = ["depth", "k1", "k2"], ["td", "t1", "t2"], ["ad", "a1", "a2"]
    prefixes = paths(conversations)

    # shards: the nearest top at or above each prefix, looked for within a band of its conversation
    crowded = kept(prefixes.groupBy(node).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy).select(
        *node, F.lit(True).alias("crowded")), "crowded")  # written, so that its size decides on the join
    along = Window.partitionBy("conv_id", F.expr(f"depth div {band}")).orderBy("depth")
    is_top = F.expr(f"depth <= 1 OR depth % {band} = 0") | F.coalesce(F.lag("crowded").over(along), F.lit(False))
    marked = prefixes.join(crowded, node, "left").withColumn("is_top", is_top)
    marked = marked.withColumns({t: F.last(F.when(F.col("is_top"), F.col(n)), ignorenulls=True).over(along) for t, n in zip(top, node)})
    marked = kept(marked.drop("crowded"), "marked-paths")
    nodes = marked.groupBy(node).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.max("chars").alias("chars"), F.every("ends").alias("is_leaf"), F.every("is_top").alias("is_top"), *[F.min(t).alias(t) for t in top])
    parents = nodes.select(*[F.col(a).alias(b) for a, b in zip([*node, "conv_id", *top], ["pd", "p1", "p2", "parent_conv_id", *above])])
    nodes = nodes.withColumn("pd", F.col("depth") - 1).join(parents, ["pd", "p1", "p2"], "left").drop("pd").withColumns({
        "kind": F.lit(_NODE), "leaves": F.col("is_leaf").cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = kept(nodes.drop("chars", "is_leaf"), "nodes")

    # first pass: totals of the tops within their shards, and the top above each
    within = _streamed(nodes, False, _TOTALS, queue, partitions).drop("p1", "p2")
    tops = kept(within.join(nodes.where("is_top").select(*node, "p1", "p2", *above), node), "tops")
    inner = tops.where("depth > 0").select(*[F.col(a).alias(t) for a, t in zip(above, top)]).distinct()
    outer = tops.join(inner, top, "left_anti")
    sent = outer.where("depth > 0").groupBy(*above).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("children"))
    sent = sent.select(*[F.col(a).alias(n) for a, n in zip(above, node)], F.lit(_INBOX).alias("kind"), "leaves", "saved", "children")

    # across the tops that have tops below them: the same, with the tops' tree as one shard
    crossed = tops.join(inner, top, "left_semi").select(
        *node, F.lit(_NODE).alias("kind"), F.col("a1").alias("p1"), F.col("a2").alias("p2"), F.col("ad"), "leaves", "saved")
    whole = _across(crossed.unionByName(sent, allowMissingColumns=True), queue)
    totals = kept(outer.select(*node, "p1", "p2", *above, "leaves", "saved").unionByName(
        tops.join(inner, top, "left_semi").drop("leaves", "saved").join(whole, node).select(*node, "p1", "p2", *above, "leaves", "saved")), "top-totals")

    # second pass: with what the shards below send, and the ids that end at each node
    inbox = totals.where("depth > 0").groupBy(F.expr("depth - 1").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
                                              *[F.col(a).alias(t) for a, t in zip(above, top)]).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count(F.lit(1)).alias("children"), F.lit(_INBOX).alias("kind"))
    ending = marked.where("ends").select(*top, *node, "conv_id").repartitionByRange(partitions, *top, *node, "conv_id")
    pieces = ending.sortWithinPartitions(*top, *node, "conv_id").mapInArrow(_pieces, ", ".join(
        f"{n} long" for n in [*top, *node, "first"]) + ", ids binary").withColumn("kind", F.lit(_ENDS))
    stream = nodes.drop(*above).unionByName(inbox, allowMissingColumns=True).unionByName(pieces, allowMissingColumns=True)
    done = _streamed(stream, True, _RESULT, queue, partitions)
    return done.withColumnsRenamed({"children": "n_children", "leaves": "n_leaves", "saved": "saved_tokens"})


def _across(rows: DataFrame, queue: int) -> DataFrame:
    """Totals of the tops' tree: (depth, k1, k2, leaves, saved). Parents may stand any number of levels above."""
    out = pa.schema([(n, pa.int64()) for n in ("depth", "k1", "k2", "leaves", "saved")])

    def run(batches):
        waiting, at, sums = SpillingQueue(queue), None, (0, 0)
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                address = (-row["depth"], row["k1"], row["k2"])
                if address != at:
                    at, sums = address, (0, 0)
                sums = (sums[0] + row["leaves"], sums[1] + row["saved"])
                if row["kind"] == _INBOX:
                    continue
                while (first := waiting.first()) is not None and first[:3] == address:
                    _, _, _, leaves, saved = waiting.pop()
                    sums = (sums[0] + leaves, sums[1] + saved)
                done.append({"depth": row["depth"], "k1": row["k1"], "k2": row["k2"], "leaves": sums[0], "saved": sums[1]})
                if row["ad"] is not None:
                    waiting.push((-row["ad"], row["p1"], row["p2"], *sums))
            yield pa.RecordBatch.from_pylist(done, schema=out)

    ordered = rows.select("depth", "k1", "k2", "kind", "ad", "p1", "p2", "leaves", "saved").repartition(1)
    return ordered.sortWithinPartitions(F.col("depth").desc(), "k1", "k2", "kind").mapInArrow(run, _ddl(out))


_SQL = f"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g, length(coalesce(text, '')) AS chars, turn
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) AS i FROM t
), c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % {FAMILY} AS base, CASE WHEN conv_id % {FAMILY} = 0 THEN 0 ELSE
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda a, x: list_reduce([xor(a, x)] || CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda b, z: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295) % {SHARED} END AS h
  FROM t
), turns AS (
  SELECT c.conv_id, 0 AS own, i, g, chars FROM c JOIN o ON o.conv_id = c.base AND i <= h
  UNION ALL SELECT c.conv_id, 1, i, g, chars FROM c JOIN o ON o.conv_id = c.conv_id AND i > h
), p AS (
  SELECT conv_id, row_number() OVER w AS d, chars, md5(string_agg(g, ',') OVER w) AS k FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
), r AS (
  SELECT conv_id, d, k, lag(k, 1, '') OVER (PARTITION BY conv_id ORDER BY d) AS pk, chars, lead(d) OVER (PARTITION BY conv_id ORDER BY d) IS NULL AS ends
  FROM (SELECT * FROM p UNION ALL SELECT conv_id, 0, 0, '' FROM c) q(conv_id, d, chars, k)
), n AS (
  SELECT d, k, min(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) * (count(*) - 1) AS own, bool_and(ends) AS leaf,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM r GROUP BY d, k
), below AS (
  SELECT r.d, r.k, count(*) FILTER (leaf) AS n_leaves, sum(own) AS saved_tokens, count(*) FILTER (n.d = r.d + 1) AS n_children
  FROM n JOIN r ON r.conv_id = n.conv_id AND r.d <= n.d GROUP BY r.d, r.k
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN below b ON b.d = n.d AND b.k = n.k LEFT JOIN n up ON up.d = n.d - 1 AND up.k = n.pk
"""


@registered(_SQL)
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_trie(table(spark, folder, "conversations"))
