"""The conversation trie against a plain dictionary of prefixes, and the spilling queue against a sort."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from millrace.llm import conversation_trie
from millrace.llm.common import prepare
from millrace.llm.spilling import SpillingQueue


@pytest.mark.parametrize("most", [3, 50, 10_000])
def test_queue_gives_sorted_order(most):
    rng = random.Random(most)
    queue, waiting, got = SpillingQueue(most), [], []
    for _ in range(3000):
        if waiting and rng.random() < 0.4:
            got.append(queue.pop())
            assert got[-1] == min(waiting)
            waiting.remove(got[-1])
        else:
            item = (rng.randrange(200), rng.randrange(5))
            queue.push(item)
            waiting.append(item)
    rest = []
    while queue:
        assert queue.first() == min(waiting)
        rest.append(queue.pop())
        waiting.remove(rest[-1])
    assert rest == sorted(rest) and not waiting
    assert bool(queue.spilled) == (most < 3000)


def md5(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append(((turn is not None, turn or 0), md5(role, text), (role, text)))
    turns = {c: [t for *_, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own if family == c else turns.get(family, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[k] for k in children[node]]
        totals[node] = (sum(t[0] for t in below) or 1, own + sum(t[1] for t in below))
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(rebuilt[c]) == len(node)))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), *totals[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, k1 string, ends int, depth string"


def frame(spark, rows):
    """Rows with columns that share names with the operator's own."""
    return spark.createDataFrame([(*r, "k", 1, "d") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 260), *range(-120, -90), 1000, 1005, 1007, *range(2001, 2009)]:
        n = rng.randrange(0 if c % 100 else 1, 9)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"t{rng.randrange(3)} é😀") for t in range(n)]
    rows += [(300, t, "user", f"long {t % 7}") for t in range(400)] + [(304, t, None, f"long {t % 5}") for t in range(300)]
    rows += [(3000 + i, 0, "user", "hello") for i in range(80)] + [(3000 + i, 1, "x", str(i)) for i in range(80)]
    rows += [(4000, None, None, None), (4000, None, "a", "b"), (4000, 1, "a", "b"), (4000, 1, "a", "b"), (4001, 5, "", None),
             (None, 1, "a", "b"), (4002, 2, "user", "x" * 50_000), (4002, 2, "user", "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("heavy, band, queue", [(1000, 512, 200_000), (10, 4, 2), (1, 1, 1), (3, 50, 3)])
def test_nodes(spark, corpus, heavy, band, queue):
    prepare(spark)
    got = conversation_trie.prefix_trie(frame(spark, corpus).repartition(3), heavy, band, queue)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(corpus)


def test_one_conversation_over_many_partitions(spark):
    """The state at the start of each partition comes from one row per partition before it."""
    rows = [(7, t, "u", str(t % 3)) for t in range(200)] + [(0, t, "u", str(t)) for t in range(4)]
    prepare(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert sorted(map(tuple, conversation_trie.prefix_trie(frame(spark, rows)).collect()), key=repr) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_pieces_of_ids(spark, monkeypatch):
    rows = [(3000 + 100 * i, 0, "user", "same") for i in range(300)]
    monkeypatch.setattr(conversation_trie, "_PIECE", 40)
    assert sorted(map(tuple, conversation_trie.prefix_trie(frame(spark, rows)).collect()), key=repr) == plain(rows)


def test_empty_table(spark):
    assert conversation_trie.prefix_trie(frame(spark, [])).collect() == []


def test_query_and_its_sql_equal_plain(spark, corpus, folder):
    from millrace.llm import ORACLES, QUERIES
    from tools.compare import difference

    spark.createDataFrame(corpus, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    query = QUERIES["op11_conversation_trie"](spark, folder)
    assert difference(query, ORACLES["op11_conversation_trie"], db) is None
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, query.select(names).collect()), key=repr) == plain(corpus)
