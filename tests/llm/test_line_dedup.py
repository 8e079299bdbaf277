"""Cuckoo filters against sets, and the line index against plain Python after every change."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from millrace.llm import line_dedup
from millrace.llm.common import prepare
from millrace.llm.cuckoo import CuckooFilter

SCHEMA = "doc_id long, text string, key string, shard string, refs int, batch string"


def keys(values):
    return np.frombuffer(b"".join(hashlib.md5(str(v).encode()).digest() for v in values), dtype="V16")


@pytest.mark.parametrize("buckets", [16, 64, 1 << 10])
def test_filter_never_loses_a_key(buckets):
    rng, held, f, fresh = random.Random(buckets), set(), CuckooFilter(buckets), 0
    for step in range(12):
        more = list(range(fresh, fresh + rng.randrange(1, 400)))
        fresh += len(more)
        f.add(keys(more))
        held |= set(more)
        less = rng.sample(sorted(held), rng.randrange(0, len(held)))
        f.remove(keys(less)) if less else None
        held -= set(less)
        f = CuckooFilter(buckets, f.stored())
        assert len(f) == len(held)
        assert f.contains(keys(sorted(held))).all() if held else True
    others = f.contains(keys(range(10**6, 10**6 + 20_000)))
    assert others.mean() < 0.02 * len(f.tables)


def test_removing_an_unknown_key_is_an_error():
    f = CuckooFilter(64)
    f.add(keys([1]))
    with pytest.raises(ValueError, match="not held"):
        f.remove(keys([2]))


def key_of(line):
    key = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key)


def plain(rows, index):
    """Rows judged by the documents of ``index``."""
    order = lambda i: -(1 << 63) if i is None else i
    holders = defaultdict(set)
    for doc, text in index:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(order(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(key_of(x)) < 20 or len(holders[key_of(x)]) < 3 or order(doc) >= max(holders[key_of(x)])]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    common = [f"A repeated line number {i} of the Corpus éß😀" for i in range(25)] + ["short", "", " \t", "exactly twenty chars"]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t\x0b"]) + rng.choice(common) + rng.choice(["", " \r"]) if rng.random() < 0.5
                          else f"A line of document {i} alone, number {rng.random()}" for _ in range(rng.randrange(1, 12)))) for i in range(120)]
    rows += [(1000 + i, "the line that a third of all documents hold") for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "\n\n"), (-3, common[0]), (None, common[0] + "\n" + common[1]), (None, common[2]),
             (2003, ("x" * 200_000) + "\n" + common[3]), (2004, "\n".join([common[4]] * 500)), (5, rows[5][1]), (5, common[6]),
             (2005, "EXACTLY TWENTY CHARS "), (2006, common[5].upper() + "\n" + common[5])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """Rows with columns that share names with the index's own."""
    return spark.createDataFrame([(*r, "k", "s", 1, "b") for r in rows], SCHEMA)


def judged(index, df):
    return sorted(map(tuple, index.without_repeats(df).collect()), key=repr)


def test_insertions_and_deletions(spark, corpus, folder):
    """After each change the verdict is that of the documents that are there."""
    prepare(spark)
    whole = frame(spark, corpus)
    index = line_dedup.LineIndex(spark, folder, shards=3, buckets=16)
    a = [r for r in corpus if r[0] is None or r[0] % 2 == 0]
    b = [r for r in corpus if not (r[0] is None or r[0] % 2 == 0)]
    index.insert(frame(spark, a))
    assert judged(index, whole.where("doc_id % 2 = 0 OR doc_id IS NULL")) == plain(a, a)
    index.insert(frame(spark, b))
    assert judged(index, whole) == plain(corpus, corpus)
    doomed = {r[0] for r in corpus if r[0] is None or r[0] % 3 == 0 or r[0] > 1030}
    index.delete(frame(spark, [(i, None) for i in [*doomed, 10**9]]))
    left = [r for r in corpus if r[0] not in doomed]
    assert judged(index, frame(spark, left)) == plain(left, left)
    back = [r for r in corpus if r[0] in doomed]
    index.insert(frame(spark, back))
    assert judged(index, whole) == plain(corpus, corpus)
    with pytest.raises(ValueError, match="there already"):
        index.insert(frame(spark, corpus[:3]))
    index.delete(whole)
    assert index.counts().isEmpty() and index.entries().isEmpty()
    held = [CuckooFilter(16, r["filter"]) for r in index.filters().collect()]
    assert held and sum(map(len, held)) == 0


def test_false_alarms_are_settled_by_the_exact_table(spark, folder):
    """With one bucket most lookups say yes; results stay right."""
    rows = [(i, f"a line that documents {i // 4} and its like hold") for i in range(40)]
    index = line_dedup.LineIndex(spark, folder, shards=1, buckets=1)
    index.insert(frame(spark, rows[::2]))
    index.insert(frame(spark, rows[1::2]))
    index.delete(frame(spark, rows[:7]))
    assert judged(index, frame(spark, rows[7:])) == plain(rows[7:], rows[7:])


def test_unfinished_batch_is_written_over(spark, folder, monkeypatch):
    rows = [(i, "a line that all the documents hold") for i in range(5)]
    index = line_dedup.LineIndex(spark, folder, shards=2)
    monkeypatch.setattr(index, "_finish", lambda *a: None)
    index.insert(frame(spark, rows))
    monkeypatch.undo()
    assert index.entries().isEmpty()
    index.insert(frame(spark, rows[:3]))
    assert judged(index, frame(spark, rows[:3])) == plain(rows[:3], rows[:3])


def test_empty_table(spark, folder):
    index = line_dedup.new_index(frame(spark, []))
    index.insert(frame(spark, []))
    assert judged(index, frame(spark, [])) == []


def test_query_and_its_sql(spark, corpus, folder):
    from millrace.llm import ORACLES, QUERIES
    from tools.compare import difference

    rows = list({r[0]: r for r in corpus if r[0] is not None}.values())
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    query = QUERIES["op13_line_dedup"](spark, folder)
    assert difference(query, ORACLES["op13_line_dedup"], db) is None
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(rows, rows)]
    assert sorted(map(tuple, query.collect()), key=repr) == sorted(want, key=repr)


def test_python_steps_give_their_memory_back(spark, tmp_path, monkeypatch):
    wrapped, real = [], line_dedup.giving_back
    monkeypatch.setattr(line_dedup, "giving_back", lambda run: wrapped.append(run.__qualname__.split(".")[0]) or real(run))
    docs = spark.createDataFrame([(n, "a line that three documents hold\nshort") for n in range(3)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"), 2)
    index.insert(docs)
    kept = index.without_repeats(docs).select("doc_id", "n_dropped").collect()
    assert sorted(tuple(r) for r in kept) == [(0, 1), (1, 1), (2, 0)]
    assert wrapped == ["_filtered", "_kept_lines"]
