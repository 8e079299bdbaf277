"""Cuts at code points against plain Python strings."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import fill_middle
from millrace.llm.common import prepare


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_rank_and_select(texts):
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    units = fill_middle.Units(data)
    ends = np.cumsum([0, *(len(c.encode()) for c in "".join(texts))])
    assert units.select(np.arange(len(ends))).tolist() == ends.tolist()
    assert units.rank(ends).tolist() == list(range(len(ends)))


def plain(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}", text


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    signs = "ab <>PSM\n" + "éß日本́‍😀👩"
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "x<P>y"), (1003, "<M>"), (None, "no id é"), (None, None), (-5, "<<S"),
             (1004, "日本語😀" * 60_000), (3, rows[3][1]), (3, rows[3][1]), (1005, "a"), (1006, "😀")]
    rng.shuffle(rows)
    return rows


def test_outputs(spark, corpus):
    prepare(spark)
    schema = "doc_id long, text string, n string, form int, output binary, restored int"
    df = spark.createDataFrame([(i, t, "n", 1, b"o", 2) for i, t in corpus], schema)
    got = sorted(map(tuple, fill_middle.fill_in_middle(df).collect()), key=repr)
    assert got == sorted((plain(*row) for row in corpus), key=repr)
    assert {row[2] for row in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_plain(spark, corpus, folder):
    spark.createDataFrame(corpus, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    from millrace.llm import QUERIES

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = [(*p[:5], digest(p[5]), digest(p[6])) for p in (plain(*row) for row in corpus)]
    assert sorted(map(tuple, QUERIES["op12_fill_in_middle"](spark, folder).collect()), key=repr) == sorted(want, key=repr)
