"""Substring deduplication and the similarity join against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest

from millrace.llm import graph, jaccard_join, substring_dedup
from millrace.llm.common import prepare

SCHEMA = "doc_id long, text string, n_words string, places int, component_id string, class int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows):
    """Rows with columns that share names with the operators' own."""
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def vocabulary(rng, n, k=2000):
    return " ".join(f"w{rng.randrange(k)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base, passage = vocabulary(rng, 120), vocabulary(rng, 60)
    rows = [(i, vocabulary(rng, rng.randrange(1, 150))) for i in range(60)]
    rows += [(100 + i, base) for i in range(5)]
    for i in range(30):  # near copies, some chained
        changed = base.split()
        for _ in range(rng.randrange(1, 4)):
            changed[rng.randrange(len(changed))] = f"x{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(changed)))
    rows += [(300 + i, vocabulary(rng, 40) + "\n" + passage + " " + vocabulary(rng, 30)) for i in range(8)]
    rows += [(400, passage + " " + vocabulary(rng, 50) + " " + passage), (401, "a b c"), (402, "A  b\tc"), (403, "a b c d"),
             (404, ""), (405, None), (406, " \n\t "), (407, "one"), (408, "one"), (409, "é à日本 x"), (None, base), (None, "one"),
             (410, "same " * 40), (411, vocabulary(rng, 6000)), (101, base), (500, vocabulary(rng, 34)), (501, vocabulary(rng, 35))]
    rng.shuffle(rows)
    return rows


def plain_dedup(rows, size):
    seen = Counter(tuple(words(t)[i:i + size]) for _, t in rows for i in range(len(words(t)) - size + 1))
    out = Counter()
    for doc, text in rows:
        ws = words(text)
        gone = {j for i in range(len(ws) - size + 1) if seen[tuple(ws[i:i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out[doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("chunk", [1 << 21, 300])
@pytest.mark.parametrize("size", [35, 3])
def test_substring_dedup(spark, corpus, size, chunk, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    rows = substring_dedup.without_repeats(frame(spark, corpus).repartition(3), size).collect()
    found = Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows)
    assert found == plain_dedup(corpus, size)
    for r in rows:
        assert sum(b - a for a, b in r.spans) == r.n_removed
        assert all(b < a for (_, b), (a, _) in zip(r.spans, r.spans[1:]))  # maximal intervals


def test_substring_dedup_of_nothing(spark):
    prepare(spark)
    assert substring_dedup.without_repeats(frame(spark, [])).count() == 0


def plain_sets(rows):
    out = []
    for _, text in rows:
        ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set()))
    return out


def plain_components(rows):
    sets = plain_sets(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]) and root(i) != root(j):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[root(i)] = min(doc, smallest.get(root(i), doc))
    return [(doc, len(sets[i]), smallest.get(root(i))) for i, (doc, _) in enumerate(rows)], [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("rounds", [2, 0])
def test_similar_documents(spark, corpus, rounds, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(jaccard_join, "CHUNK", 500)
    monkeypatch.setattr(jaccard_join, "HUB_ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "BLOCK", 1024 if rounds else 4)  # without hubs: links of the full round alone, in blocks
    found = jaccard_join.similar_documents(frame(spark, corpus).repartition(3)).collect()
    assert Counter(tuple(r) for r in found) == Counter(plain_components(corpus)[0])


def test_one_of_each(spark, corpus):
    prepare(spark)
    docs = frame(spark, corpus)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    expected, roots = plain_components(corpus)
    wordless = [c for c in corpus if not words(c[1])]
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len(set(r for r, c in zip(roots, corpus) if words(c[1]))) + len(wordless)
    ids = {doc for doc, _ in rows}
    assert {c for _, _, c in expected if c is not None} <= ids | {doc for doc, _ in wordless}
    assert jaccard_join.one_of_each(docs.limit(0)).count() == 0


def test_links_at_the_limit(spark):
    """Sets of exactly 80 % overlap link; one shingle less doesn't."""
    prepare(spark)
    for n in (9, 18, 27, 45, 90):
        a = [f"w{i}" for i in range(n + 4)]
        for cut in range(1, n // 2):
            b = a[:len(a) - cut] + [f"z{i}" for i in range(cut)]
            rows = [(1, " ".join(a)), (2, " ".join(b))]
            sets = plain_sets(rows)
            share = 100 * len(sets[0] & sets[1]) - 80 * len(sets[0] | sets[1])
            if abs(share) <= 180:
                found = {r.doc_id: r.component_id for r in jaccard_join.similar_documents(frame(spark, rows)).collect()}
                assert found[2] == (1 if share >= 0 else 2), (n, cut)
                break


def test_components(spark):
    prepare(spark)
    edges = [(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (60, 60)] + [(100, k) for k in range(101, 160)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {**{i: 0 for i in range(21)}, 50: 40, 40: 40, 45: 40, **{k: 100 for k in range(100, 160)}}
    assert {r.node: r.root for r in out} == expected and len(out) == len(expected)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
