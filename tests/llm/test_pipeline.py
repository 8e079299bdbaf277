"""The pipeline's stages one after the other, against what their operators say row by row."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm.common import prepare
from test_words_and_tokens import plain_ids

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    prepare(spark)
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [text(30) for _ in range(3)]
    rows, labels, kinds = [], [], {}

    def add(kind, words):
        i = len(rows)
        body = words if isinstance(words, str) or words is None else " ".join(words)
        rows.append((i, body, "en", "s", len(body or "")))
        kinds[i] = kind
        return i

    for i in range(240):
        toxic = i % 6 == 0
        words = text(60)
        for _ in range(4 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(["gribble", "snarfle"])
        labels.append((add("toxic" if toxic else "plain", words), int(toxic)))
    base = text(100)
    first = add("plain", base)
    for k in range(6):
        changed = list(base)
        changed[rng.randrange(100)] = f"z{k}"
        add("copy", changed)
    add("copy", base)
    for k, item in enumerate(items):
        add("leak", text(20) + item + text(20))
    add("pii", " ".join(text(30)) + " mail a.b@c.example.com or +1 (456) 555-2186 now")
    add("empty", "")
    add("empty", None)
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, kinds


def test_stages(spark, corpus):
    folder, rows, kinds = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = Counter(kinds.values())
    seen = {i: t for i, t, *_ in rows}
    gone = {"toxicity": "toxic", "near_copies": "copy", "decontamination": "leak"}
    expected = set(kinds)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        place = f"{folder}/after-{name}"
        out.write.parquet(place)
        docs = spark.read.parquet(place)
        expected -= {i for i in expected if kinds[i] == gone.get(name)}
        found = {r.doc_id: r for r in docs.collect()}
        assert set(found) == expected, name
        for i, r in found.items():
            if name == "pii" and kinds[i] == "pii":
                assert r.text.endswith(" mail [EMAIL] or [PHONE] now") and r.n_chars == len(r.text)
            else:
                assert r.text == seen[i]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p.start):
        by_doc.setdefault(p.doc_id, b"")
        by_doc[p.doc_id] += bytes(p.ids)
    assert {i: np.frombuffer(b, dtype="<u4").tolist() for i, b in by_doc.items()} == {i: plain_ids(t) for i, t in texts.items()}
    assert left["plain"] + left["pii"] + left["empty"] == len(texts)


def test_run_gives_the_last_stage(spark, corpus):
    folder, _, kinds = corpus
    out = corpus_pipeline.run(spark, folder)
    assert out.select("doc_id").distinct().count() == sum(k in ("plain", "pii", "empty") for k in kinds.values())


def test_stages_on_nothing(spark, corpus):
    folder, _, _ = corpus
    nothing = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0, name
