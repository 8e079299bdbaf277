"""Toxicity, decontamination, personal data, licences and URL filters on small cases and against plain Python."""

import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import decontamination, license_scan, pii, toxicity, url_filter
from millrace.llm.common import prepare

DOCS = "doc_id long, text string, toxic string, score string, spans int, items int, found int, host int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3, 4) for i, t in rows], DOCS)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


TERMS = ["abcab", "abcdefghij", "bad", "cabba", "abbcc*", "bccab*", "dd*"]


@given(st.text("abcdefghij", max_size=12))
@settings(max_examples=400, deadline=None)
def test_automaton_finds_what_edit_distance_finds(word):
    lexicon = toxicity.Lexicon(TERMS)
    found = lexicon.match(word)
    expected = []
    for term in TERMS:
        text, stem = term.rstrip("*"), term.endswith("*")
        ends = range(len(word) + 1) if stem else [len(word)]
        edits = min(distance(text, word[:n]) for n in ends)
        if edits <= toxicity.edits_of(text, stem):
            expected.append((edits, term))
    assert (found is None) == (not expected)
    if found:
        assert (found[1], found[0]) == min(expected) or (found[1] == min(expected)[0])


def test_quotation_is_told_from_abuse():
    words = 'He said "you idiot" to'.split()
    assert toxicity.quoted(words, 3)
    assert toxicity.quoted("they wrote idiot there".split(), 2)
    assert not toxicity.quoted("you are an idiot really".split(), 3)
    odds = {("idiot", 0): 4.0}
    abuse, quote = (toxicity.features([("idiot", 0, q)], odds) for q in (False, True))
    assert abuse[0] > quote[0] == 0 and quote[1] > 0


@pytest.fixture(scope="module")
def toxic_corpus():
    rng = random.Random(5)
    plain = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows, labels = [], {}
    for i in range(700):
        text = plain(60)
        labels[i] = int(i % 6 == 0)
        if labels[i]:
            for _ in range(4):
                term = rng.choice(["gribble", "snarfle", "wobblehead"])
                if rng.random() < 0.25:
                    at = rng.randrange(1, len(term))
                    term = term[:at] + "q" + term[at + 1:]
                text[rng.randrange(60)] = term
        rows.append((i, " ".join(text)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, toxic_corpus):
    prepare(spark)
    rows, truth = toxic_corpus
    more = [(None, "gribble snarfle gribble"), (5, ""), (6, None), (7, "gribble " * 5000)]
    docs = docs_of(spark, rows + more)
    held_out = lambda i: zlib.crc32(str(i).encode()) % 4 == toxicity.HELD_OUT
    wrong = [(i, 1 - y if held_out(i) else y) for i, y in truth.items()]  # held-out labels must not matter
    labels = spark.createDataFrame(wrong + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {"gribble", "snarfle", "wobblehead"} <= {t.rstrip("*") for t in model.terms} | {
        n for n in ("gribble", "snarfle", "wobblehead") if any(n.startswith(t.rstrip("*")) for t in model.terms)}
    scored = toxicity.scored(docs, model).collect()
    assert len(scored) == len(rows) + 4 and all(0 <= r.score <= 1 for r in scored)
    by_id = {r.doc_id: r.score for r in toxicity.scored(docs_of(spark, rows), model).collect()}
    tested = [i for i in truth if held_out(i)]
    assert sum((by_id[i] >= 0.3) == bool(truth[i]) for i in tested) >= 0.97 * len(tested)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.where("text LIKE 'gribble %'").count() == 0 and kept.where("text IS NULL OR text = ''").count() == 2


def test_terms_do_not_depend_on_partitions(spark):
    prepare(spark)
    rows = [(f"a{i} grubbly b{i}", 1) for i in range(1400)] + [(f"q{i} grubbly r{i}", 0) for i in range(60)] + [(f"c{i} d{i}", 0) for i in range(1400)]
    for parts in (1, 8):
        docs = spark.createDataFrame(rows, "text string, toxic int").repartition(parts)
        assert any("grubbly".startswith(t.rstrip("*")) for t in toxicity.learn_terms(docs, 1400, 1460))


def test_toxicity_without_labels(spark):
    prepare(spark)
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, nothing)
    assert [r.score < 0.3 for r in toxicity.scored(docs, model).collect()] == [True, True]
    assert toxicity.scored(docs.limit(0), model).count() == 0


sequences = st.lists(st.integers(0, 3), max_size=40)


@given(sequences, sequences)
@settings(max_examples=200, deadline=None)
def test_tiles(a, b):
    mixed = np.array([(x + 1) * 0x9E3779B97F4A7C15 % 2**64 for x in a], dtype=np.uint64)
    other = np.array([(x + 1) * 0x9E3779B97F4A7C15 % 2**64 for x in b], dtype=np.uint64)
    found = decontamination.tiles(mixed, other, 3)
    used_a, used_b = set(), set()
    for i, j, n in found:
        assert n >= 3 and a[i:i + n] == b[j:j + n]
        assert not used_a & set(range(i, i + n)) and not used_b & set(range(j, j + n))
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))
    longest = max((n for n in range(1, min(len(a), len(b)) + 1)
                   if {tuple(a[i:i + n]) for i in range(len(a) - n + 1)} & {tuple(b[j:j + n]) for j in range(len(b) - n + 1)}), default=0)
    assert (found[0][2] if found else 0) == (longest if longest >= 3 else 0)
    free = lambda s, used: {tuple(s[i:i + 3]) for i in range(len(s) - 2) if not used & {i, i + 1, i + 2}}
    assert not free(a, used_a) & free(b, used_b)  # nothing that could be tiled is left


def test_decontamination(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(8)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    items = [text(30) for _ in range(6)]
    reordered = items[1][20:] + text(5) + items[1][10:20] + text(3) + items[1][:10]
    rows = [
        (1, " ".join(text(40) + items[0] + text(40))), (2, " ".join(text(10) + reordered)), (3, " ".join(text(200))),
        (4, " ".join(text(5) + items[2][:8] + text(50))), (5, ""), (6, None), (7, ", ".join(items[3]).upper()),
        (None, " ".join(items[0])), (7, " ".join(text(9))), (8, " ".join(items[4] + items[5])),
    ]
    benchmark = spark.createDataFrame([(k, " ".join(w), 0) for k, w in enumerate(items)] + [(90, None, 0), (91, "", 0), (92, "v1 v2", 0)],
                                      "item_id long, text string, doc_id int")
    expected = Counter([(1, (0,)), (2, (1,)), (3, ()), (4, ()), (5, ()), (6, ()), (7, (3,)), (None, (0,)), (7, ()), (8, (4, 5))])
    for bits in (28, 3):  # a filter of seeds as large as needed, and one that lets all pass
        monkeypatch.setattr(decontamination, "MOST_BITS", bits)
        monkeypatch.setattr(decontamination, "LEAST_BITS", min(bits, 20))
        docs = docs_of(spark, rows)
        found = decontamination.contaminated(docs, benchmark).collect()
        assert Counter((r.doc_id, tuple(r["items"])) for r in found) == expected
        assert all(r.contaminated == bool(r["items"]) for r in found)
        kept = decontamination.without_contaminated(docs, benchmark)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, i in expected.elements() if not i)
    assert decontamination.contaminated(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontamination.contaminated(docs.limit(0), benchmark).count() == 0


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += (v * 2 - 9 if v > 4 else v * 2) if i % 2 else v
    return total % 10 == 0


def plain_spans(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]
    return out


ODD = [
    "", None, "a@b.c", "a@b.c_d@e.f x@@y.z a..b@c-.d-", "é@b.c 日a@b.cd,1.2.3.4.5.6.7.8 256.1.1.1 001.002.000.255 😀 x@y.zz",
    "4111 1111-1111 1111 4111111111111112 41111111111111110", "+1 (456) 555-2186 +1+23456789 +12 3456.789-0) +1234567890123456",
    "0" * 50000, "a." * 30000 + "@b.c", "1." * 30000, "x@" + "a." * 30000 + "b", "1 " * 20000, "+" + "1(" * 20000 + "1",
]


def spans_of(docs):
    return [(r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans]) for r in pii.personal_data(docs).collect()]


def base_of(spans):
    return [s for s in spans if s[0] in pii.BASE]


def test_base_spans(spark):
    prepare(spark)
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab1234.@+- ()é9") for _ in range(rng.randrange(120))) for _ in range(400)]
    rows = list(enumerate(texts)) + [(None, "a@b.cd"), (1, "a@b.cd")]
    found = Counter((i, tuple(base_of(s))) for i, s in spans_of(docs_of(spark, rows)))
    assert found == Counter((i, tuple(plain_spans(t))) for i, t in rows)
    assert pii.personal_data(docs_of(spark, [])).count() == 0


def test_added_spans_and_redaction(spark):
    prepare(spark)
    rng = random.Random(9)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)]
    secrets = [f'token = "{key}" in use' for key in keys]
    plain = [f"w{i} is 12 or chapter{i} of part 3" for i in range(200)]
    docs = docs_of(spark, list(enumerate(secrets + plain + ["mail é a@b.cd 1.2.3.4!"])))
    model = pii.fit(docs)
    spans = dict(spans_of(docs))
    assert all([k for k, _, _ in spans[i]] == ["secret"] for i in range(30))
    assert not any(spans[i] for i in range(30, 230))
    out = pii.redacted(docs, model)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[0] == 'token = "[SECRET]" in use' and texts[40] == plain[10] and texts[230] == "mail é [EMAIL] [IP]!"


def test_numbers_side_by_side_and_long_handles(spark):
    prepare(spark)
    model = pii.Model(0.5, (), (1.0, -1.0, 1.0, *(0.0,) * (len(pii.FEATURES) - 3)), -0.5)  # handles, but no numbers of its own accord
    texts = ["é 7536784127813050 4845168114407329 x", "2353820953013749 4550997810720808", "4111 1111 1111 1111-5500 0000 0000 0004",
             "1 " * 60, "9" * 40, "L" * 70 + "@" + "h" * 80 + " x"]
    docs = docs_of(spark, list(enumerate(texts)))
    found = {r.doc_id: {(x.kind, texts[r.doc_id][x.start:x.stop]) for x in r.spans} for r in pii.personal_data(docs, model).collect()}
    assert found[0] == {("number", "7536784127813050"), ("number", "4845168114407329")}
    assert found[1] == {("number", "4550997810720808")}
    assert found[2] >= {("number", "4111 1111 1111 1111"), ("number", "5500 0000 0000 0004")}
    assert not found[3] and not found[4] and found[5] == {("handle", texts[5][:-2])}
    text = "call 212 555 0147 212 555 0199 now"
    row = pii.with_candidates(pii.with_base(docs_of(spark, [(1, text)]), "text")).first()
    voted = {text[c.start:c.stop]: c.votes for c in row.candidates}
    grouped = 1 << list(pii.LABELERS).index("grouped")
    assert {"212 555 0147", "212 555 0199"} <= set(voted) and voted["212 555 0147"] & grouped and voted["212 555 0199"] & grouped
    assert all(sum(c.isdigit() for c in piece) <= pii.MOST_DIGITS for piece in voted)
    assert pii.redacted(docs, model).where("doc_id = 0").first().text == "é [NUMBER] [NUMBER] x"


def test_estimate_separates_labelers():
    prior, fires, belief = pii.estimate([(0, 900.0), (0b11, 80.0), (0b1, 20.0)])
    assert belief[0b11] > 0.9 > 0.1 > belief[0] and all(p >= o for o, p in fires) and 0 < prior < 0.5


def test_licenses(spark):
    prepare(spark)
    rng = random.Random(2)
    plain = lambda n: " ".join(f"word{rng.randrange(500)}" for _ in range(n))
    texts = [plain(rng.randrange(5, 200)) for _ in range(80)]
    notices = {"apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.",
               "gpl": "This work is licensed under the GNU General Public License, version 3.", "creative_commons": "Licensed under CC BY-NC 4.0.",
               "reserved": "All rights reserved."}
    cases = [(f, plain(30) + "\n" + n + "\n" + plain(30)) for f, n in notices.items()] + [(f, plain(60) + " " + n + " " + plain(50)) for f, n in notices.items()]
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, (_, t) in enumerate(cases)] + [(2000, ""), (2001, None), (None, "Released under the MIT License.")]
    docs = docs_of(spark, rows)
    found = {r.doc_id: {f.family for f in r.found if f.confirmed} for r in license_scan.licenses(docs).collect()}
    assert all(not found[i] for i in range(80)) and not found[2000] and not found[2001] and found[None] == {"mit"}
    assert sum(found[1000 + i] == {f} for i, (f, _) in enumerate(cases)) >= len(cases) - 1
    assert license_scan.licenses(docs.limit(0)).count() == 0


def test_wrapped_notices(spark):
    prepare(spark)
    rng = random.Random(3)
    plain = lambda n: " ".join(f"word{rng.randrange(500)}" for _ in range(n))
    model = license_scan.train(*license_scan.examples([plain(100) for _ in range(80)]))
    notices = [(f, n) for f, ns in license_scan.NOTICES.items() for n in ns]
    for width in (40, 80):
        texts = [plain(30) + "\n\n" + "\n".join(textwrap.wrap(n, width)) + "\n\n" + plain(30) for _, n in notices]
        found = license_scan.found_in(pa.array(texts), model)
        missed = [(f, t) for (f, t), r in zip(notices, found) if f not in {x["family"] for x in r if x["confirmed"]}]
        assert not missed
    assert not any(x["confirmed"] for x in license_scan.found_in(pa.array(["All rights\n\nreserved", "", None]), model)[0])


def plain_page(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)) if fits else None


URLS = [None, "", "no scheme", "http://", "http://A.Net", "http://a.net/", "x://EXAMPLE.net/en/a?b#c", "https://b.example.net/en", "http://example.com/de/x#/en/",
        "http://notexample.com/de/", "http://s.example.com?x=/de/", "ftp://u.org/fr/", "http://org/fr/x", "http://É.ORG/fr/", "a://b://c.net/", "http://a.net/x\ny"]


def test_rules(spark):
    prepare(spark)
    pages = spark.createDataFrame([(i, u, "<p>", "h", 1, "r") for i, u in enumerate(URLS)] + [(None, "http://z.net/", None, "h", 1, "r")],
                                  "page_id long, url string, html string, host string, trust int, rule string")
    for r in url_filter.judged_pages(pages).collect():
        host, path, rule = plain_page(URLS[r.page_id] if r.page_id is not None else "http://z.net/")
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        if rule:
            assert r.verdict == rule.verdict
        assert r.verdict in ("allow", "block")
    assert url_filter.judged_pages(pages.limit(0)).count() == 0


def test_distrust_flows_against_links(spark):
    prepare(spark)
    link = lambda *to: "".join(f'<a class="x" href="{t}">x</a>' for t in to)
    pages = spark.createDataFrame([
        (1, "http://farm.example.com/a", link("http://bad.net/x", "//worse.net/y", "/own")), (2, "http://bad.net/", link("/")), (3, "http://worse.net/", ""),
        (4, "http://good.org/fr/", link("https://friend.example.com/")), (5, "http://friend.example.com/", ""), (6, "http://lone.example.com/", ""),
        (7, "http://sub.farm.example.com/", "")], "page_id long, url string, html string")
    verdict = {r.page_id: r.verdict for r in url_filter.judged_pages(pages).collect()}
    assert verdict == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block"}


def test_rank_is_that_of_the_power_method(spark):
    prepare(spark)
    rng = random.Random(1)
    nodes = [f"h{i}" for i in range(8)]
    edges = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(20)}
    edges = {(a, b) for a, b in edges if a != b and a != "h3"}
    seeds = {"h0": 2.0, "h5": 1.0}
    links = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "src string, dst string, weight double")
    got = {r.host: r.mass for r in url_filter.personalised_rank(links, spark.createDataFrame(list(seeds.items()), "host string, mass double"), tolerance=1e-3).collect()}
    seed = {n: seeds.get(n, 0) / 3 for n in nodes}
    rank = dict(seed)
    for _ in range(200):
        new = dict.fromkeys(nodes, 0.0)
        for a, b in edges:
            new[b] += 0.85 * rank[a] / sum(x == a for x, _ in edges)
        rest = 1 - sum(new.values())
        rank = {n: new[n] + rest * seed[n] for n in nodes}
    assert all(abs(got.get(n, 0) - rank[n]) < 5e-3 for n in nodes)


def test_rank_reaches_far_hosts(spark):
    prepare(spark)
    links = spark.createDataFrame([(f"c{i}", f"c{i + 1}", 1.0) for i in range(20)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("c0", 1.0)], "host string, mass double")
    got = {r.host: r.mass for r in url_filter.personalised_rank(links, seeds, tolerance=1e-3).collect()}
    first = 0.15 / (1 - 0.85 ** 21)  # what arrives at the end goes back to the seed
    assert len(got) == 21 and all(abs(got[f"c{i}"] - first * 0.85 ** i) < 5e-3 for i in range(21))
