"""Words, window values, token ids, their files, packing and quality measures against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import packing, quality, token_store, tokens
from millrace.llm.common import prepare
from millrace.llm.words import ByteHash, Words, covered, from_planes, planes

ODD = [
    "", "a", " ", "  ", "\n", " a", "a ", "a\n", "\na\n\nb\n c", "it's, it's. x's ,y", "a b   c", "×, ÷. é, É.é ×é",
    "1,000.5 a1, 2. b", "日本, 語. 　 x", "<|endoftext|> a <|endoftext|>b c<|endoftext|>", "a\tb \t c", "a \nb\n c \n d",
    "\x0b\x0c. \x1f, \x85, x​, y", "'s, 't. ''. ,.,. .,", "don't, can't. we're.\nYou're\nI", "a,b.c\n,d\n.e ,f .g",
    "x \x1c y \x1c. \x1c, z", "a" * 3000, " . " * 500, "é, ́. ª, µ.", None, "the same words the same words",
]
ALPHABET = st.sampled_from(list("ab,. \n\té×'s1日 "))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_vocabulary())


LIBRARY = library()


def plain_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=40)), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_of_a_batch(texts):
    words = Words(pa.array(texts, type=pa.string()))
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for t in texts for w in plain_words(t)]
    assert words.counts.tolist() == [len(plain_words(t)) for t in texts]


@given(st.lists(st.text(ALPHABET, max_size=30), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_equal_words_and_windows_have_equal_values(texts):
    by = ByteHash(5)
    words = Words(pa.array(texts))
    values = words.hashes(by)
    names = [w for t in texts for w in plain_words(t)]
    assert len(set(values.tolist())) == len(set(names))
    assert len(set(zip(names, values.tolist()))) == len(set(names))
    for size in (1, 2, 3, 5):
        windows = by.windows(values, size)
        seen = [tuple(names[i:i + size]) for i in range(max(0, len(names) - size + 1))]
        assert len(windows) == len(seen)
        assert len(set(windows.tolist())) == len(set(seen)) == len(set(zip(seen, windows.tolist())))


def test_long_text_is_hashed_in_blocks():
    import millrace.llm.words as module

    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = Words(pa.array([text]))
    expected = whole.hashes(ByteHash(5))
    block, module._BLOCK = module._BLOCK, 100
    try:
        assert (whole.hashes(ByteHash(5)) == expected).all()
    finally:
        module._BLOCK = block


def test_planes_and_covered():
    values = np.array([0, 1, 2**32 - 1, 70000], dtype=np.uint32)
    assert from_planes(planes(values)).tolist() == values.tolist()
    assert covered(np.array([0, 2, 2]), 3, 7).tolist() == [True] * 5 + [False] * 2


def test_ids_equal_the_library_on_odd_texts():
    encode = tokens.Encoder(tokens.default_vocabulary())
    for _ in range(2):
        ids, first = encode(pa.array(ODD))
        for i, text in enumerate(ODD):
            assert ids[first[i]:first[i + 1]].tolist() == plain_ids(text), text


@given(st.lists(st.text(ALPHABET, max_size=40), max_size=4))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_library(texts):
    ids, first = tokens.encoder(tokens.default_vocabulary())(pa.array(texts, type=pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [plain_ids(t) for t in texts]


def test_encoder_forgets_when_full(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 50)
    encode = tokens.Encoder(tokens.default_vocabulary())
    for k in range(20):
        text = " ".join(f"word{k}x{j}" for j in range(20))
        assert encode(pa.array([text]))[0].tolist() == plain_ids(text)
        assert encode.n <= 70


def test_remembered_pieces_take_little_memory():
    encode, n = tokens.Encoder(tokens.default_vocabulary()), 600_000
    a, b = np.random.default_rng(4).integers(1, 1 << 63, (2, n)).astype(np.uint64)
    ids = [np.array([7, 8, 9], dtype=np.uint32)] * 50_000
    for at in range(0, n, 50_000):
        encode._remember(a[at:at + 50_000], b[at:at + 50_000], ids)
    assert (encode._find(a, b) == np.arange(n)).all() and (encode._find(a, b + np.uint64(1)) == -1).all()
    held = [v for v in vars(encode).values() if isinstance(v, np.ndarray)]
    assert sum(v.nbytes for v in held) <= 128 * n


def test_new_pieces_are_encoded_without_a_call_or_offsets_for_each():
    class Library:
        def __init__(self, inner):
            self.inner, self.calls = inner, []

        def encode_batch_fast(self, texts, **options):
            self.calls.append(len(texts))
            return self.inner.encode_batch_fast(texts, **options)

    words = [f"w{k}\u00e9{k * 7919 % 1000}\u2028x" if k % 97 == 0 else f"w{k}-{k * 7919 % 1000}," for k in range(4000)]
    words += ["\u00a0", "a\u00a0b", "\u4e00", "\ue000", "x\x1cy", "caf\u00e9"]
    text = " ".join(words) + "\n" + "  odd  \t run"
    encode = tokens.Encoder(tokens.default_vocabulary())
    encode.library = library = Library(encode.library)
    assert encode(pa.array([text]))[0].tolist() == plain_ids(text)
    assert len(library.calls) == 2 and library.calls[0] == 1 and library.calls[1] < 100


def test_token_tasks_and_shards_give_memory_back(spark, monkeypatch):
    wrapped, freed = [], []
    monkeypatch.setattr(token_store, "giving_back", lambda run: wrapped.append(run.__qualname__) or run)
    prepare(spark)
    tokens_of = token_store.tokens(spark.createDataFrame([(1, "one two")], "doc_id long, text string"))
    assert len(wrapped) == 1 and tokens_of.columns == ["doc_id", "n", "ids"]
    monkeypatch.setattr(packing, "give_back", lambda: freed.append(1))
    group = pa.table({"shard": [0], "doc_id": [1], "tie": [5], "ids": [tokens.packed(np.array([3, 0], dtype=np.uint32))]})
    assert packing._shard(8, False)(group).column("length").to_pylist() == [2]
    assert freed == [1]


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=40))
@settings(max_examples=60, deadline=None)
def test_code_lengths_are_optimal(counts):
    import heapq

    counts = np.array(counts)
    used = counts[counts > 0].tolist()
    lengths = token_store.code_lengths(counts)
    assert ((lengths > 0) == (counts > 0)).all()
    heap, cost = list(used), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    if len(used) > 1:
        assert (counts * lengths).sum() == cost  # 40 symbols never need more than the limit here, or Kraft fails
        assert sum(2.0 ** -int(x) for x in lengths if x) == 1


def test_code_lengths_keep_the_limit():
    fibonacci = [1, 1]
    while len(fibonacci) < 30:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lengths = token_store.code_lengths(np.array(fibonacci), 8)
    assert lengths.max() == 8 and sum(2.0 ** -int(x) for x in lengths) <= 1


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_block_round_trip(n):
    ids = np.random.default_rng(n).zipf(1.3, size=n).clip(0, 50000).astype(np.uint32)
    book = token_store.Codebook(token_store.code_lengths(np.bincount(ids, minlength=1)))
    checkpoints, payload = book.encode(ids)
    assert book.decode(n, checkpoints, payload).tolist() == ids.tolist()


def documents(spark, texts, ids=None, **more):
    rows = [(i if ids is None else ids[i], t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, start long")


def test_token_files_round_trip(spark, folder):
    prepare(spark)
    ids = [None if i == 3 else (i * 7) % 11 for i in range(len(ODD))]
    token_store.write_token_files(documents(spark, ODD, ids), f"{folder}/t")
    rows = token_store.read_token_files(spark, f"{folder}/t").collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(plain_ids(t))) for i, t in zip(ids, ODD))
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda x: (x is not None, x))
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    sums = token_store.token_checksums(spark, f"{folder}/t").collect()
    assert Counter(r.ids_crc32 for r in sums) == Counter(zlib.crc32(np.array(plain_ids(t), dtype="<u4").tobytes()) for t in ODD)


def test_token_files_of_nothing(spark, folder):
    prepare(spark)
    token_store.write_token_files(documents(spark, []), f"{folder}/t")
    assert token_store.read_token_files(spark, f"{folder}/t").count() == 0


def check_pieces(rows, texts):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, text in texts.items():
        ids, got = plain_ids(text), sorted(by_doc.pop(doc), key=lambda r: r.start)
        assert all(r.doc_tokens == len(ids) for r in got)
        assert [r.start for r in got] == np.cumsum([0] + [r.length for r in got])[:-1].tolist()
        joined = b"".join(bytes(r.ids) for r in got)
        assert np.frombuffer(joined, dtype="<u4").tolist() == ids
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in got)
    assert not by_doc
    for got in by_sequence.values():
        got = sorted(got, key=lambda r: r.offset)
        assert [r.offset for r in got] == np.cumsum([0] + [r.length for r in got])[:-1].tolist()
        total = sum(r.length for r in got)
        assert total <= 1024 and total & (total - 1) == 0


def test_packing_places_each_id_once(spark):
    prepare(spark)
    texts = {i: t for i, t in enumerate(ODD * 3 + ["word other " * 900, "one two three " * 150])}
    docs = documents(spark, list(texts.values()))
    check_pieces(packing.packed_sequences(docs).collect(), texts)
    assert packing.packed_sequences(docs.limit(0)).count() == 0
    repeated = packing.packed_sequences(documents(spark, ["x y z"] * 4, [None, None, 1, 1])).collect()
    assert sum(r.length for r in repeated) == 4 * len(plain_ids("x y z"))


def test_packing_prefers_neighbours():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * k, 1000 * k + 300, size=(6, 400)) for k in range(1, 6)]
    docs = [row.astype(np.uint32) for group in zip(*topics) for row in group]
    together = Counter()
    seen = {}
    for doc, _, size, sequence, _ in packing.pack(docs):
        seen.setdefault(sequence, []).append(doc % 5)
    for topics_here in seen.values():
        together[len(set(topics_here)) == 1] += 1
    assert together[True] > 2 * together[False]


def plain_measures(text):
    words = plain_words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_quality_measures(spark):
    prepare(spark)
    texts = ODD + ["a b c d e f g h " * 5, "x\nx\n \n \ny\nx", "# $ % é日| <a>", " ".join(f"w{i}" for i in range(50))]
    rows = quality.judged(documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = plain_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, texts[r.doc_id]
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r.kept and r.base_failed)
    assert quality.judged(documents(spark, [])).count() == 0


def test_quality_limits_follow_the_group(spark):
    prepare(spark)
    clean = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(60)]
    junk = [" ".join(f"w{i}$$$ x{j}&&&" for j in range(20)) for i in range(5)]
    rows = {r.doc_id: r.kept for r in quality.judged(documents(spark, clean + junk)).collect()}
    assert all(rows[i] for i in range(60)) and not any(rows[i] for i in range(60, 65))
    rows = spark.createDataFrame([(i, " ".join(f"w{i}$$$ x{j}&&&" for j in range(20)), None, None) for i in range(40)],
                                 "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in quality.judged(rows).collect())  # where it is the rule, it isn't odd


def test_two_groups_judge_a_measure_differently_both_ways(spark):
    """Symbols are usual in one source and long words in the other; each rejects what is usual in the other."""
    prepare(spark)

    def text(i, symbols, length):
        return " ".join(f"{'$' * symbols if j % 2 else ''}{f'{i}x{j}y'.ljust(length + (i + j) % 2, 'z')}" for j in range(40))

    code = [(i, text(i, 2 if i % 3 else 0, 7), "en", "code") for i in range(120)]
    prose = [(200 + i, text(i, 0, 7 + i % 9), "en", "prose") for i in range(120)]
    odd = [(400, text(1, 2, 7), "en", "code"), (401, text(1, 2, 7), "en", "prose"),
           (402, text(1, 0, 15), "en", "code"), (403, text(1, 0, 15), "en", "prose")]
    rows = spark.createDataFrame(code + prose + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judged(rows).collect()}
    assert [kept[i] for i in range(400, 404)] == [True, False, False, True]
    assert all(kept[i] for i in range(120)) and all(kept[200 + i] for i in range(120))


def test_quality_with_and_without_limits_of_its_own(spark):
    prepare(spark)
    short = spark.createDataFrame([(1, "a b", "en", "s"), (2, None, None, None)], "doc_id long, text string, lang string, source string")
    assert not any(r.kept for r in quality.judged(short).collect())
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "en", "a") for i in range(60)]
    rows += [(100 + i, " ".join(f"w{i}$$ x{j}" for j in range(20)), "en", "b") for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    few = {r.doc_id: r.kept for r in quality.judged(frame).collect()}
    own = {r.doc_id: r.kept for r in quality.judged(frame, least=5).collect()}
    assert not any(few[100 + i] for i in range(5)) and all(own[100 + i] for i in range(5)) and all(own[i] for i in range(60))
