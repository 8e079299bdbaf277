"""Toxicity from a learned lexicon, misspellings included, and the context of each hit.

1. Terms (words and word beginnings) that mark toxic training texts are learned: they must be far more
   frequent there than chance allows, counting a term once per text and per pair of neighbouring words, so
   that copied passages are no evidence.
2. The terms form a trie. A Levenshtein automaton runs over it: the states are sets of (trie node, edits),
   made when first needed and kept, so that most words are refused after a few table look-ups.
3. Each (term, edits) gets the log-odds of the training texts it hits, so loose matches that clean texts
   have as well count for nothing.
4. A hit's window tells quotation from abuse: quotation marks around it or words of reporting near it move
   its weight to another feature. A logistic regression over both turns them into a score.

Labels are only used of rows whose crc32(doc_id as text) mod 4 is not 2, at most ``TRAIN_ROWS`` of them,
chosen by a hash. All texts are scored, and whole.
"""

from __future__ import annotations

import math
import string
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import batches_of, giving_back, rows_where
from millrace.llm.common import kept, registered, table
from millrace.llm.fitting import regression

#: The labelled rows that the lexicon and the model are fitted on, at most.
TRAIN_ROWS = 40_000
#: The remainder of crc32(doc_id) mod 4 whose labels are never read.
HELD_OUT = 2
PREDICT = 0.3
#: Beginnings of words that are tried as terms, in characters; a term's evidence over chance; its purity.
STEMS, EVIDENCE, PURITY = range(4, 9), 2.0, 0.9
#: Words to each side of a hit that are looked at.
WINDOW = 6
#: Words a process remembers the match of.
MOST_WORDS = 1 << 16
#: Steps of the automaton a process remembers; then its tables are built anew.
MOST_MOVES = 1 << 17

# Quotation marks and words of reporting in the corpus's languages.
QUOTES = "\"“”„«»‹›"
REPORTING = frozenset((
    "said says wrote writes called calls quote quoted quotes according insult slur word term "
    "sagte schrieb nannte zitat zitierte laut wort dit écrit appelé citation selon mot "
    "dijo escribió llamó cita según palabra"
).split())

_STRIP = string.punctuation + QUOTES + "¡¿…’‘"


def normal(word: str) -> str:
    return word.lower().strip(_STRIP)


def edits_of(term: str, stem: bool) -> int:
    """The edits a term allows: loose beginnings of words would match nearly anything."""
    return 0 if len(term) < (6 if stem else 5) else 1 if len(term) < 9 else 2


class Lexicon:
    """The trie of terms and the lazily built automaton over it; a term ending in * is a beginning of words."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.word_end: dict[int, tuple[str, int]] = {}
        self.stem_end: dict[int, tuple[str, int]] = {}
        self.reach = [0]
        for term in sorted(terms):
            stem, node = term.endswith("*"), 0
            text = term[:-1] if stem else term
            edits = edits_of(text, stem)
            self.reach[0] = max(self.reach[0], edits)
            for c in text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], edits)
            (self.stem_end if stem else self.word_end)[node] = (term, edits)
        self._begin()

    def _begin(self) -> None:
        """Empty tables of states and of steps between them; the trie stays."""
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0}) if len(self.children) > 1 else -1

    def _state(self, edits: dict[int, int]) -> int:
        """The number of a set of (node, fewest edits); a missing letter moves on without reading. -1 if empty."""
        todo = list(edits)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                e = edits[node] + 1
                if e <= self.reach[child] and e < edits.get(child, 99):
                    edits[child] = e
                    todo.append(child)
        if not edits:
            return -1
        key = frozenset(edits.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(edits)
        return self.numbers[key]

    def _move(self, state: int, c: str) -> int:
        after: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.reach[node] and e < after.get(node, 99):
                after[node] = e

        for node, e in self.states[state].items():
            put(node, e + 1)
            for letter, child in self.children[node].items():
                put(child, e + (letter != c))
        return self._state(after)

    def match(self, word: str) -> tuple[str, int] | None:
        """The term within its allowed edits of the word (or of its beginning) with the fewest edits."""
        if len(self.moves) >= MOST_MOVES:
            self._begin()
        state, found = self.start, []
        for c in word:
            if state < 0:
                break
            key = (state, c)
            state = self.moves[key] if key in self.moves else self.moves.setdefault(key, self._move(state, c))
            if state >= 0:
                found += [(e, *self.stem_end[n]) for n, e in self.states[state].items() if n in self.stem_end]
        else:
            if state >= 0:
                found += [(e, *self.word_end[n]) for n, e in self.states[state].items() if n in self.word_end]
        found = [(e, term) for e, term, most in found if e <= most]
        if not found:
            return None
        e, term = min(found)
        return term, e


@dataclass
class Model:
    """A lexicon with the log-odds of its (term, edits), and the weights of the features."""

    terms: list[str]
    odds: dict[tuple[str, int], float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])
    bias: float = 0.0

    def score(self, features: tuple[float, float, float]) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, features))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


class _Matches(dict):
    """The match of each word as it stands in a text."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = self.lexicon.match(normal(word))
        return found


def quoted(words: list[str], i: int) -> bool:
    """Whether the window around word i shows quotation: an open quotation mark, or a word of reporting."""
    before, after = words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW]
    marks = [sum(w.count(q) for w in part for q in QUOTES) for part in (before, after)]
    own = words[i].strip("".join(set(string.punctuation) - {'"'}))
    opened = marks[0] + (own[:1] in QUOTES and own != "")
    closed = marks[1] + (own[-1:] in QUOTES and own != "")
    if opened % 2 and closed % 2:
        return True
    return any(normal(w) in REPORTING for w in before + after)


def hits(text: str | None, matches: _Matches) -> list[tuple[str, int, bool]]:
    """(term, edits, quoted) of each matching word."""
    words = (text or "").split()
    return [(*m, quoted(words, i)) for i, m in enumerate(map(matches.__getitem__, words)) if m]


def features(found: list[tuple[str, int, bool]], odds: dict[tuple[str, int], float]) -> tuple[float, float, float]:
    """Evidence of abuse, of quotation, and the number of telling hits (logarithms)."""
    abuse = {(t, e) for t, e, q in found if not q}
    quote = {(t, e) for t, e, q in found if q}
    weight = lambda pairs: math.log1p(sum(max(0.0, odds.get(p, 0.0)) for p in pairs))
    telling = sum(odds.get((t, e), 0.0) > 0 and not q for t, e, q in found)
    return weight(abuse), weight(quote), math.log1p(telling)


def _terms(batches):
    """Each term of a batch of toxic texts with the neighbours it has there; its first row counts the texts it is in."""
    schema = pa.schema([("term", pa.string()), ("around", pa.int64()), ("texts", pa.int64())])

    def rows():
        for batch in batches:
            texts, contexts = Counter(), defaultdict(set)
            for text in batch.column("text").to_pylist():
                words = [normal(w) for w in (text or "").split()]
                seen = set()
                for i, word in enumerate(words):
                    around = hash((words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
                    for term in {word, *(word[:n] + "*" for n in STEMS if len(word) >= n)}:
                        seen.add(term)
                        contexts[term].add(around)
                texts.update(t for t in seen if t not in ("", "*"))
            for term, n in texts.items():
                for k, around in enumerate(sorted(contexts[term])):
                    yield {"term": term, "around": around, "texts": 0 if k else n}

    yield from batches_of(rows(), schema)


def _chosen_in(terms: frozenset):
    def run(batches):
        counts = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen = set()
                for word in map(normal, (text or "").split()):
                    seen.update(t for t in (word, *(word[:n] + "*" for n in STEMS)) if t in terms)
                counts.update(seen)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())],
                                         names=["term", "texts"])

    return run


def _found_in(terms: list[str]):
    def run(batches):
        matches = _Matches(Lexicon(terms))
        for batch in batches:
            found = [hits(t, matches) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic").cast(pa.int32()),
                pa.array([[{"term": t, "edits": e, "quoted": q} for t, e, q in f] for f in found],
                         type=pa.list_(pa.struct([("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_())]))),
            ], names=["toxic", "hits"])

    return run


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of at most about TRAIN_ROWS labelled documents outside the held-out quarter."""
    allowed = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != HELD_OUT)
    allowed = allowed.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, TRAIN_ROWS / max(1, allowed.count()))
    chosen = allowed.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # bounded by TRAIN_ROWS


def learn_terms(rows: DataFrame, toxic: int, clean: int) -> list[str]:
    """Terms whose texts are toxic far more often than chance allows, in ever new neighbourhoods."""
    if not toxic:
        return []
    found = rows.where("toxic = 1").select("text").mapInArrow(giving_back(_terms), "term string, around long, texts long")
    found = found.groupBy("term").agg(F.sum("texts").alias("texts"), F.count_distinct("around").alias("contexts"))
    base = min(max(toxic / (toxic + clean), 1e-6), 1 - 1e-6)
    least = max(2, math.ceil(EVIDENCE / -math.log(base)))
    candidates = {r["term"]: (r["texts"], min(r["texts"], r["contexts"])) for r in found.where(
        (F.col("texts") >= least) & (F.col("contexts") >= least)).collect()}  # bounded: of TRAIN_ROWS texts
    others = rows.where("toxic = 0").select("text").mapInArrow(_chosen_in(frozenset(candidates)), "term string, texts long")
    in_clean = {r["term"]: r["n"] for r in others.groupBy("term").agg(F.sum("texts").alias("n")).collect()}
    chance, good = math.log(max(2, len(candidates))) + EVIDENCE, {}
    for term, (texts, t) in candidates.items():  # purity is that of all texts, evidence that of new neighbourhoods
        c = in_clean.get(term, 0)
        rate = texts / (texts + c)
        gain = t * math.log(rate / base) + (c * math.log((1 - rate) / (1 - base)) if c else 0.0)
        if rate >= PURITY and gain >= chance:
            good[term] = rate
    # a beginning stands for the longer ones; whole words stay, as they may be misspelt
    stems = {t for t in good if t.endswith("*")}
    return sorted(t for t in good if not t.endswith("*") or not any(t[:n] + "*" in stems for n in STEMS if n < len(t) - 1))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows; without toxic ones every text gets a low score."""
    rows = kept(training_rows(docs, labels), "toxicity-training")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    terms = learn_terms(rows, toxic, clean)
    if not terms:
        return Model([], bias=math.log((toxic + 0.5) / (clean + 10)))
    found = rows.mapInArrow(giving_back(_found_in(terms)), "toxic int, hits array<struct<term:string,edits:int,quoted:boolean>>").collect()  # TRAIN_ROWS
    per_text = [(r["toxic"], [(h["term"], h["edits"], h["quoted"]) for h in r["hits"]]) for r in found]
    counts = {0: Counter(), 1: Counter()}
    for y, f in per_text:
        counts[1 if y == 1 else 0].update({(t, e) for t, e, _ in f})
    odds = {p: math.log((counts[1][p] + 0.25) / (toxic + 1)) - math.log((counts[0][p] + 0.5) / (clean + 1)) for p in counts[0] | counts[1]}
    # edits not seen in training count a little less than the term itself
    for t in terms:
        exact = odds.get((t, 0), 0.0)
        for e in range(1, edits_of(t.rstrip("*"), t.endswith("*")) + 1):
            odds.setdefault((t, e), max(0.0, exact - 1.0 * e))
    w = regression(np.array([features(f, odds) for _, f in per_text]), np.array([float(y == 1) for y, _ in per_text]))
    return Model(terms, odds, [float(v) for v in w[:-1]], float(w[-1]))


def scored(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, hits, quoted_hits), one row per input row; ``score`` from 0 to 1, higher: likelier toxic.

    Null and empty texts have no hits and get the score of a text without any. Repeated rows and null
    ids are scored like others; an empty table gives no rows. Other columns are ignored.
    """

    def run(batches):
        matches = _Matches(Lexicon(model.terms))
        for batch in batches:
            found = [hits(t, matches) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([model.score(features(f, model.odds)) for f in found], type=pa.float64()),
                pa.array([len(f) for f in found], type=pa.int64()), pa.array([sum(q for _, _, q in f) for f in found], type=pa.int64()),
            ], names=["doc_id", "score", "hits", "quoted_hits"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(giving_back(run), "doc_id long, score double, hits long, quoted_hits long")


def without_toxic(docs: DataFrame, model: Model, threshold: float = PREDICT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, unchanged."""

    def test():
        matches = _Matches(Lexicon(model.terms))
        return lambda batch: [model.score(features(hits(t, matches), model.odds)) < threshold for t in batch.column(text).to_pylist()]

    return rows_where(docs, test)


@registered()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their toxicity score."""
    docs = table(spark, folder, "documents")
    out = scored(docs, fit(docs, table(spark, folder, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"),
                      "hits", "quoted_hits")
