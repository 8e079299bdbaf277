"""Personal data: fixed base patterns, and a weakly supervised classifier for what they leave.

Everything that touches a text is a DataFrame expression. A pattern's places come from splitting a text at
its matches: the pieces between give each match its offset (in code points) and its left context.

Beyond the base, loose candidate patterns are judged: labelers (patterns, gazetteers of cue words, context)
vote on each candidate; expectation-maximisation over the counted vote patterns estimates how reliable each
labeler is; a logistic regression on shape features learns from the resulting probabilities, and its score
becomes an expression again. Only the counts of vote and feature patterns reach the driver: at most a few
thousand rows whatever the input.

The patterns are possessive and may not begin inside a run, which gives the same matches as the plain ones and
keeps them linear on very long runs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import registered, table
from millrace.llm.fitting import regression

#: Base kinds in their order: pattern, what a text must have to be searched, the condition on a match.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
BASE = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "[@]", "true"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]", rf"x.match rlike '^{_PART}(?:\\.{_PART}){{3}}$'"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", "x.digits BETWEEN 13 AND 19 AND {luhn}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "[+]", "x.digits BETWEEN 9 AND 15"),
}
#: The digits of the longest number; a longer run is several numbers next to each other.
MOST_DIGITS = 19
#: Candidates beyond the base: handles, numbers with separators, long mixed strings.
CANDIDATES = {
    "handle": (r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++", "[@]", "true"),
    "number": (r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]?[0-9])++(?![0-9A-Za-z])", "[0-9]", f"x.digits BETWEEN 7 AND {MOST_DIGITS}"),
    "secret": (r"(?:\G|(?<![A-Za-z0-9_/+=-]))[A-Za-z0-9_/+=-]{16,}+", "[0-9]",
               "x.digits > 2 AND x.match rlike '[A-Za-z]' AND x.digits * 10 > length(x.match)"),
}
KINDS = [*BASE, *CANDIDATES]
# Cue words in the corpus's languages, and domains kept for mail.
CUES = {
    "handle": "mail email e-mail contact write correo courriel kontakt",
    "number": "phone tel telephone call mobile fax card visa account iban number teléfono llamar tarjeta cuenta téléphone "
              "appeler carte compte telefon anrufen karte konto nummer",
    "secret": "token secret password passwd key apikey api_key credential clave contraseña jeton clé passwort schlüssel",
}
MAIL_HOSTS = "gmail yahoo hotmail outlook proton icloud mail example"
#: Characters of left context that labelers look at.
LEFT = 32

LABELERS = {
    "cue": "x.kind_cue",
    "assigned": "x.left rlike '[=:][\\\\s\"\\']*$'",
    "quoted": "x.left rlike '[\"\\']$'",
    "grouped": "x.kind = 'number' AND x.match rlike '^[0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{3,4}$'",
    "hex": "x.kind = 'secret' AND x.match rlike '^[0-9a-fA-F]{32,}$'",
    "mail_host": f"x.kind = 'handle' AND lower(x.match) rlike '@(?:{MAIL_HOSTS.replace(' ', '|')})'",
    "mixed": "x.kind = 'secret' AND x.match rlike '[a-z]' AND x.match rlike '[A-Z]' AND x.match rlike '[0-9]'",
}
FEATURES = {
    "handle": "x.kind = 'handle'", "number": "x.kind = 'number'", "secret": "x.kind = 'secret'",
    "long": "length(x.match) >= 24", "very_long": "length(x.match) >= 36", "separated": "x.match rlike '[ ().-]'",
    "mostly_digits": "x.digits * 2 > length(x.match)", "cue_near": "x.kind_cue", "assigned": LABELERS["assigned"],
    "dictionary": "x.match rlike '^[A-Za-z]{4,}[0-9]{1,4}$'",
}
#: A number like this that passes the check sum is a card to the base rules too; the bit after the features says so.
CARD, SURE = "^[0-9]{3,}(?:[ -][0-9]{3,})*$", 1 << len(FEATURES)
_CANDIDATE = "struct<kind:string,start:int,stop:int,votes:int,features:int>"


def _luhn(digits: str) -> str:
    """Whether a string of digits passes the check sum; from the right, every second digit is doubled."""
    digit = f"int(substr({digits}, length({digits}) - i, 1))"
    return (f"aggregate(sequence(0, length({digits}) - 1), 0, (sum, i) -> sum + CASE WHEN i % 2 = 0 THEN {digit} "
            f"WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0")


def _places(kind: str, pattern: str, gate: str) -> Column:
    """The matches of a pattern in the column ``body``: kind, start, stop, match, digits, left."""
    found = F.when(F.col("body").rlike(gate), F.regexp_extract_all("body", F.lit(pattern), 0))
    pieces = F.split("body", pattern, -1)
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("piece"), found.alias("match"))
    empty = F.array().cast("array<struct<kind:string,start:int,stop:int,match:string,digits:int,left:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["0"])
        stop = start + F.length(x["1"])
        row = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), x["1"].alias("match"),
                       F.length(F.regexp_replace(x["1"], "[^0-9]", "")).alias("digits"), F.right(x["0"], F.lit(LEFT)).alias("left"))
        return F.struct(stop.alias("at"), F.concat(acc["rows"], F.array(row)).alias("rows"))

    placed = F.when(F.size(found) > 0, F.aggregate(
        F.transform(zipped, lambda x: F.struct(x["piece"].alias("0"), x["match"].alias("1"))),
        F.struct(F.lit(0).alias("at"), empty.alias("rows")), step, lambda acc: acc["rows"]))
    return F.coalesce(placed, empty)


def _split_runs(places: str) -> str:
    """``places`` with each run of more than MOST_DIGITS digits replaced by its pieces and adjoining pieces of up to so many, off the base spans.

    Base spans are masked first, so that a group of digits need not look for them; a masked one counts as too many digits.
    """
    spans = ("array_sort(transform(filter(base, b -> b.start < x.stop AND x.start < b.stop), "
             "b -> named_struct('a', greatest(b.start, x.start) - x.start, 'z', least(b.stop, x.stop) - x.start)))")
    masked = (f"aggregate({spans}, named_struct('at', 0, 'out', ''), (acc, b) -> CASE WHEN b.z <= acc.at THEN acc ELSE named_struct('at', b.z, 'out', "
              "concat(acc.out, substr(x.match, acc.at + 1, greatest(b.a - acc.at, 0)), repeat('@', b.z - greatest(acc.at, b.a)))) END, "
              "acc -> concat(acc.out, substr(x.match, acc.at + 1)))")
    groups = f"regexp_extract_all({masked}, '[0-9]+[^0-9@]*|[^0-9]+', 0)"
    sums = "aggregate({0}, array(0), (sums, g) -> concat(sums, array(element_at(sums, -1) + {1})))"
    digits = f"CASE WHEN g rlike '^[0-9]' THEN length(regexp_replace(g, '[^0-9]', '')) ELSE {MOST_DIGITS + 1} END"
    ends = f"filter(sequence(i + 1, least(i + {MOST_DIGITS}, size(at) - 1)), j -> sums[j] - sums[i] BETWEEN 7 AND {MOST_DIGITS})"
    left = f"right(concat(CASE WHEN at[i] < {LEFT} THEN x.left ELSE '' END, substr(x.match, greatest(1, at[i] - {LEFT - 1}), least(at[i], {LEFT}))), {LEFT})"
    match = "regexp_replace(array_join(slice(groups, i + 1, j - i), ''), '[^0-9]+$', '')"
    piece = (f"transform(array({match}), m -> named_struct('kind', x.kind, 'start', x.start + at[i], 'stop', x.start + at[i] + length(m), "
             "'match', m, 'digits', sums[j] - sums[i], 'left', l))[0]")
    pieces = f"flatten(transform(sequence(0, size(at) - 2), i -> flatten(transform(array({left}), l -> transform({ends}, j -> {piece})))))"
    run = (f"flatten(transform(array({groups}), groups -> flatten(transform(array({sums.format('groups', 'length(g)')}), at -> "
           f"flatten(transform(array({sums.format('groups', digits)}), sums -> {pieces}))))))")
    return f"flatten(transform({places}, x -> CASE WHEN x.digits <= {MOST_DIGITS} THEN array(x) ELSE {run} END))"


def _chosen(places: str, condition: str) -> str:
    luhn = _luhn("regexp_replace(x.match, '[^0-9]', '')")
    return f"filter({places}, x -> {condition.replace('{luhn}', luhn)})"


def with_base(docs: DataFrame, text: str, column: str = "base") -> DataFrame:
    """``docs`` with the base spans (kind, start, stop, match, digits, left), by kind, then start."""
    out = docs.withColumn("body", F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind, (pattern, gate, _) in BASE.items():
        out = out.withColumn(f"__{kind}", _places(kind, pattern, gate))
    every = ", ".join(_chosen(f"__{kind}", condition) for kind, (_, _, condition) in BASE.items())
    return out.withColumn(column, F.expr(f"concat({every})")).drop(*(f"__{kind}" for kind in BASE))


def with_candidates(docs: DataFrame, split: bool = True) -> DataFrame:
    """Adds ``candidates`` that touch no base span, with their votes and features as bit sets; ``split``: also the parts of long runs."""
    out = docs
    for kind, (pattern, gate, _) in CANDIDATES.items():
        out = out.withColumn(f"__{kind}", _places(kind, pattern, gate))
    if split:
        out = out.withColumn("__number", F.expr(_split_runs("__number")))
    parts = []
    for kind, (_, _, condition) in CANDIDATES.items():
        free = _chosen(f"__{kind}", f"{condition} AND NOT exists(base, b -> b.start < x.stop AND x.start < b.stop)")
        cue = f"lower(x.left) rlike '(?:^|[^\\\\p{{L}}])(?:{CUES[kind].replace(' ', '|')})[^\\\\p{{L}}]*$'"
        votes = " + ".join(f"CASE WHEN {e.replace('x.kind_cue', cue)} THEN {1 << k} ELSE 0 END" for k, e in enumerate(LABELERS.values()))
        shape = " + ".join(f"CASE WHEN {e.replace('x.kind_cue', cue)} THEN {1 << k} ELSE 0 END" for k, e in enumerate(FEATURES.values()))
        if kind == "number":
            luhn = _luhn("regexp_replace(x.match, '[^0-9]', '')")
            shape += f" + CASE WHEN x.digits >= 13 AND x.match rlike '{CARD}' AND {luhn} THEN {SURE} ELSE 0 END"
        parts.append(f"transform({free}, x -> named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop, 'votes', {votes}, 'features', {shape}))")
    every = F.expr(f"CAST(concat({', '.join(parts)}) AS array<{_CANDIDATE}>)")
    return out.withColumn("candidates", every).drop(*(f"__{kind}" for kind in CANDIDATES))


@dataclass(frozen=True)
class Model:
    """What the labelers are worth, and the classifier over features."""

    prior: float
    fires: tuple[tuple[float, float], ...]  # of each labeler: P(vote | other), P(vote | personal)
    weights: tuple[float, ...]
    bias: float

    def keeps(self) -> str:
        """The condition on a candidate x that it is personal data."""
        bits = " + ".join(f"{w!r} * ((x.features >> {k}) & 1)" for k, w in enumerate(self.weights))
        return f"(x.features & {SURE}) <> 0 OR {self.bias!r} + {bits} > 0"


#: Before any data: labelers are silent on most other strings, and fire on some personal ones; in pseudo counts.
_OTHER, _PERSONAL, _STRENGTH = 0.05, 0.5, 4.0


def estimate(patterns: list[tuple[int, float]], rounds: int = 100) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """Expectation-maximisation over (votes, count): the prior, the labelers' rates, P(personal | votes)."""
    n, prior = len(LABELERS), 0.3
    fires = [(_OTHER, _PERSONAL)] * n
    belief: dict[int, float] = {}
    for _ in range(rounds):
        for votes, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for k, (other, personal) in enumerate(fires):
                odds += math.log(personal / other) if votes >> k & 1 else math.log((1 - personal) / (1 - other))
            belief[votes] = 1 / (1 + math.exp(-odds))
        total = sum(c for _, c in patterns)
        mass = sum(c * belief[v] for v, c in patterns)
        prior = min(max((mass + 0.3 * _STRENGTH) / (total + _STRENGTH), 1e-4), 0.95)
        fires = []
        for k in range(n):
            yes = sum(c * belief[v] for v, c in patterns if v >> k & 1)
            no = sum(c * (1 - belief[v]) for v, c in patterns if v >> k & 1)
            # a labeler's vote never speaks against personal data
            personal = min((yes + _PERSONAL * _STRENGTH) / (mass + _STRENGTH), 0.99)
            other = min((no + _OTHER * _STRENGTH) / (total - mass + _STRENGTH), personal)
            fires.append((max(other, 1e-4), max(personal, 1e-4)))
    return prior, fires, belief


def fit(docs: DataFrame, text: str = "text") -> Model:
    """A model from the candidates of all texts; only counts of patterns are collected. The parts of long runs overlap and are left out."""
    rows = with_candidates(with_base(docs.select(F.col(text).cast("string").alias("text")), "text"), split=False).select(F.explode("candidates").alias("c"))
    counted = [(r["votes"], r["features"], r["n"]) for r in rows.groupBy("c.votes", "c.features").agg(F.count("*").alias("n")).orderBy("votes", "features").collect()]
    by_votes: dict[int, float] = {}
    for votes, _, n in counted:
        by_votes[votes] = by_votes.get(votes, 0) + n
    prior, fires, belief = estimate(sorted(by_votes.items()))
    if not counted:
        return Model(prior, tuple(fires), (0.0,) * len(FEATURES), -1.0)
    x = np.array([[f >> k & 1 for k in range(len(FEATURES))] for _, f, _ in counted], dtype=float)
    w = regression(x, np.array([belief[v] for v, _, _ in counted]), np.array([float(n) for _, _, n in counted]))
    return Model(prior, tuple(fires), tuple(float(v) for v in w[:-1]), float(w[-1]))


def with_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: (kind, start, stop) of all personal data, base kinds first, then by start.

    Offsets count code points, ends are exclusive. Null and empty texts have no spans.
    """
    both = with_candidates(with_base(docs, text))
    kept = f"filter(candidates, x -> {model.keeps()})"
    plain = "named_struct('kind', x.kind, 'start', x.start, 'stop', x.stop)"
    return both.withColumn("spans", F.expr(f"concat(transform(base, x -> {plain}), transform({kept}, x -> {plain}))")).drop(
        "body", "base", "candidates")


def redacted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, like [EMAIL]; overlapping spans by the first one's."""
    spans = with_spans(docs.withColumn("__row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))).select("__row", F.col(f"`{text}`").alias("__text")), model, "__text")
    ordered = F.expr("array_sort(spans, (a, b) -> CASE WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 "
                     "WHEN a.stop > b.stop THEN -1 WHEN a.stop < b.stop THEN 1 ELSE 0 END)")

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        before = F.substring(F.col("__text"), acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(
            fresh, F.concat(acc["out"], before, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                      lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, F.lit(2**31 - 1))))
    new = F.when(F.size("spans") > 0, cut).otherwise(F.col("__text"))
    return spans.withColumn("__new", new).select(*(
        F.col("__new").alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns))


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.stop)), ',')")


def personal_data(docs: DataFrame, model: Model | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, spans), one row per input row, also for null texts, null and repeated ids; other columns are ignored."""
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return with_spans(chosen, model or fit(chosen)).select("doc_id", "spans")


@registered()
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the places of personal data."""
    out = personal_data(table(spark, folder, "documents"))
    base = F.expr("filter(spans, x -> x.kind IN ('email', 'ip', 'card', 'phone'))")
    counts = [F.expr(f"CAST(size(filter(spans, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in BASE]
    return out.withColumn("base", base).select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
