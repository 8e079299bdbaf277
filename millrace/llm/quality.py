"""Quality rules: fixed base rules, then limits learned from quantile sketches per language and source.

The measures of a text are counted exactly. For texts that pass the base rules, mergeable quantile
sketches (``percentile_approx``, added up before the shuffle) give the median and the upper decile of each
measure for every (language, source), every language and everything. A limit lies ``SPREADS`` times the
distance from median to decile above the median: a group's junk, if it is less than a tenth, moves neither, and what is
usual in a group is within its limit, whatever it is elsewhere. Where a tenth doesn't stray from the median, a small
spread of the measure's own stands in. Groups of fewer than ``LEAST`` texts take the language's limits, or the general ones.
Repeated words are judged by the base rules, which leave no room for a limit above them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import kept, registered, table
from millrace.llm.words import ByteHash, Words, covered

REPEAT_WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Spreads above the median, the smallest group with limits of its own, the sketches' accuracy.
SPREADS, LEAST, ACCURACY = 6, 100, 10_000
#: Measures and their least spreads: shares of symbols a word, of repeated lines, word length.
SMALL = {"symbol_share": 0.02, "dup_line_share": 0.09, "word_length": 0.1}

_HASH = ByteHash(41)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(words: Words, i: int, values: np.ndarray) -> int:
    """Words of text i in windows that occur twice or more in it."""
    n = int(words.counts[i])
    if n <= REPEAT_WINDOW:
        return 0
    first = int(words.first[i])
    mine = values[first:first + n - REPEAT_WINDOW + 1]
    order = np.argsort(mine, kind="stable")
    equal = mine[order][1:] == mine[order][:-1]
    if not equal.any():
        return 0
    again = np.zeros(len(mine), dtype=bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    return int(covered(np.flatnonzero(again), REPEAT_WINDOW, n).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def _measured(batches):
    for batch in batches:
        column = batch.column("text")
        words = Words(column)
        visible = np.zeros(len(words.data) + 1, dtype=np.int64)
        change = np.zeros(len(words.data) + 1, dtype=np.int8)
        np.add.at(change, words.starts, 1)
        np.add.at(change, words.ends, -1)
        in_word = np.cumsum(change[:-1], dtype=np.int8) > 0
        np.cumsum(in_word & ((words.data & 0xC0) != 0x80), out=visible[1:])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
        values = _HASH.windows(words.hashes(_HASH), REPEAT_WINDOW)
        lines = [_lines(words.data[a:b].tobytes()) for a, b in zip(words.offsets[:-1], words.offsets[1:])]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), batch.column("lang"), batch.column("source"),
            pa.array(words.counts, type=pa.int64()),
            pa.array(visible[words.offsets[1:]] - visible[words.offsets[:-1]], type=pa.int64()),
            pa.array(symbols[words.offsets[1:]] - symbols[words.offsets[:-1]], type=pa.int64()),
            pa.array([x[0] for x in lines], type=pa.int64()), pa.array([x[1] for x in lines], type=pa.int64()),
            pa.array([_repeats(words, i, values) for i in range(len(words))], type=pa.int64()),
        ], names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"])


def measures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """The counts of each text and whether it fails the base rules."""
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    out = chosen.mapInArrow(_measured, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
                                       "n_lines long, n_dup_lines long, n_repeat_words long")
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                          | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _shares(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "symbol_share": F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    })


def limits(rows: DataFrame) -> DataFrame:
    """Limits by language and source; both null in the general row, the source null in a language's."""
    passed = _shares(rows).where("NOT base_failed")
    keyed = passed.select(*SMALL, F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    sketches = keyed.rollup("lang", "source").agg(F.count("*").alias("texts"), *(
        F.percentile_approx(m, [0.5, 0.9], ACCURACY).alias(m) for m in SMALL))
    return sketches.select("lang", "source", "texts", *(
        (F.col(m)[0] + SPREADS * F.greatest(F.lit(small), F.col(m)[1] - F.col(m)[0])).alias(f"most_{m}") for m, small in SMALL.items()))


def judged(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source",
           least: int = LEAST) -> DataFrame:
    """The measures of every text with ``base_failed`` and ``kept``, one row per input row.

    ``least`` is the number of texts from which a group has limits of its own; the general limits hold for any number.
    Null texts have no words and fail. Null languages and sources are groups of their own. An empty
    table gives no rows. Other columns are ignored.
    """
    rows = kept(measures(docs, text, doc_id, lang, source), "measures")
    found = kept(limits(rows), "limits")
    most = [f"most_{m}" for m in SMALL]

    def level(name: str, where: str) -> DataFrame:
        part = found.where(where).where(F.col("texts") >= least)
        return part.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.struct(*most).alias(name))

    keyed = _shares(rows).withColumns({"l": F.coalesce("lang", F.lit("")), "s": F.coalesce("source", F.lit(""))})
    keyed = keyed.join(level("own", "source IS NOT NULL"), ["l", "s"], "left")
    keyed = keyed.join(level("language", "lang IS NOT NULL AND source IS NULL").drop("s"), "l", "left")
    general = found.where("lang IS NULL").select(F.struct(*most).alias("general")).first()
    # without any text that passes the base rules, nothing is left to judge
    general = general["general"].asDict() if general else dict.fromkeys(most)
    limit = F.coalesce("own", "language", F.struct(*(F.lit(v).cast("double").alias(k) for k, v in general.items())))
    fits = F.lit(True)
    for m in SMALL:
        fits &= F.col(m) <= limit[f"most_{m}"]
    return keyed.withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(False))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_LIMITS_SQL = ", ".join(
    f"quantile_disc({m}, 0.5) + {SPREADS} * greatest({small}::DOUBLE, quantile_disc({m}, 0.9) - quantile_disc({m}, 0.5)) AS most_{m}"
    for m, small in SMALL.items())
_FITS_SQL = " AND ".join(f"{m} <= coalesce(own.most_{m}, language.most_{m}, general.most_{m})" for m in SMALL)
_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS l, coalesce(source, '') AS s, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {REPEAT_WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {REPEAT_WINDOW - 2})) AS i FROM texts WHERE len(ws) >= {REPEAT_WINDOW})
), again AS (
  SELECT doc_id, i FROM starts QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {REPEAT_WINDOW})) AS p FROM again) GROUP BY 1
), m AS (
  SELECT texts.doc_id, l, s, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN repeated ON texts.doc_id = repeated.doc_id
), shares AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         n_symbols / greatest(n_words, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
         word_chars / greatest(n_words, 1) AS word_length
  FROM m
), limits AS (
  SELECT l, s, grouping(l) AS no_l, grouping(s) AS no_s, count(*) AS texts, {_LIMITS_SQL}
  FROM shares WHERE NOT base_failed GROUP BY ROLLUP (l, s)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({_FITS_SQL}, FALSE) AS kept
FROM shares
LEFT JOIN (SELECT * FROM limits WHERE no_s = 0 AND texts >= {LEAST}) own ON own.l = shares.l AND own.s = shares.s
LEFT JOIN (SELECT * FROM limits WHERE no_s = 1 AND no_l = 0 AND texts >= {LEAST}) language ON language.l = shares.l
LEFT JOIN (SELECT * FROM limits WHERE no_l = 1) general ON true
"""


@registered(_SQL)
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their measures and verdict."""
    return judged(table(spark, folder, "documents"))
