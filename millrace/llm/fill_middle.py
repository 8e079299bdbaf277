"""Fill-in-middle documents: cut at two code points, found by rank and select over UTF-8 words.

The bytes of a whole batch of texts are read as 64-bit words. A byte ends a unit (a code point)
if the byte after it is no continuation byte, which bit arithmetic marks for eight bytes at once;
``bitwise_count`` and a running sum give the number of units that end before each word. The byte
where the k-th unit ends is then found by searching the sums for its word and dropping the
word's lowest marks. Texts lie end to end and each begins with a unit of its own, so one
structure serves all texts of a batch and nothing is decoded.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import registered, table
from millrace.llm.words import column_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts, how many are rearranged, and how many of these begin with the suffix.
REARRANGED, SUFFIX_FIRST = 90, 20

_ONES = np.uint64(0x0101010101010101)
_ONE = np.uint64(1)


class Units:
    """Rank and select over the units of some bytes; the bytes are those of whole texts, end to end."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        padded = np.zeros(-(-(self.size + 1) // 8) * 8, dtype=np.uint8)  # at least one byte that is no continuation
        padded[:self.size] = data
        words = padded.view("<u8")
        follows = (words >> np.uint64(7)) & ~(words >> np.uint64(6)) & _ONES  # 1 in each continuation byte
        leads = follows ^ _ONES
        self.ends = leads >> np.uint64(8)  # a byte ends a unit if the next one leads
        self.ends[:-1] |= leads[1:] << np.uint64(56)
        self.ends[-1] &= self._below(self.size % 8)
        self.until = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends).astype(np.int64))])

    @staticmethod
    def _below(n) -> np.ndarray:
        """The bits of the first ``n`` bytes of a word; ``n`` is below 8."""
        return (_ONE << (np.asarray(n, dtype=np.uint64) * np.uint64(8))) - _ONE

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many units end before byte ``at``."""
        at = np.asarray(at, dtype=np.int64)
        return self.until[at >> 3] + np.bitwise_count(self.ends[at >> 3] & self._below(at & 7)).astype(np.int64)

    def select(self, units: np.ndarray) -> np.ndarray:
        """Where the first ``units`` units end."""
        units = np.asarray(units, dtype=np.int64)
        at = np.maximum(np.searchsorted(self.until, units) - 1, 0)
        marks, left = self.ends[at], units - self.until[at]
        for step in range(1, 8):  # drop the marks of the units before
            marks = np.where(left > step, marks & (marks - _ONE), marks)
        lowest = marks & (~marks + _ONE)
        byte = np.bitwise_count(lowest - _ONE).astype(np.int64) // 8
        return np.where(units > 0, at * 8 + byte + 1, 0)


def _draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on the id alone."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def restored(output: bytes, form: str) -> bytes:
    """The text an output was made of."""
    if form == "plain":
        return output
    if form == "psm":
        prefix, rest = output[len(PREFIX):].split(SUFFIX, 1)
        suffix, middle = rest.split(MIDDLE, 1)
    else:
        suffix, rest = output[len(SUFFIX):].split(PREFIX, 1)
        prefix, middle = rest.split(MIDDLE, 1)
    return prefix + middle + suffix


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("output", pa.string()), ("restored", pa.string())])


def _rearranged(batches):
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        units, first = Units(data), offsets[:-1]
        before = units.rank(offsets)
        n = np.diff(before)
        draws = np.array([_draws(i) for i in ids], dtype=np.int64).reshape(-1, 4)
        cuts = np.sort(draws[:, :2] % (n[:, None] + 1), axis=1)
        places = units.select(before[:-1, None] + cuts)
        places = np.where(cuts > 0, places, first[:, None])
        rows = []
        for i, name in enumerate(ids):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or draws[i, 2] % 100 >= REARRANGED:
                rows.append((name, int(n[i]), "plain", None, None, text, text))
                continue
            a, b = (int(p - first[i]) for p in places[i])
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            if draws[i, 3] % 100 < SUFFIX_FIRST:
                form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
            else:
                form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
            rows.append((name, int(n[i]), form, int(cuts[i, 0]), int(cuts[i, 1] - cuts[i, 0]), output, restored(output, form)))
        columns = list(zip(*rows)) if rows else [[]] * len(_SCHEMA)
        yield pa.RecordBatch.from_arrays([pa.array(
            [v.decode() for v in c] if f.name in ("output", "restored") else c, type=f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rearrange each text around a middle part that is to be filled in.

    Returns (doc_id, n, form, prefix_chars, middle_chars, output, restored), one row per input
    row; ``restored`` is rebuilt from ``output`` and ``form`` alone. The cuts and the form depend
    on the id and the text's length only: a repeated row gives the same row again, and rows with
    a null id draw as if the id were empty. Null and empty texts, and texts that hold one of the
    marks, stay plain. A text of any length is cut by the same steps; a task holds 128 texts.
    Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_rearranged, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string")


_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), d AS (
  SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), p AS (
  SELECT *, substring(x, 1, a) AS prefix, substring(x, a + 1, b - a) AS middle, substring(x, b + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""


@registered(_SQL)
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents rearranged for filling in their middle."""
    out = fill_in_middle(table(spark, folder, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
