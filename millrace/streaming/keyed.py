"""A table of unique keys that a stream is appended to, with a sketch of the keys of every folder.

Below ``path``:

* ``rows/batch=n`` - the rows that batch n added;
* ``sketches/batch=n`` - the least and greatest value of each key column there, and a bitmap of key hashes
  (``CELLS`` bits as one or more binaries of 4 KB).

A micro-batch asks which folders may hold one of its keys: those whose ranges overlap in every key column and
whose bitmaps share a bit. Only these are read and joined. Keys that follow time or a sequence meet few
folders by their ranges, and few keys meet few folders by their bitmaps. Exact in any case: a sketch only
leaves out folders that can't hold a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dml import rows_not_in
from millrace.session import read_if_present
from millrace.streaming.sinks import each_batch

#: Bits of a folder's bitmap.
CELLS = 1 << 20


class KeyedTable:
    """See the module text. Keys must not be NULL in any column; rows with NULL keys are appended without a look."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = spark.createDataFrame([], schema).schema

    def rows(self) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/rows", self.schema).select(self.schema.fieldNames())

    def _sketch_schema(self) -> str:
        ranges = [f"low_{k} {self.schema[k].dataType.simpleString()}, high_{k} {self.schema[k].dataType.simpleString()}" for k in self.keys]
        return ", ".join([*ranges, "slot BIGINT, bits BINARY, batch BIGINT"])

    def _sketch(self, rows: DataFrame) -> DataFrame:
        """One row for each 32,768 cells: the ranges of the keys that fall there, and which cells have some."""
        cell = F.pmod(F.xxhash64(*self.keys), F.lit(CELLS)) + 1  # buckets of bitmaps start from 1
        keyed = rows.dropna(subset=self.keys).withColumn("_cell", cell)
        return keyed.groupBy(F.bitmap_bucket_number("_cell").alias("slot")).agg(
            *[f(k).alias(f"{name}_{k}") for k in self.keys for name, f in (("low", F.min), ("high", F.max))],
            F.bitmap_construct_agg(F.bitmap_bit_position("_cell")).alias("bits"))

    def folders_with(self, batch: DataFrame) -> list[int]:
        """Batches whose folders may hold a key of ``batch``; at most one number for each folder."""
        ours = self._sketch(batch)
        theirs = read_if_present(self.spark, f"{self.path}/sketches", self._sketch_schema())
        named = ours.select("slot", F.col("bits").alias("_bits"), *[F.col(f"{n}_{k}").alias(f"_{n}_{k}") for k in self.keys for n in ("low", "high")])
        pairs = theirs.join(named, "slot")
        for k in self.keys:
            pairs = pairs.where((F.col(f"low_{k}") <= F.col(f"_high_{k}")) & (F.col(f"_low_{k}") <= F.col(f"high_{k}")))
        both = pairs.select("batch", "slot", F.explode(F.array("bits", "_bits")).alias("bits")).groupBy("batch", "slot").agg(
            F.bitmap_and_agg("bits").alias("shared")).where(F.bitmap_count("shared") > 0)
        return sorted(r[0] for r in both.select("batch").distinct().collect())

    def _in(self, folders: list[int]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/rows/batch={n}" for n in folders]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def new_rows(self, batch: DataFrame, but: int | None = None) -> DataFrame:
        """One row for each key of ``batch`` that the table does not hold; folder ``but`` does not count."""
        candidates = self._in([n for n in self.folders_with(batch) if n != but])
        once = batch.dropDuplicates(self.keys)
        known = once.dropna(subset=self.keys)
        fresh = rows_not_in(known, candidates, self.keys).select(self.schema.fieldNames())
        return fresh.unionByName(batch.where(" OR ".join(f"`{k}` IS NULL" for k in self.keys)).select(self.schema.fieldNames()))

    def append(self, batch: DataFrame, number: int) -> None:
        """Add the new keys of ``batch`` as folder ``number``; a repeated call writes over the first one's folder."""
        self.new_rows(batch, but=number).write.mode("overwrite").parquet(f"{self.path}/rows/batch={number}")
        stored = self._in([number])
        self._sketch(stored).write.mode("overwrite").parquet(f"{self.path}/sketches/batch={number}")

    def load(self, stream: DataFrame, checkpoint: str, first: int = 0) -> DataFrame:
        """Append what is new in the stream, micro-batch n as folder ``first + n``; returns the table.

        A second stream into the same table takes a ``first`` beyond the folders there are.
        """
        each_batch(stream, lambda batch, batch_id: self.append(batch, first + batch_id), checkpoint)
        return self.rows()
