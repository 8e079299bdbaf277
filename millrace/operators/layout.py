"""File layout: statistics per file, partition reports, compaction, Z-ordering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: target file size, least partition size, columns with statistics
COMPACT_BYTES = 1 << 30
MIN_PARTITION_BYTES = 1 << 30
STATISTICS_COLUMNS = 32
# files a task of a partitioned write has open before it sorts its rows
OPEN_FILES = 8

_UNORDERED = (T.MapType, T.VariantType, T.BinaryType, T.ArrayType)


def _leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Leaf columns in schema order, nested ones as dotted names."""
    found: list[tuple[str, T.DataType]] = []
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, f"{name}.")
        else:
            found.append((name, field.dataType))
    return found


def file_stats(df: DataFrame, max_columns: int = STATISTICS_COLUMNS) -> DataFrame:
    """Rows, size and per-column minimum, maximum and null count of every data file.

    Covers the first ``max_columns`` leaf columns. Each task reduces its part of a
    file to one row before the shuffle.
    """
    leaves = _leaves(df.schema)[:max_columns]
    measures = [
        F.max("_metadata.file_size").alias("file_bytes"),
        F.count(F.lit(1)).alias("row_count"),
    ]
    for name, kind in leaves:
        flat = name.replace(".", "_")
        if not isinstance(kind, _UNORDERED):
            measures += [F.min(name).alias(f"{flat}_min"), F.max(name).alias(f"{flat}_max")]
        measures.append(F.count_if(F.col(name).isNull()).alias(f"{flat}_nulls"))
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*measures)


def files_of(df: DataFrame) -> DataFrame:
    """Path, size, modification time and row count of the files behind ``df``; reads no data column."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.max("_metadata.file_size").alias("file_bytes"),
        F.max("_metadata.file_modification_time").alias("modified_at"),
        F.count(F.lit(1)).alias("row_count"),
    )


def table_detail(df: DataFrame) -> DataFrame:
    """One row: files, bytes, rows, column count and last change of a file-backed table."""
    return files_of(df).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("size_in_bytes"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("num_rows"),
        F.lit(len(df.columns)).alias("num_columns"),
        F.max("modified_at").alias("last_modified"),
    )


def partition_report(df: DataFrame, columns: list[str], min_bytes: int = MIN_PARTITION_BYTES) -> DataFrame:
    """Rows, files and bytes per partition, and whether it is smaller than advised.

    For a table not partitioned yet the bytes are those of the files touched, so
    only the row counts are meaningful there.
    """
    per_file = df.groupBy(*columns, F.col("_metadata.file_path").alias("_file")).agg(
        F.max("_metadata.file_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    return per_file.groupBy(*columns).agg(
        F.sum("_rows").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("_bytes").alias("byte_count"),
        (F.sum("_bytes") < min_bytes).alias("undersized"),
    )


def _row_address() -> Column:
    """A hash of where a row is stored: stable over retries, different even for exact copies."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """A partitioned write whose tasks hold few partitions each: their files are open at once, and no rows are sorted in memory."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    conf = df.sparkSession.conf
    before = conf.get(setting)
    conf.set(setting, str(OPEN_FILES))
    try:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(setting, before)


def compact(spark: SparkSession, source: str, destination: str, target_bytes: int = COMPACT_BYTES,
            partition_by: list[str] | None = None) -> DataFrame:
    """Rewrite a parquet folder into files of about ``target_bytes``.

    Small files are packed together without a shuffle. A partitioned table is spread
    by its partition columns plus a file number taken from each row's storage place,
    so a large partition becomes several files and a small one only one. Every file has
    a task of its own, which writes rows as they come.
    """
    df = spark.read.parquet(source)
    if partition_by:
        sizes = partition_report(df, partition_by).select(
            *[F.col(c).alias(f"_part_{i}") for i, c in enumerate(partition_by)],
            F.ceil(F.col("byte_count") / target_bytes).cast("int").alias("_files"),
        )
        same = F.lit(True)
        for i, c in enumerate(partition_by):
            same = same & F.col(c).eqNullSafe(F.col(f"_part_{i}"))
        # one row per partition, so sizes are broadcast; the files are numbered through
        through = F.sum("_files").over(Window.orderBy(*[f"_part_{i}" for i in range(len(partition_by))]).rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.withColumn("_first", F.coalesce(through, F.lit(0)).cast("int"))
        total = sizes.agg(F.sum("_files")).first()[0] or 1
        spread = df.withColumn("_row", _row_address()).join(F.broadcast(sizes), same, "inner")
        spread = spread.withColumn("_file", (F.col("_first") + F.pmod("_row", "_files")).cast("int"))
        write_partitions(spread.repartitionById(int(total), F.col("_file")).select(df.columns), destination, partition_by)
    else:
        size = files_of(df).agg(F.sum("file_bytes")).first()[0] or 0
        out = df.coalesce(max(1, math.ceil(size / target_bytes)))
        out.write.mode("overwrite").parquet(destination)
    return spark.read.schema(df.schema).parquet(destination)


def _comparable(column: str, kind: T.DataType) -> Column:
    """A column's values as strings or as order-preserving numbers."""
    if isinstance(kind, T.StringType):
        return F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _string_limits(df: DataFrame, column: str, ranges: int) -> list[str]:
    """At most ``ranges - 1`` limits that part a column's distinct strings evenly, however long a prefix they share.

    Spark's range partitioning samples the limits; only the lowest string of each range comes here.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(ranges, column)
    lowest = values.groupBy(F.spark_partition_id()).agg(F.min(column).alias("low")).collect()
    return sorted(r["low"] for r in lowest)[1:]


def _search_order(bounds: list) -> list:
    """Sorted range limits as an implicit search tree: entry ``i`` has the children ``2i`` and ``2i + 1``."""
    tree = [None] * len(bounds)
    rest = iter(bounds)

    def fill(i: int) -> None:
        if i <= len(bounds):
            fill(2 * i)
            tree[i - 1] = next(rest)
            fill(2 * i + 1)

    fill(1)
    return tree


def with_z_value(df: DataFrame, columns: list[str], bits: int = 6, name: str = "_z") -> DataFrame:
    """``df`` plus the interleaved range numbers of ``columns``.

    Only the range limits, at most ``2**bits - 1`` per column, come to the driver: built-in
    approximate quantiles of numbers and times, sampled limits of strings. So neither
    skew and scale nor shared prefixes of the values matter.
    """
    if bits * len(columns) > 62:
        raise ValueError("too many columns for that many bits")
    kinds = [df.schema[c].dataType for c in columns]
    plain = [_comparable(c, kind) for c, kind in zip(columns, kinds)]
    text = [isinstance(kind, T.StringType) for kind in kinds]
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    quantiles = [F.percentile_approx(n, steps, 10_000).alias(f"q{i}") for i, n in enumerate(plain) if not text[i]]
    found = df.agg(*quantiles).first() if quantiles else {}
    marks = []
    for i, column in enumerate(columns):
        limits = _string_limits(df, column, 1 << bits) if text[i] else list(found[f"q{i}"] or [])
        marks.append(_search_order(limits + [None] * (len(steps) - len(limits))))
    # walk the search trees one level per step; a column of its own for every level
    # keeps the generated code small; a missing limit or value counts as below
    spots = [f"_spot_{i}" for i in range(len(columns))]
    values = {f"_value_{i}": n for i, n in enumerate(plain)}
    result = df.withColumns(values | {spot: F.lit(1) for spot in spots})
    trees = [F.array(*map(F.lit, m)).cast("array<string>" if t else "array<double>") for m, t in zip(marks, text)]
    for _ in range(bits):
        result = result.withColumns({
            spot: 2 * F.col(spot) + F.coalesce(F.col(value) >= F.get(tree, F.col(spot) - 1), F.lit(False)).cast("int")
            for spot, value, tree in zip(spots, values, trees)
        })
    z = F.lit(0).cast("long")
    for i, spot in enumerate(spots):
        for bit in range(bits):
            one = F.shiftright(F.col(spot).cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(one, bit * len(spots) + i))
    return result.withColumn(name, z).drop(*spots, *values)


def zorder_bits(columns: int, files: int) -> int:
    """Bits per column that give each file several cells of the curve."""
    return min(62 // columns, max(6, math.ceil(math.log2(max(files, 1)) / columns) + 2))


def zorder(df: DataFrame, columns: list[str], files: int, bits: int | None = None) -> DataFrame:
    """A parquet table arranged so that rows near in all of ``columns`` share a file.

    The range split also uses the storage place of each row, so that rows with one
    equal, very common value still spread over several files. The number of ranges follows the
    number of files unless ``bits`` is given. ``df`` must read files
    directly, as that place comes from the scan.
    """
    bits = bits or zorder_bits(len(columns), files)
    marked = with_z_value(df.withColumn("_spread", _row_address()), columns, bits)
    return (
        marked.repartitionByRange(files, "_z", "_spread")
        .sortWithinPartitions("_z")
        .select(df.columns)
    )


def archive_partitions(df: DataFrame, where: Column | str, path: str) -> DataFrame:
    """Copy the rows about to be deleted elsewhere; returns what remains."""
    condition = F.expr(where) if isinstance(where, str) else where
    df.where(condition).write.mode("overwrite").parquet(path)
    return df.where(~F.coalesce(condition, F.lit(False)))
