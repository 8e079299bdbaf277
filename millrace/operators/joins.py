"""Join helpers: checked broadcast, salting for hot keys, repair of missed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest measured size that is broadcast; a row also counts some bytes of its own.
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 16


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row takes: 8 for a plain value, the length of anything longer."""
    width = F.lit(_ROW_BYTES + 8 * len(schema))
    for field in schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
    return width.cast("long")


def small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` takes at most ``max_bytes``, by one sum over the lengths of its values."""
    return (df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has been measured to be small, else as it is."""
    return F.broadcast(df) if small(df, max_bytes) else df


def lookup_join(df: DataFrame, lookup: DataFrame, on: Column | list[str], how: str = "inner",
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a lookup table, broadcast only after its size has been checked.

    A larger lookup is joined without a hint; Spark then shuffles both sides and
    splits hot partitions at run time.
    """
    return df.join(checked_broadcast(lookup, max_bytes), on, how)


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], salt_from: list[str],
                salts: int = 16) -> DataFrame:
    """Inner equi join that spreads each key of ``many`` over ``salts`` partitions.

    For streams, where Spark cannot split a hot partition at run time. The ``few``
    side is repeated once per salt; the result is that of the plain join.
    """
    left = many.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(salts)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    right = few.withColumn("_salt", copies)
    return left.join(right, [*keys, "_salt"], "inner").drop("_salt")


def missed_rows(stream_table: DataFrame, result: DataFrame, static: DataFrame, row_key: list[str],
                on: Column | list[str]) -> DataFrame:
    """Rows a stream-static join lost because their partner arrived later.

    They are in the stream's table, not in the result, and have a partner now. The
    output has the columns of the join, ready to be appended to ``result``.
    """
    absent = stream_table.join(result.select(row_key), row_key, "left_anti")
    return absent.join(static, on, "inner")
