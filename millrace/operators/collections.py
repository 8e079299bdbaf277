"""Sets gathered per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_sets(df: DataFrame, keys: list[str], items: str, name: str) -> DataFrame:
    """Distinct elements of the array column ``items`` per group, as a sorted array.

    Equal to flattening and de-duplicating the set of arrays, but the arrays are taken
    apart first: each task then keeps one copy of an element per group before the
    shuffle, where a set of arrays would hold every different combination.
    """
    lines = df.select(*keys, F.explode(items).alias("_item"))
    return lines.groupBy(*keys).agg(F.array_sort(F.collect_set("_item")).alias(name))
