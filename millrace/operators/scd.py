"""Slowly changing dimensions of type 2.

The history table has the columns ``current``, ``effective_date`` and ``end_date``
next to the data columns, and is identified by key plus ``effective_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.changes import diff_changes, join_keys
from millrace.operators.latest import latest_per_key
from millrace.operators.merge import exploded_images, has_unique_key, paired

_OWN = ("current", "effective_date", "end_date")


def _spliced(history: DataFrame, changes: DataFrame, key: str, tracked: list[str], updated: str) -> DataFrame:
    """The histories of keys with ``changes`` put in their places.

    Stored versions and changes of a key are ordered by time, those that leave the tracked columns as they were
    are left out, and each version ends where the next begins: so a late change splits the interval it falls in.
    A change at the very time of a stored version replaces it; of several at one time the content decides.
    Two windows over one order, so one shuffle; rows of a key stream through them and spill.
    """
    types = {f.name: f.dataType for f in history.schema.fields}
    data = [c for c in history.columns if c not in _OWN]
    stored = history.select(*data, F.col("effective_date").alias("_at"), F.lit(0).alias("_change"))
    added = changes.select(*[F.col(c).cast(types[c]).alias(c) for c in data],
                           F.col(updated).cast(types["effective_date"]).alias("_at"), F.lit(1).alias("_change"))
    first = [F.col("_change").desc(), *[F.col(c).desc() for c in data if c != key]]
    points = latest_per_key(stored.unionByName(added), [key, "_at"], first, ties="one")
    along = Window.partitionBy(key).orderBy("_at")
    value = F.struct(*[F.col(c) for c in tracked])
    kept = points.withColumn("_before", F.lag(value).over(along)).where(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(value))
    ended = kept.withColumn("_next", F.lead(F.struct("_at")).over(along))
    own = {"current": F.col("_next").isNull(), "effective_date": F.col("_at"), "end_date": F.col("_next._at")}
    return ended.select(*[own.get(c, F.col(c)).cast(types[c]).alias(c) for c in history.columns])


def _touched(dimension: DataFrame, changes: DataFrame, key: str, how: str) -> DataFrame:
    return join_keys(dimension, changes.select(key).distinct(), [key], how).select(dimension.columns)


def scd2_splice(dimension: DataFrame, changes: DataFrame, key: str, tracked: list[str], updated: str) -> DataFrame:
    """The history table after any number of changes per key, in any order and also late ones.

    The result is that of sorting every key's versions and changes by time, whatever came in which call.
    NULL is a value like any other, in tracked columns, keys and times (NULL comes before all times).
    Keys without changes are left as they are.
    """
    rest = _touched(dimension, changes, key, "left_anti")
    return rest.unionByName(_spliced(_touched(dimension, changes, key, "left_semi"), changes, key, tracked, updated))


def scd2_splice_changes(dimension: DataFrame, changes: DataFrame, key: str, tracked: list[str], updated: str) -> DataFrame:
    """The row changes of ``scd2_splice``, for a change table; only the histories of changed keys are looked at."""
    before = _touched(dimension, changes, key, "left_semi")
    return diff_changes(before, _spliced(before, changes, key, tracked, updated), [key, "effective_date"])


def _not_null(updates: DataFrame, tracked: list[str], null_safe: bool) -> DataFrame:
    """Without updates that set a tracked column to NULL, which are ignored unless ``null_safe``."""
    return updates if null_safe else updates.dropna(subset=tracked)


def _versions(dimension, updates, key, tracked, updated, null_safe, how):
    """For updates with unique keys, one join with the history: its pairs, and as columns of these the old row, the
    closed one, the opened one, and whether the update changes the open row."""
    pairs = paired(dimension, updates, [key], how)
    different = "NOT (t.`{0}` <=> s.`{0}`)" if null_safe else "t.`{0}` <> s.`{0}`"
    changes = F.expr("s._s AND t.current AND (" + " OR ".join(f"({different.format(c)})" for c in tracked) + ")")
    types = {f.name: f.dataType for f in dimension.schema.fields}
    stamp = F.col(f"s.`{updated}`")

    def row(own: dict[str, Column], side: str) -> Column:
        return F.struct(*[own.get(c, F.col(f"{side}.`{c}`")).cast(types[c]).alias(c) for c in dimension.columns])

    old = row({}, "t")
    closed = row({"current": F.lit(False), "end_date": stamp}, "t")
    opened = row({"current": F.lit(True), "effective_date": stamp, "end_date": F.lit(None)}, "s")
    return pairs, old, closed, opened, changes


def scd2_apply(
    dimension: DataFrame, updates: DataFrame, key: str, tracked: list[str], updated: str,
    null_safe: bool = False,
) -> DataFrame:
    """The history table after ``updates``: changed rows closed, new current rows added.

    Only a change in a ``tracked`` column counts, compared with ``<>`` (a change to or
    from NULL is ignored unless ``null_safe``). Updates come after the open rows; those that may
    be late go to ``scd2_splice``. Several updates for one key are chained by it.
    """
    if not has_unique_key(updates, [key]):
        return scd2_splice(dimension, _not_null(updates, tracked, null_safe), key, tracked, updated)
    pairs, old, closed, opened, changes = _versions(dimension, updates, key, tracked, updated, null_safe, "full_outer")
    rows = F.when(F.expr("t._t IS NULL"), F.array(opened)).when(changes, F.array(closed, opened)).otherwise(F.array(old))
    return pairs.select(F.explode(rows).alias("_row")).select("_row.*")


def scd2_changes(
    dimension: DataFrame, updates: DataFrame, key: str, tracked: list[str], updated: str,
    null_safe: bool = False,
) -> DataFrame:
    """The row changes of ``scd2_apply``, for a change table."""
    if not has_unique_key(updates, [key]):
        return scd2_splice_changes(dimension, _not_null(updates, tracked, null_safe), key, tracked, updated)
    pairs, old, closed, opened, changes = _versions(dimension, updates, key, tracked, updated, null_safe, "right")

    def image(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    images = F.when(F.expr("t._t IS NULL"), F.array(image("insert", opened))).when(changes, F.array(
        image("update_preimage", old), image("update_postimage", closed), image("insert", opened)))
    return exploded_images(pairs.select(images.alias("_images")), dimension.columns)


def current_rows(dimension: DataFrame) -> DataFrame:
    """The open row of every key, without the history columns."""
    return dimension.where("current").drop("current", "effective_date", "end_date")
