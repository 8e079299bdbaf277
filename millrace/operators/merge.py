"""MERGE as a DataFrame function.

``merge_changes`` gives only the changed rows (with before and after images);
``merge_rows`` gives the merged table. Conditions and values are SQL text in which
``t`` is the target row and ``s`` the source row.

Scale: the source is normally the small side, and the target is then only scanned.
A source whose keys are unique, which one count of it tells, takes one outer join. Otherwise
the firing (target row, source row) pairs are the output of one inner join, which
Spark may broadcast or split when a key is hot, and a count per content of a target row
with a partial step before its shuffle finds rows that more than one source row would
change. No group is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import small
from millrace.operators.latest import latest_per_key


@dataclass(frozen=True)
class Update:
    """``WHEN MATCHED AND when THEN UPDATE SET values``; no values means ``SET *``."""

    values: Mapping[str, str] | None = None
    when: str = "true"


@dataclass(frozen=True)
class Delete:
    """``WHEN MATCHED AND when THEN DELETE``."""

    when: str = "true"


@dataclass(frozen=True)
class Insert:
    """``WHEN NOT MATCHED AND when THEN INSERT values``; no values means ``INSERT *``."""

    values: Mapping[str, str] | None = None
    when: str = "true"


Keys = Sequence[str] | Mapping[str, str]


def _key_pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def _first_clause(clauses: Sequence[Update | Delete | Insert]) -> Column:
    """Number of the first clause whose condition holds, else NULL."""
    return F.coalesce(*[F.when(F.expr(c.when), F.lit(i)) for i, c in enumerate(clauses)])


def _any_clause(clauses: Sequence[Update | Delete | Insert]) -> Column:
    return reduce(lambda a, b: a | b, [F.expr(c.when) for c in clauses])


def _assigned(target: DataFrame, clauses: Sequence[Update | Delete | Insert], otherwise) -> list[Column]:
    """The target's columns as the clause numbered ``_which`` sets them."""
    out = []
    for field in target.schema.fields:
        value = otherwise(field)
        for i, clause in enumerate(clauses):
            if isinstance(clause, Delete):
                continue
            if clause.values is None:
                new = F.col(f"s.`{field.name}`")
            elif field.name in clause.values:
                new = F.expr(clause.values[field.name])
            else:
                continue
            value = F.when(F.col("_which") == i, new.cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return out


def has_unique_key(source: DataFrame, on: Keys) -> bool:
    """Whether no two source rows share a key, NULL keys aside: one count with a partial step."""
    keys = [b for _, b in _key_pairs(on)]
    return source.select(keys).dropna().groupBy(keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty()


def paired(target: DataFrame, source: DataFrame, on: Keys, how: str) -> DataFrame:
    """Target (``t``) and source (``s``) side by side; ``_t`` and ``_s`` tell which of them is there."""
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    return t.join(s, reduce(lambda a, b: a & b, [F.col(f"t.`{a}`") == F.col(f"s.`{b}`") for a, b in _key_pairs(on)]), how)


_BOTH, _ONLY_SOURCE = "t._t AND s._s", "t._t IS NULL"


def _outcome(target: DataFrame, source: DataFrame, on: Keys, matched, not_matched, how: str) -> DataFrame:
    """For a source with unique keys, every pair of one join: ``_before``, ``_after`` and what happens.

    ``_hit``: a matched clause fires; ``_gone``: it deletes; ``_new``: the row is inserted;
    ``_there``: there is a target row.
    """
    def number(clauses, where):
        return F.when(F.expr(where), _first_clause(clauses)) if clauses else F.lit(None).cast("int")

    deletes = [i for i, c in enumerate(matched) if isinstance(c, Delete)]
    pairs = paired(target, source, on, how).withColumns({
        "_hit_by": number(matched, _BOTH), "_new_by": number(not_matched, _ONLY_SOURCE)})
    before = F.struct(*[F.col(f"t.`{c}`") for c in target.columns])
    changed = pairs.withColumn("_which", F.col("_hit_by")).withColumn(
        "_changed", F.struct(*_assigned(target, matched, lambda f: F.col(f"t.`{f.name}`"))))
    added = changed.withColumn("_which", F.col("_new_by")).withColumn(
        "_added", F.struct(*_assigned(target, not_matched, lambda f: F.lit(None).cast(f.dataType))))
    new = F.col("_new_by").isNotNull()
    return added.select(
        before.alias("_before"), F.when(new, F.col("_added")).otherwise(F.col("_changed")).alias("_after"),
        (F.col("_hit_by").isin(deletes) if deletes else F.lit(False)).alias("_gone"),
        F.col("_hit_by").isNotNull().alias("_hit"), new.alias("_new"), F.col("t._t").isNotNull().alias("_there"))


def _image(kind: str, side: str) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))


def exploded_images(images: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the table and their ``_change_type`` from a column ``_images``."""
    return images.select(F.explode("_images").alias("_image")).select(
        *[F.col(f"_image.row.`{c}`").alias(c) for c in columns], F.col("_image.kind").alias("_change_type"))


def _effects(target: DataFrame, source: DataFrame, on: Keys, matched: Sequence[Update | Delete]) -> DataFrame:
    """One row per changed content of target rows: ``_before``, ``_after``, ``_gone`` and ``_copies``, the rows with that content.

    Target rows with the same values meet the same source rows, so they are counted first and then
    stand for one row: more than one firing source row for it is more than one for each of them.
    """
    pairs = _key_pairs(on)
    wanted = source.select(*[F.col(f"`{b}`").alias(a) for a, b in pairs])
    touched = target.join(wanted, [a for a, _ in pairs], "left_semi").select(*target.columns)
    t, s = touched.groupBy(*target.columns).agg(F.count(F.lit(1)).alias("_copies")).alias("t"), source.alias("s")
    same_key = reduce(lambda a, b: a & b, [F.col(f"t.`{a}`") == F.col(f"s.`{b}`") for a, b in pairs])
    after = _assigned(target, matched, lambda f: F.col(f"t.`{f.name}`"))
    deletes = [i for i, c in enumerate(matched) if isinstance(c, Delete)]
    fired = (
        t.join(s, same_key, "inner")
        .where(_any_clause(matched))
        .withColumn("_which", _first_clause(matched))
        .select(
            F.struct(*[F.col(f"t.`{c}`") for c in target.columns]).alias("_before"),
            F.struct(*after).alias("_after"),
            F.col("_which").isin(deletes).alias("_gone") if deletes else F.lit(False).alias("_gone"),
            "_copies",
        )
    )
    single = F.when(
        F.col("_firing") > 1, F.raise_error(F.lit("MERGE: several source rows would change one target row"))).otherwise(F.lit(True))
    return (
        fired.groupBy("_before")
        .agg(F.count(F.lit(1)).alias("_firing"), F.first("_after").alias("_after"), F.first("_gone").alias("_gone"),
             F.first("_copies").alias("_copies"))
        .where(single)
        .select("_before", "_after", "_gone", "_copies")
    )


def _inserts(target: DataFrame, source: DataFrame, on: Keys, not_matched: Sequence[Insert]) -> DataFrame:
    """Source rows without a partner in the target (NULL keys never have one)."""
    pairs = _key_pairs(on)
    wanted = source.select(*[F.col(b).alias(a) for a, b in pairs])
    names = [a for a, _ in pairs]
    present = target.select(*names).join(wanted, names, "left_semi").alias("t")
    s = source.alias("s")
    same_key = reduce(lambda a, b: a & b, [F.col(f"t.`{a}`") == F.col(f"s.`{b}`") for a, b in pairs])
    which = _first_clause(not_matched)
    columns = _assigned(target, not_matched, lambda f: F.lit(None).cast(f.dataType))
    fresh = s.join(present, same_key, "left_anti").where(_any_clause(not_matched))
    return fresh.withColumn("_which", which).select(*columns)


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
) -> DataFrame:
    """The row changes a MERGE makes: the target's columns plus ``_change_type``.

    ``on`` lists the key columns, or maps target key to source key; several target rows may share
    a key, and each of them may be changed by one source row.
    """
    if not matched and not not_matched:
        raise ValueError("a merge needs at least one clause")
    change = F.when(F.col("_gone"), F.array(_image("delete", "_before"))).otherwise(
        F.array(_image("update_preimage", "_before"), _image("update_postimage", "_after")))
    if has_unique_key(source, on):  # then one join says it all
        pairs = _outcome(target, source, on, matched, not_matched, "right" if not_matched else "inner").where("_hit OR _new")
        images = F.when(F.col("_new"), F.array(_image("insert", "_after"))).otherwise(change)
        return exploded_images(pairs.select(images.alias("_images")), target.columns)
    parts = []
    if matched:
        copies = F.flatten(F.array_repeat(change, F.col("_copies").cast("int")))
        parts.append(exploded_images(_effects(target, source, on, matched).select(copies.alias("_images")), target.columns))
    if not_matched:
        parts.append(
            _inserts(target, source, on, not_matched).withColumn("_change_type", F.lit("insert"))
        )
    return reduce(DataFrame.unionByName, parts)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    on: Keys,
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    check_source: bool = False,
) -> DataFrame:
    """The target's content after the MERGE; other arguments as in ``merge_changes``.

    ``check_source`` measures the source first. If it is small and its keys are unique, it is
    broadcast, which saves shuffling the target.
    """
    if has_unique_key(source, on):  # then one join says it all
        if check_source and not not_matched and small(source):
            source = F.broadcast(source)
        pairs = _outcome(target, source, on, matched, not_matched, "full_outer" if not_matched else "left")
        kept = pairs.where("(_there AND NOT coalesce(_gone, false)) OR _new")
        return kept.select(*[
            F.when(F.col("_hit") | F.col("_new"), F.col(f"_after.`{c}`")).otherwise(F.col(f"_before.`{c}`")).alias(c)
            for c in target.columns])
    result = target
    if matched:
        changed = _effects(target, source, on, matched)
        same_row = reduce(lambda a, b: a & b, [F.col(f"t.`{c}`").eqNullSafe(F.col(f"c._before.`{c}`")) for c in target.columns])
        hit = F.col("c._gone").isNotNull()
        result = (
            target.alias("t").join(changed.alias("c"), same_row, "left")
            .where(~F.coalesce(F.col("c._gone"), F.lit(False)))
            .select(*[F.when(hit, F.col(f"c._after.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c) for c in target.columns])
        )
    if not_matched:
        result = result.unionByName(_inserts(target, source, on, not_matched))
    return result


def newest_wins(sequence: str) -> dict:
    """Clauses of a type 1 upsert: newer rows replace, unknown keys are inserted."""
    return {
        "matched": [Update(when=f"t.`{sequence}` < s.`{sequence}`")],
        "not_matched": [Insert()],
    }


def cdc_clauses(sequence: str, operation: str, delete_value: str = "delete") -> dict:
    """Clauses that apply a change feed with deletes.

    The delete clause comes first, since a newer delete event also meets the update
    condition, and a delete event for an unknown key inserts nothing.
    """
    newer = f"t.`{sequence}` < s.`{sequence}`"
    is_delete = f"s.`{operation}` = '{delete_value}'"
    return {
        "matched": [Delete(when=f"{newer} AND {is_delete}"), Update(when=newer)],
        "not_matched": [Insert(when=f"NOT ({is_delete})")],
    }


def apply_cdc(
    target: DataFrame, feed: DataFrame, keys: list[str], sequence: str, operation: str
) -> DataFrame:
    """Apply the newest change of every key in ``feed`` to ``target``."""
    newest = latest_per_key(feed, keys, [F.col(sequence).desc()])
    return merge_rows(target, newest, keys, **cdc_clauses(sequence, operation))
