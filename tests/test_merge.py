import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import (
    Delete, Insert, Update, apply_cdc, delete_matching, delete_rows, insert_new, latest_per_key,
    merge_changes, merge_rows, newest_wins, update_rows,
)


def test_fill_missing_email_only(spark):
    target = spark.createDataFrame([(1, None), (2, "x")], "id INT, email STRING")
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id INT, email STRING")
    merged = merge_rows(
        target, source, ["id"],
        [Update({"email": "s.email"}, "t.email IS NULL AND s.email IS NOT NULL")], [Insert()],
    )
    assert rows(merged) == [(1, "a"), (2, "x"), (3, "c")]


def test_two_firing_rows_are_an_error(spark):
    target = spark.createDataFrame([(1, 0)], "id INT, v INT")
    source = spark.createDataFrame([(1, 1), (1, 2)], "id INT, v INT")
    with pytest.raises(Exception, match="several source rows"):
        merge_rows(target, source, ["id"], [Update()]).collect()
    quiet = merge_rows(target, source, ["id"], [Update(when="s.v > 1")])
    assert rows(quiet) == [(1, 2)]


def test_match_is_decided_by_the_key_alone(spark):
    """A matched row no clause fires for is neither changed nor inserted again."""
    target = spark.createDataFrame([(1, 5)], "id INT, v INT")
    source = spark.createDataFrame([(1, 3)], "id INT, v INT")
    merged = merge_rows(target, source, ["id"], [Update(when="t.v < s.v")], [Insert()])
    assert rows(merged) == [(1, 5)]


def test_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1), (1, 1)], "id INT, v INT")
    source = spark.createDataFrame([(None, 2)], "id INT, v INT")
    merged = merge_rows(target, source, ["id"], [Update()], [Insert()])
    assert rows(merged) == [(1, 1), (None, 1), (None, 2)]


def test_star_takes_target_columns_from_a_wider_source(spark):
    target = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    source = spark.createDataFrame([("x", 9, "b", 1), ("y", 8, "c", 2)], "extra STRING, more INT, name STRING, id INT")
    merged = merge_rows(target, source, ["id"], [Update()], [Insert()])
    assert merged.columns == ["id", "name"] and rows(merged) == [(1, "b"), (2, "c")]


def test_first_clause_that_holds_wins(spark):
    target = spark.createDataFrame([(1, 1)], "id INT, ts INT")
    newer_delete = spark.createDataFrame([(1, 2, "delete")], "id INT, ts INT, op STRING")
    newer, gone = "t.ts < s.ts", "s.op = 'delete'"
    update_first = merge_rows(target, newer_delete, ["id"], [Update(when=newer), Delete(when=gone)])
    delete_first = merge_rows(target, newer_delete, ["id"], [Delete(when=gone), Update(when=newer)])
    assert rows(update_first) == [(1, 2)] and rows(delete_first) == []


def test_cdc_ignores_deletes_of_unknown_keys_and_late_events(spark):
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "id INT, ts INT, v STRING")
    feed = spark.createDataFrame(
        [(1, 6, "x", "update"), (1, 7, "y", "delete"), (2, 4, "late", "update"), (3, 1, "z", "delete"),
         (4, 1, "new", "insert")],
        "id INT, ts INT, v STRING, op STRING",
    )
    assert rows(apply_cdc(target, feed, ["id"], "ts", "op")) == [(2, 5, "b"), (4, 1, "new")]


def test_rank_keeps_ties_and_the_merge_then_refuses(spark):
    feed = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 0, "c")], "id INT, ts INT, v STRING")
    newest = latest_per_key(feed, ["id"], [F.col("ts").desc()])
    assert rows(newest) == [(1, 1, "a"), (1, 1, "b")]
    one = latest_per_key(feed, ["id"], [F.col("ts").desc(), F.col("v")], ties="one")
    assert rows(one) == [(1, 1, "a")]
    target = spark.createDataFrame([(1, 0, "old")], feed.schema)
    with pytest.raises(Exception, match="several source rows"):
        merge_rows(target, newest, ["id"], **newest_wins("ts")).collect()
    empty = target.where("false")
    assert merge_rows(empty, newest, ["id"], **newest_wins("ts")).count() == 2


def test_group_limit_runs_before_the_shuffle(spark):
    """The plan must drop all but the first rows of a key on the map side."""
    feed = spark.range(10).selectExpr("id % 3 AS k", "id AS ts")
    plan = latest_per_key(feed, ["k"], [F.col("ts").desc()])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("WindowGroupLimit") == 2


def test_insert_only_merge_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "b"), (2, "c")], "id INT, v STRING")
    once = insert_new(target, source, ["id"])
    assert rows(once) == rows(insert_new(once, source, ["id"])) == [(1, "a"), (2, "c")]


def test_update_and_delete_treat_null_as_no_match(spark):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id INT, v INT")
    assert rows(update_rows(df, {"v": "v + 1"}, "v > 5")) == [(1, 11), (2, None), (3, 31)]
    assert rows(delete_rows(df, "v > 5")) == [(2, None)]
    assert delete_rows(df, F.lit(True)).count() == 0
    doomed = spark.createDataFrame([(3,), (3,), (None,)], "id INT")
    assert rows(delete_matching(df, doomed, ["id"])) == [(1, 10), (2, None)]


def test_assignments_see_the_old_row(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert rows(update_rows(df, {"a": "b", "b": "a"}, "true")) == [(2, 1)]


def test_one_source_row_may_change_several_target_rows(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], "id INT, k STRING, v INT")
    source = spark.createDataFrame([("a",)], "key STRING")
    merged = merge_rows(target, source, {"k": "key"}, [Update({"v": "1"})])
    assert rows(merged) == [(1, "a", 1), (2, "a", 1), (3, "b", 0)]


@pytest.mark.parametrize("extra", [[], [(9, "y"), (9, "z")]])
def test_the_answer_does_not_depend_on_unrelated_source_rows(spark, extra):
    """Target rows that share a key, equal rows among them, with and without a repeated source key elsewhere."""
    target = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "n"), (None, "n")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "x"), (None, "m"), *extra], "id INT, v STRING")
    assert rows(merge_rows(target, source, ["id"], [Update()])) == sorted([
        (1, "x"), (1, "x"), (1, "x"), (2, "c"), (None, "n"), (None, "n")], key=repr)
    changes = merge_changes(target, source, ["id"], [Update()])
    assert rows(changes) == sorted([
        (1, "a", "update_preimage"), (1, "b", "update_preimage"), (1, "b", "update_preimage"),
        *[(1, "x", "update_postimage")] * 3], key=repr)
    assert rows(merge_rows(target, source, ["id"], [Delete()])) == sorted([(2, "c"), (None, "n"), (None, "n")], key=repr)


@pytest.mark.parametrize("merge", [merge_rows, merge_changes])
def test_two_firing_source_rows_are_an_error_for_equal_target_rows_too(spark, merge):
    target = spark.createDataFrame([(1, "b"), (1, "b")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id INT, v STRING")
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source, ["id"], [Update()]).collect()
    one_fires = merge(target, source, ["id"], [Update(when="s.v = 'y'")])
    assert one_fires.where("v = 'y'").count() == 2


def brute_merge(target, source):
    """Newest-wins upsert on dicts."""
    state = dict(target)
    for key, (ts, value) in source.items():
        if key not in state or state[key][0] < ts:
            state[key] = (ts, value)
    return state


states = st.dictionaries(st.integers(0, 8), st.tuples(st.integers(0, 5), st.integers(0, 99)), max_size=8)


@settings(max_examples=6, deadline=None)
@given(states, states)
def test_merge_equals_brute_force_and_its_changes(spark, target, source):
    schema = "id INT, ts INT, v INT"
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], schema)
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], schema)
    want = sorted((k, *v) for k, v in brute_merge(target, source).items())
    assert sorted(map(tuple, merge_rows(t, s, ["id"], **newest_wins("ts")).collect())) == want
    changes = [tuple(r) for r in merge_changes(t, s, ["id"], **newest_wins("ts")).collect()]
    state = {k: (k, *v) for k, v in target.items()}
    for *row, kind in sorted(changes, key=lambda r: r[-1] != "update_preimage"):
        if kind == "update_preimage":
            assert state[row[0]] == tuple(row)
        else:
            state[row[0]] = tuple(row)
    assert sorted(state.values()) == want


def test_unique_source_takes_one_scan_of_each_side(spark, folder):
    spark.range(50).selectExpr("CAST(id AS INT) AS id", "'a' AS v").write.parquet(f"{folder}/t")
    spark.range(25, 75).selectExpr("CAST(id AS INT) AS id", "'b' AS v").write.parquet(f"{folder}/s")
    target, source = spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/s")
    clauses = {"matched": [Update(when="t.v <> s.v")], "not_matched": [Insert()]}
    for merge in (merge_rows, merge_changes):
        plan = merge(target, source, ["id"], **clauses)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 2, plan
