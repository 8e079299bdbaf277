import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import ChangeTable, Insert, Update, diff_changes, lost_rows, sync_copy

SCHEMA = "id INT, v STRING"


def frame(spark, data):
    return spark.createDataFrame([(k, v) for k, v in data.items()], SCHEMA)


def content(df):
    return {r.id: r.v for r in df.collect()}


def test_every_version_stays_readable(spark, folder):
    rng = random.Random(7)
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"], fold_every=3)
    states, state = [{}], {}
    for n in range(7):
        state = dict(state)
        for _ in range(4):
            key = rng.randrange(8)
            if rng.random() < 0.3:
                state.pop(key, None)
            else:
                state[key] = f"{n}-{rng.randrange(3)}"
        table.replace_with(frame(spark, state))
        states.append(state)
    assert table.version() == 7
    assert table.commits().where("is_base").count() == 2
    for version, want in enumerate(states):
        assert content(table.as_of(version)) == want
    assert content(table.current()) == states[-1]
    with pytest.raises(ValueError, match="does not exist"):
        table.as_of(8)


def test_feed_has_two_images_per_update(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "a", 2: "b", 3: "c"}))
    source = frame(spark, {2: "B", 3: "c", 4: "d"})
    table.merge(source, ["id"], [Update(when="t.v <> s.v")], [Insert()])
    table.delete(table.current().where("id = 1"))
    got = rows(table.feed(2).select("id", "v", "_change_type", "_commit_version"))
    assert got == [
        (1, "a", "delete", 3), (2, "B", "update_postimage", 2), (2, "b", "update_preimage", 2),
        (4, "d", "insert", 2),
    ]
    assert table.feed(2, 2).count() == 3
    assert rows(table.history().select("version", "operation", "rows_inserted", "rows_updated", "rows_deleted")) == [
        (1, "WRITE", 3, 0, 0), (2, "MERGE", 1, 1, 0), (3, "DELETE", 0, 0, 1),
    ]


def test_reads_by_time(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    hours = [start + dt.timedelta(hours=n) for n in range(3)]
    for n, at in enumerate(hours):
        table.insert(frame(spark, {n: str(n)}), at=at)
    assert table.as_of(timestamp=hours[1] + dt.timedelta(minutes=1)).count() == 2
    assert table.as_of(timestamp=start - dt.timedelta(minutes=1)).count() == 0
    assert table.feed(hours[1], hours[1]).count() == 1
    assert table.feed(hours[1]).count() == 2


def test_a_replayed_batch_is_skipped(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    assert table.insert(frame(spark, {1: "a"}), writer="w", batch=0) == 1
    assert table.insert(frame(spark, {1: "a"}), writer="w", batch=0) == 1
    assert table.insert(frame(spark, {2: "b"}), writer="other", batch=0) == 2
    assert content(table.current()) == {1: "a", 2: "b"}


def test_an_unfinished_version_is_invisible_and_written_over(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "a"}))
    lost = frame(spark, {9: "lost"}).withColumn("_change_type", F.lit("insert"))
    lost.withColumn("_commit_timestamp", F.current_timestamp()).write.parquet(f"{folder}/t/changes/_commit_version=2")
    assert content(table.current()) == {1: "a"}
    table.insert(frame(spark, {2: "b"}))
    assert content(table.current()) == {1: "a", 2: "b"}


def test_restore_is_a_new_version(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "a", 2: "b"}))
    before = table.current()
    table.delete(before)
    assert table.current().count() == 0
    assert rows(lost_rows(table.as_of(1), table.current())) == [(1, "a"), (2, "b")]
    assert table.restore(1) == 3
    assert content(table.current()) == {1: "a", 2: "b"}
    assert table.as_of(2).count() == 0


def test_expiry(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "secret"}))
    table.replace_with(frame(spark, {1: "b", 2: "c"}))
    table.delete(table.current().where("id = 2"))
    with pytest.raises(ValueError, match="force"):
        table.expire(older_than_hours=0)
    assert table.expire() == 1 and table.as_of(1).count() == 1
    assert table.expire(older_than_hours=0, force=True) == 3
    assert content(table.current()) == {1: "b"}
    for read in (lambda: table.as_of(1), lambda: table.feed(1)):
        with pytest.raises(ValueError, match="expired"):
            read()
    stored = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/t/changes")
    assert stored.where("v = 'secret'").count() == 0
    table.insert(frame(spark, {3: "d"}))
    assert content(table.current()) == {1: "b", 3: "d"} and table.feed(4).count() == 1
    assert table.expire(older_than_hours=0, force=True) == 4
    assert content(table.current()) == {1: "b", 3: "d"}


def test_copies_can_be_brought_up_to_date(spark, folder):
    source = ChangeTable(spark, f"{folder}/s", SCHEMA, ["id"])
    copy = ChangeTable(spark, f"{folder}/c", SCHEMA, ["id"])
    source.insert(frame(spark, {1: "a", 2: "b", 3: "c"}))
    assert sync_copy(source, copy) == 1
    source.replace_with(frame(spark, {1: "a", 2: "B", 4: "d"}))
    source.delete(source.current().where("id = 4"))
    assert sync_copy(source, copy) == 2
    assert content(copy.current()) == content(source.current()) == {1: "a", 2: "B"}
    assert copy.feed(2).count() == 3
    assert sync_copy(source, copy) == 2
    sync_copy(frame(spark, {7: "x"}), copy)
    assert content(copy.current()) == {7: "x"}


def test_diff_then_apply(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], SCHEMA)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "C"), (5, "e")], SCHEMA)
    assert rows(diff_changes(old, new, ["id"])) == [
        (3, "C", "update_postimage"), (3, "c", "update_preimage"), (4, "d", "delete"), (5, "e", "insert"),
    ]


def test_feed_stream_resumes(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "a"}))

    def run():
        seen = []
        query = (
            table.feed_stream(start=1, types=["insert", "update_postimage"]).writeStream
            .foreachBatch(lambda b, _: seen.extend((r.id, r.v, r._commit_version) for r in b.collect()))
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(seen)

    assert run() == [(1, "a", 1)]
    assert run() == []
    table.replace_with(frame(spark, {1: "b"}))
    assert run() == [(1, "b", 2)]


def test_feed_stream_never_sees_refused_or_unfinished_versions(spark, folder, monkeypatch):
    table = ChangeTable(spark, f"{folder}/t", "id INT, v INT, tags ARRAY<STRUCT<a: STRING, at: TIMESTAMP>>", ["id"])
    one = "SELECT {0} AS id, {1} AS v, array(struct('x' AS a, TIMESTAMP '2024-01-02 03:04:05.678901' AS at)) AS tags"

    def run(name):
        seen = []
        (table.feed_stream(most_versions=1).writeStream
         .foreachBatch(lambda b, _: seen.extend(b.collect()))
         .option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start().awaitTermination())
        return seen

    table.add_constraint("positive", "v > 0")
    assert run("early") == []
    table.insert(spark.sql(one.format(1, 1)))
    with pytest.raises(ValueError, match="positive"):
        table.insert(spark.sql(one.format(99, -5)))
    first = run("early")
    assert [(r.id, r.v, r._commit_version, r._change_type) for r in first] == [(1, 1, 1, "insert")]
    assert first[0].tags[0].at == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert first == table.feed().collect()
    monkeypatch.setattr(table, "_record", lambda *a, **k: None)  # dies before its commit row
    table.insert(spark.sql(one.format(77, 7)))
    monkeypatch.undo()
    assert run("early") == [] and [r.id for r in run("late")] == [1]
    table.insert(spark.sql(one.format(2, 2)))
    assert [(r.id, r._commit_version) for r in run("early")] == [(2, 2)]
    assert sorted(r.id for r in run("whole")) in ([1], [1, 2])  # one version a micro-batch
    table.delete(table.current().where("id = 1"))
    assert [(r.id, r._change_type) for r in run("early")] == [(1, "delete")]


def test_a_null_key_is_a_key(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {None: "a", 1: "b"}))
    table.replace_with(frame(spark, {None: "c", 1: "b"}))
    assert content(table.current()) == {None: "c", 1: "b"} and table.feed(2).count() == 2
    table.delete(table.current().where("id IS NULL"))
    assert content(table.current()) == {1: "b"}
    table.restore(2)
    assert content(table.current()) == {None: "c", 1: "b"}


def test_expired_changes_are_refused_and_copies_catch_up(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    copy = ChangeTable(spark, f"{folder}/copy", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "x", 2: "y"}))
    sync_copy(table, copy)
    table.replace_with(frame(spark, {1: "new", 2: "y"}))
    table.replace_with(frame(spark, {1: "new", 2: "y", 3: "z"}))
    table.expire(older_than_hours=0, force=True)
    for read in (lambda: table.touched(1, 3), lambda: table.feed_stream(1)):
        with pytest.raises(ValueError, match="expired"):
            read()
    sync_copy(table, copy)
    assert content(copy.current()) == {1: "new", 2: "y", 3: "z"}
    assert rows(table.history().select("version", "rows_inserted", "rows_updated", "rows_deleted")) == [
        (1, 2, 0, 0), (2, 0, 1, 0), (3, 1, 0, 0),
    ]


def test_two_rows_for_a_key_are_refused_and_block_nothing(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    tied = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    with pytest.raises(ValueError, match="several source rows"):
        table.merge(tied, ["id"], [Update(when="t.v <> s.v")], [Insert()])
    assert table.version() == 0
    table.merge(tied.limit(1), ["id"], [Update(when="t.v <> s.v")], [Insert()])
    with pytest.raises(ValueError, match="exists already"):
        table.insert(frame(spark, {1: "again"}))
    table.merge(frame(spark, {1: "c", 2: "d"}), ["id"], [Update(when="t.v <> s.v")], [Insert()])
    assert content(table.current()) == {1: "c", 2: "d"}


def test_constraints_stay_with_the_table(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    table.insert(frame(spark, {1: "a"}))
    with pytest.raises(ValueError, match="present"):
        table.add_constraint("late", "id > 5")
    table.add_constraint("positive", "id > 0")
    again = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    assert again.constraints() == {"positive": "id > 0"}
    with pytest.raises(ValueError, match="positive"):
        again.insert(frame(spark, {2: "b", -1: "c"}))
    assert content(again.current()) == {1: "a"} and again.version() == 1
    again.insert(frame(spark, {None: "unknown passes"}))
    again.drop_constraint("positive")
    again.insert(frame(spark, {-1: "c"}))
    assert again.constraints() == {} and again.current().count() == 3
