"""Tables kept up to date from what is new: aggregates, repairs, keyed tables, watched streams, partitioned writes."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions.text import whole_schema
from millrace.operators import ChangeTable
from millrace.operators.aggregates import DeltaAggregate
from millrace.sources.files import file_stream
from millrace.streaming import append_to, dedup_within
from millrace.streaming.keyed import KeyedTable
from millrace.streaming.pending import PendingJoin
from millrace.streaming.quality import RateExceeded, WatchedStream

ORDERS = "id INT, country STRING, quantity INT"


def scanned(df):
    """Paths that the plan's scans name."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregate_follows_inserts_updates_and_deletes(spark, folder):
    orders = ChangeTable(spark, f"{folder}/orders", ORDERS, ["id"])
    gold = DeltaAggregate(orders, f"{folder}/gold", {"country": "country"}, {"n": "id", "with_quantity": "quantity"}, {"total": "quantity"})
    assert gold.refresh() == 0 and gold.current().isEmpty()
    rng, state = random.Random(1), {}
    for step in range(5):
        for _ in range(12):
            key = rng.randrange(15)
            if key in state and rng.random() < 0.4:
                del state[key]
            else:
                state[key] = (rng.choice(["A", "B", "C", None]), rng.choice([1, 2, 3, None]))
        orders.replace_with(spark.createDataFrame([(k, *v) for k, v in state.items()], ORDERS))
        if step in (0, 2, 4):  # several versions at a time as well
            assert gold.refresh() == orders.version()
            assert gold.refresh() == orders.version()
            want = orders.current().groupBy("country").agg(
                F.count("id").alias("n"), F.count("quantity").alias("with_quantity"), F.sum("quantity").alias("total"))
            assert rows(gold.current()) == rows(want)
    orders.delete(orders.current())
    gold.refresh()
    assert gold.current().isEmpty()


def test_aggregate_reads_new_versions_only(spark, folder):
    orders = ChangeTable(spark, f"{folder}/orders", ORDERS, ["id"])
    gold = DeltaAggregate(orders, f"{folder}/gold", {"country": "country"}, {"n": "id"})
    orders.insert(spark.createDataFrame([(i, "A", 1) for i in range(50)], ORDERS))
    gold.refresh()
    orders.insert(spark.createDataFrame([(100, "B", 1)], ORDERS))
    delta = gold._delta(orders.feed(gold.seen() + 1, orders.version()))
    files = delta.inputFiles()
    assert files and all("/orders/changes/_commit_version=2/" in f for f in files)


def test_refresh_after_a_lost_commit_counts_nothing_twice(spark, folder, monkeypatch):
    orders = ChangeTable(spark, f"{folder}/orders", ORDERS, ["id"])
    gold = DeltaAggregate(orders, f"{folder}/gold", {"country": "country"}, {"n": "id"})
    orders.insert(spark.createDataFrame([(1, "A", 1)], ORDERS))
    monkeypatch.setattr(gold.table, "_record", lambda *a, **k: None)
    gold.refresh()
    monkeypatch.undo()
    assert gold.seen() == 0
    gold.refresh()
    assert rows(gold.current()) == [("A", 1)]


LINES = "line INT, k STRING"


def test_waiting_rows_meet_late_partners(spark, folder):
    join = PendingJoin(spark, f"{folder}/join", LINES, "k STRING, v INT", ["k"], buckets=8)
    static = [("a", 1)]

    def table(pairs):
        return spark.createDataFrame(pairs, "k STRING, v INT")

    def land(*lines):
        spark.createDataFrame(lines, LINES).write.mode("append").parquet(f"{folder}/lines")
        return join.run(file_stream(spark, f"{folder}/lines", "parquet", LINES), lambda: table(static), f"{folder}/checkpoint")

    assert rows(land((1, "a"), (2, "b"), (3, "c"), (4, None), (2, "b")).select("line", "v")) == [(1, 1)]
    assert rows(join.pending().select("line")) == [(2,), (2,), (3,)]
    static.append(("b", 2))
    join.repair(table([("b", 2)]))
    assert rows(join.result().select("line", "v")) == [(1, 1), (2, 2), (2, 2)]
    land((5, "b"), (6, "c"), (7, "d"))
    static.append(("c", 3))
    join.repair(table([("c", 3), ("a", 1)]))
    join.repair(table([("c", 3), ("b", 2)]))  # nothing is added twice
    assert rows(join.result().select("line", "v")) == [(1, 1), (2, 2), (2, 2), (3, 3), (5, 2), (6, 3)]
    assert rows(join.pending().select("line")) == [(7,)]
    bucket = table([("d", 0)]).select(join._bucket()).first()[0]
    looked_at = join.pending([bucket]).inputFiles()
    assert not [f for f in looked_at if "/lines" in f or "/result/" in f]
    plan = scanned(join.pending([bucket]))
    assert any("PartitionFilters" in line and "bucket#" in line.split("PartitionFilters")[1] for line in plan.splitlines())


def test_unfinished_repair_is_done_again(spark, folder):
    join = PendingJoin(spark, f"{folder}/join", LINES, "k STRING, v INT", ["k"], buckets=2)
    none, one = spark.createDataFrame([], "k STRING, v INT"), spark.createDataFrame([("a", 1)], "k STRING, v INT")
    spark.createDataFrame([(1, "a")], LINES).write.parquet(f"{folder}/lines")
    join.run(file_stream(spark, f"{folder}/lines", "parquet", LINES), lambda: none, f"{folder}/checkpoint")
    join.repair(one)
    spark.createDataFrame([], "repair BIGINT, upto BIGINT").write.mode("overwrite").parquet(f"{folder}/join/repairs")
    assert join.result().isEmpty() and join.pending().count() == 1
    join.repair(one)
    assert join.result().count() == 1 and join.pending().isEmpty()


def test_keyed_table_reads_only_folders_that_may_hold_a_key(spark, folder):
    table = KeyedTable(spark, f"{folder}/t", "id BIGINT, day DATE, v STRING", ["id", "day"])

    def batch(*ids):
        return spark.createDataFrame([(i, "x") for i in ids], "id LONG, v STRING").selectExpr(
            "id", "date_add(DATE'2024-01-01', CAST(id div 100 AS INT)) AS day", "v")

    table.append(batch(1, 2, 3, 3), 0)
    table.append(batch(1001, 1002), 1)
    table.append(batch(2001, 2, 2), 2)
    assert sorted(r.id for r in table.rows().collect()) == [1, 2, 3, 1001, 1002, 2001]
    assert table.folders_with(batch(1001, 1003)) == [1]
    assert table.folders_with(batch(1500)) == []  # within a range of ids or not, no bit is shared
    assert table.folders_with(batch(5000, 5001)) == []
    fresh = table.new_rows(batch(1001, 1003))
    assert rows(fresh.select("id")) == [(1003,)]
    assert all("/rows/batch=1/" in f for f in fresh.inputFiles() if "/t/rows/" in f)
    table.append(batch(2001, 2, 2), 2)  # a replay writes over its own folder
    assert table.rows().count() == 6
    nulls = spark.createDataFrame([(None, "n")], "id LONG, v STRING").selectExpr("id", "CAST(NULL AS DATE) AS day", "v")
    table.append(nulls.unionByName(nulls), 3)
    assert table.rows().where("id IS NULL").count() == 2


def test_dedup_within_watermark_in_one_and_in_six_micro_batches(spark, folder):
    """Copies come with other times than their firsts, so the time can't be part of the key."""
    rng = random.Random(2)
    events = [(i, 1_700_000_000 + 10 * i) for i in range(120)]
    events += [(i, t + rng.randrange(1, 25)) for i, t in events if rng.random() < 0.5]
    events.sort(key=lambda e: e[1])
    results = []
    for parts in (1, 6):
        source = f"{folder}/events-{parts}"
        for k in range(parts):
            some = events[len(events) * k // parts:len(events) * (k + 1) // parts]
            spark.createDataFrame(some, "id INT, s LONG").selectExpr("id", "timestamp_seconds(s) AS ts").write.mode("append").parquet(source)
            stream = file_stream(spark, source, "parquet", "id INT, ts TIMESTAMP")
            out = append_to(dedup_within(stream, ["id"], "ts", "1 minute").select("id"), f"{folder}/out-{parts}", f"{folder}/c-{parts}")
        results.append(sorted(r.id for r in out.collect()))
    assert results[0] == results[1] == list(range(120))


def test_partitioned_stream_writes_by_counted_bytes(spark, folder):
    """A topic with most of the rows goes to several tasks, a small one to one file."""
    spark.range(400_000).selectExpr("CASE WHEN id % 50 = 0 THEN concat('small', id % 7) ELSE 'large' END AS topic",
                                    "md5(CAST(id AS STRING)) AS v").write.parquet(f"{folder}/in")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        stream = file_stream(spark, f"{folder}/in", "parquet", "topic STRING, v STRING")
        out = append_to(stream, f"{folder}/out", f"{folder}/checkpoint", ["topic"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = out.select("topic", F.col("_metadata.file_path").alias("f")).distinct().groupBy("topic").count()
    counts = {r["topic"]: r["count"] for r in files.collect()}
    assert out.count() == 400_000 and len(counts) == 8
    large = counts.pop("large")
    assert large >= 4 and max(counts.values()) <= large
    assert list(counts.values()).count(1) >= 4  # those that share no shuffle partition with the large one


def test_watched_stream_stops_above_a_rate(spark, folder):
    def land(*values):
        spark.createDataFrame([(v,) for v in values], "v INT").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return file_stream(spark, f"{folder}/in", "parquet", "v INT")

    def watched(share):
        return WatchedStream(spark, f"{folder}/out", "v INT", {"positive": "v > 0", "small": "v < 100"}, {"positive": share})

    watched(0.3).run(land(1, 2, 3, -4, None, 500), f"{folder}/checkpoint")
    assert rows(watched(0.3).figures()) == [(0, "positive", 6, 1), (0, "small", 6, 1)]
    with pytest.raises(Exception, match="too often"):
        watched(0.3).run(land(-1, -2, 3), f"{folder}/checkpoint")
    assert watched(0.3).rows().count() == 6 and watched(0.3).figures().count() == 2
    accepted = watched(0.9).run(land(), f"{folder}/checkpoint")
    assert accepted.count() == 9
    assert rows(watched(0.9).figures().where("rule = 'positive'")) == [(0, "positive", 6, 1), (1, "positive", 3, 2)]
    assert issubclass(RateExceeded, RuntimeError)


def test_schema_finds_a_field_of_one_row_in_many(spark):
    rare = '{"a": 1, "deep": {"only": [{"here": true}]}, "n": null}'
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") == 123_456, rare).when(F.col("id") == 5, "no json").when(
        F.col("id") == 6, "[1]").when(F.col("id") == 7, '{"b": "text"}').otherwise('{"a": 2, "b": 3}').alias("j"))
    schema = whole_schema(df, "j")
    assert schema.simpleString() == "struct<a:bigint,b:string,deep:struct<only:array<struct<here:boolean>>>,n:string>"
    read = df.select(F.from_json("j", schema).alias("r")).where("r.deep IS NOT NULL").select("r.a", "r.deep.only.here").collect()
    assert [tuple(r) for r in read] == [(1, [True])]
    assert len(whole_schema(df.limit(0), "j")) == 0
