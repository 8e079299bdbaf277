import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import ChangeTable, latest_per_key, missed_rows, newest_wins
from millrace.streaming import (
    append_to, complete_to, complete_writer, dedup_stream, dedup_upsert, each_batch, run_available_now, run_every,
    stop_all,
    stream_static_join, stream_stream_join,
)

SCHEMA = "id INT, ts TIMESTAMP, v STRING"


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def land(spark, path, data, schema=SCHEMA):
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema=SCHEMA, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


def test_dedup_within_and_between_batches(spark, folder):
    for salt in (None, ["v"]):
        base = f"{folder}/{salt is None}"
        unique = lambda: dedup_stream(stream(spark, f"{base}/in"), ["id", "ts"], "ts", "30 seconds", salt)
        land(spark, f"{base}/in", [(1, at(0), "a"), (1, at(0), "b"), (2, at(1), "a")])
        append_to(unique(), f"{base}/t", f"{base}/c")
        land(spark, f"{base}/in", [(1, at(0), "c"), (3, at(2), "a")])
        out = append_to(unique(), f"{base}/t", f"{base}/c")
        assert rows(out.select("id")) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        dedup_stream(stream(spark, f"{base}/in"), ["id"], "ts")


def test_late_rows_are_dropped_behind_the_watermark(spark, folder):
    """The row is dropped from the second batch after the one that moved the watermark."""
    for batch in ([(1, at(0), "a")], [(2, at(600), "b")], [(3, at(601), "c")], [(4, at(5), "late"), (5, at(602), "d")]):
        land(spark, f"{folder}/in", batch)
        out = append_to(
            dedup_stream(stream(spark, f"{folder}/in"), ["id", "ts"], "ts", "30 seconds"), f"{folder}/t", f"{folder}/c"
        )
    assert [r[0] for r in rows(out.select("id"))] == [1, 2, 3, 5]


def test_upsert_dedup_against_the_table(spark, folder):
    keys = ["id", "ts"]
    land(spark, f"{folder}/in", [(1, at(0), "a"), (1, at(0), "a"), (2, at(1), "b")])
    run = lambda n: dedup_upsert(stream(spark, f"{folder}/in"), f"{folder}/t", SCHEMA, keys, f"{folder}/c{n}", "ts")
    assert rows(run(1).select("id")) == [(1,), (2,)]
    assert run(1).count() == 2
    land(spark, f"{folder}/in", [(2, at(1), "again"), (3, at(900), "c")])
    assert rows(run(1).select("id")) == [(1,), (2,), (3,)]
    assert rows(run(2).select("id")) == [(1,), (2,), (3,)]


def test_static_side_is_read_afresh_and_misses_can_be_repaired(spark, folder):
    static = f"{folder}/static"
    land(spark, static, [("a", 1)], "v STRING, n INT")
    lookup = lambda: spark.read.schema("v STRING, n INT").parquet(static)
    run = lambda: stream_static_join(stream(spark, f"{folder}/in"), lookup, ["v"], f"{folder}/t", f"{folder}/c")
    land(spark, f"{folder}/in", [(1, at(0), "a"), (2, at(1), "b")])
    assert rows(run().select("id")) == [(1,)]
    land(spark, static, [("b", 2)], "v STRING, n INT")
    assert rows(run().select("id")) == [(1,)], "static rows alone trigger nothing"
    land(spark, f"{folder}/in", [(3, at(2), "b")])
    joined = run()
    assert rows(joined.select("id", "n")) == [(1, 1), (3, 2)]
    table = spark.read.schema(SCHEMA).parquet(f"{folder}/in")
    assert rows(missed_rows(table, joined, lookup(), ["id"], ["v"]).select("id", "n")) == [(2, 2)]


def test_streams_meet_across_runs(spark, folder):
    left = lambda: stream(spark, f"{folder}/l", "id INT, k INT")
    right = lambda: stream(spark, f"{folder}/r", "k INT, v STRING")
    run = lambda: append_to(
        stream_stream_join(left(), right(), ["k"], salt_from=["id"], salts=4), f"{folder}/t", f"{folder}/c"
    )
    land(spark, f"{folder}/l", [(1, 7), (2, 7), (3, 8)], "id INT, k INT")
    land(spark, f"{folder}/r", [(8, "x")], "k INT, v STRING")
    assert rows(run().select("id", "v")) == [(3, "x")]
    land(spark, f"{folder}/r", [(7, "y")], "k INT, v STRING")
    assert rows(run().select("id", "v")) == [(1, "y"), (2, "y"), (3, "x")]


def test_bounded_stream_join(spark, folder):
    land(spark, f"{folder}/l", [(1, at(0)), (2, at(500))], "k INT, lt TIMESTAMP")
    land(spark, f"{folder}/r", [(1, at(10)), (2, at(0))], "k INT, rt TIMESTAMP")
    apart = F.expr("INTERVAL 60 seconds")
    joined = stream_stream_join(
        stream(spark, f"{folder}/l", "k INT, lt TIMESTAMP"), stream(spark, f"{folder}/r", "k INT, rt TIMESTAMP"),
        ["k"], left_watermark=("lt", "60 seconds"), right_watermark=("rt", "60 seconds"),
        time_bound=F.col("lt").between(F.col("rt") - apart, F.col("rt") + apart),
    )
    assert rows(append_to(joined, f"{folder}/t", f"{folder}/c").select("k")) == [(1,)]


def test_append_mode_emits_closed_windows_only(spark, folder):
    land(spark, f"{folder}/in", [(1, at(0), "a"), (2, at(100), "a"), (3, at(2000), "a")])
    counts = (
        stream(spark, f"{folder}/in").withWatermark("ts", "10 minutes")
        .groupBy(F.window("ts", "5 minutes"), "v").agg(F.count("id").alias("n")).select("window.start", "n")
    )
    assert rows(append_to(counts, f"{folder}/t", f"{folder}/c")) == [(at(0), 2)]


def test_complete_mode_overwrites_the_table(spark, folder):
    run = lambda: complete_to(
        stream(spark, f"{folder}/in").groupBy("v").agg(F.count("id").alias("n")), "counts_t", f"{folder}/t", f"{folder}/c"
    )
    land(spark, f"{folder}/in", [(1, at(0), "a"), (2, at(0), "b")])
    assert rows(run()) == [("a", 1), ("b", 1)]
    land(spark, f"{folder}/in", [(3, at(0), "a")])
    assert rows(run()) == rows(run()) == [("a", 2), ("b", 1)]


def test_the_same_aggregate_runs_continuously(spark, folder):
    writer = lambda: complete_writer(
        stream(spark, f"{folder}/in").groupBy("v").agg(F.count("id").alias("n")), "live_t", f"{folder}/t"
    )
    land(spark, f"{folder}/in", [(1, at(0), "a")])
    query = run_every(writer(), f"{folder}/c", "1 second")
    query.processAllAvailable()
    land(spark, f"{folder}/in", [(2, at(0), "a"), (3, at(0), "b")])
    query.processAllAvailable()
    assert rows(spark.table("live_t")) == [("a", 2), ("b", 1)]
    stop_all(spark)
    land(spark, f"{folder}/in", [(4, at(0), "b")])
    run_available_now(writer(), f"{folder}/c")
    assert rows(spark.table("live_t")) == [("a", 2), ("b", 2)]


def test_ranked_upsert_per_batch(spark, folder):
    table = ChangeTable(spark, f"{folder}/t", SCHEMA, ["id"])
    plans = []

    def write(batch, batch_id):
        plans.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        newest = latest_per_key(batch, ["id"], [F.col("ts").desc()])
        table.merge(newest, ["id"], **newest_wins("ts"), writer="w", batch=batch_id)

    land(spark, f"{folder}/in", [(1, at(0), "a"), (1, at(5), "b"), (2, at(0), "c")])
    each_batch(stream(spark, f"{folder}/in").dropDuplicates(["id", "ts"]), write, f"{folder}/c")
    land(spark, f"{folder}/in", [(1, at(3), "late"), (2, at(9), "d")])
    each_batch(stream(spark, f"{folder}/in").dropDuplicates(["id", "ts"]), write, f"{folder}/c")
    assert rows(table.current().select("id", "v")) == [(1, "b"), (2, "d")]
    assert set(plans) == {"true"}


def test_what_a_stream_rejects(spark, folder):
    land(spark, f"{folder}/in", [(1, at(0), "a")])
    ranked = lambda: latest_per_key(stream(spark, f"{folder}/in"), ["id"], [F.col("ts").desc()])
    sorted_rows = lambda: stream(spark, f"{folder}/in").orderBy("id")
    for build in (ranked, sorted_rows):
        with pytest.raises(AnalysisException):
            append_to(build(), f"{folder}/t", f"{folder}/c")


def test_triggers_and_stopping(spark, folder):
    land(spark, f"{folder}/in", [(1, at(0), "a")])
    seen = []
    source = stream(spark, f"{folder}/in")
    writer = source.writeStream.foreachBatch(lambda b, _: seen.append(b.count()))
    writer.option("checkpointLocation", f"{folder}/c1").trigger(once=True).start().awaitTermination()
    query = run_every(source.writeStream.foreachBatch(lambda b, _: seen.append(b.count())), f"{folder}/c2", "1 second")
    query.processAllAvailable()
    assert query.isActive and stop_all(spark) == 1 and not query.isActive
    run_available_now(source.writeStream.foreachBatch(lambda b, _: seen.append(b.count())), f"{folder}/c3")
    assert seen == [1, 1, 1]


def test_streaming_views_stay_streaming(spark, folder):
    land(spark, f"{folder}/in", [(1, at(0), "a")])
    stream(spark, f"{folder}/in").createOrReplaceTempView("raw_stream")
    spark.sql("CREATE OR REPLACE TEMP VIEW counted AS SELECT v, count(*) AS n FROM raw_stream GROUP BY v")
    assert spark.table("counted").isStreaming
