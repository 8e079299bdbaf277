import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import latest_per_key
from millrace.session import read_if_present
from millrace.streaming import append_to, each_batch
from millrace.streaming.late import LateSplit, RowsDropped, dropped_rows
from millrace.streaming.newest import newest_version_join

ORDERS, VERSIONS = "id INT, k STRING, ts TIMESTAMP, v DOUBLE", "k STRING, at TIMESTAMP, name STRING"


def at(seconds, micros=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds, microseconds=micros)


def land(spark, path, data, schema):
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


class Deliveries:
    """Orders and versions that come in turn, and what their join has delivered."""

    def __init__(self, spark, folder, keep, salts=3):
        self.spark, self.folder, self.keep, self.salts = spark, folder, keep, salts
        for side, schema in (("orders", ORDERS), ("versions", VERSIONS)):
            land(spark, f"{folder}/{side}", [], schema)

    def __call__(self, orders=(), versions=()):
        land(self.spark, f"{self.folder}/orders", orders, ORDERS)
        land(self.spark, f"{self.folder}/versions", versions, VERSIONS)
        joined = newest_version_join(
            stream(self.spark, f"{self.folder}/orders", ORDERS), stream(self.spark, f"{self.folder}/versions", VERSIONS),
            ["k"], "ts", "at", self.keep, salt_from=["id"], salts=self.salts)
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{self.folder}/out/batch={n}")
        self.query = each_batch(joined, write, f"{self.folder}/checkpoint")
        return self.newest()

    def newest(self):
        schema = "k STRING, id INT, ts TIMESTAMP, v DOUBLE, at TIMESTAMP, name STRING"
        out = read_if_present(self.spark, f"{self.folder}/out", schema)
        return rows(latest_per_key(out.select("id", "k", "name", "at"), ["id"], [F.col("at").desc()], ties="one").select("id", "name"))

    def state_rows(self):
        return sum(s.numRowsTotal for s in self.query.recentProgress[-1].stateOperators)


def test_rows_meet_the_newest_version_while_they_wait(spark, folder):
    run = Deliveries(spark, folder, "100 seconds")
    assert run([(1, "a", at(0), 1.5), (2, "b", at(10), None), (3, None, at(10), 1.0)], []) == []
    assert run([], [("a", at(5), "a1"), ("a", at(4), "a0"), (None, at(4), "x"), ("b", None, "y")]) == [(1, "a1")]
    assert run([(4, "a", at(20), 2.0)], [("b", at(1), "b1")]) == [(1, "a1"), (2, "b1"), (4, "a1")]
    # an older version changes nothing, a newer one reaches all rows that wait
    assert run([], [("a", at(3), "old")]) == [(1, "a1"), (2, "b1"), (4, "a1")]
    assert run([], [("a", at(9), "a2")]) == [(1, "a2"), (2, "b1"), (4, "a2")]
    # rows that are 100 seconds behind have gone
    run([(5, "c", at(500), 0.0)], [])
    assert run([], [("a", at(99), "a3"), ("c", at(0), "c1")]) == [(1, "a2"), (2, "b1"), (4, "a2"), (5, "c1")]


def test_values_pass_the_state_unchanged(spark, folder):
    run = Deliveries(spark, folder, "1 day")
    run([(1, "a", at(0, 123457), 0.1), (2, "a", at(1), None)], [("a", at(7, 7), 'ü"\n')])
    out = read_if_present(spark, f"{folder}/out", "k STRING, id INT, ts TIMESTAMP, v DOUBLE, at TIMESTAMP, name STRING")
    assert rows(out.select("k", "id", "ts", "v", "at", "name").distinct()) == [
        ("a", 1, at(0, 123457), 0.1, at(7, 7), 'ü"\n'), ("a", 2, at(1), None, at(7, 7), 'ü"\n')]


def test_state_stays_bounded(spark, folder):
    run, seen = Deliveries(spark, folder, "60 seconds"), []
    for step in range(4):
        run([(step * 300 + n, "hot", at(step * 1000 + n % 50), 0.0) for n in range(300)], [("hot", at(step), f"v{step}")])
        seen.append(run.state_rows())
    assert seen[-1] <= 1.2 * seen[0], seen  # four times the rows, no more state
    assert len(run.newest()) == 1200


def test_keys_share_the_groups_of_the_state(spark, folder):
    run = Deliveries(spark, folder, "100 seconds")
    keys = 3000
    assert run([(n, f"k{n}", at(0), 0.0) for n in range(keys)], [(f"k{n}", at(0), f"v{n}") for n in range(0, keys, 2)]) == sorted(
        [(n, f"v{n}") for n in range(0, keys, 2)], key=repr)
    # 256 groups with at most 16 lists of versions, one slot, its list of rows and two rows for its timer; a group per key had over 10,000
    assert run.state_rows() <= 256 * (16 + 1 + 1 + 2)
    newest = run([], [("k0", at(-1), "old"), ("k1", at(1), "w1"), ("k2", at(1), "w2")])
    assert newest == sorted([(1, "w1"), (2, "w2"), *((n, f"v{n}") for n in range(0, keys, 2) if n != 2)], key=repr)


def test_sides_with_shared_names_are_refused(spark, folder):
    land(spark, f"{folder}/o", [], ORDERS)
    orders = stream(spark, f"{folder}/o", ORDERS)
    with pytest.raises(ValueError):
        newest_version_join(orders, orders, ["k"], "ts", "ts", "1 day")


EVENTS = "id INT, ts TIMESTAMP"


def split_run(spark, folder, split, batch):
    land(spark, f"{folder}/in", batch, EVENTS)
    split.run(stream(spark, f"{folder}/in", EVENTS), f"{folder}/c1")
    counts = split.on_time_stream().groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count("id").alias("n")).select("w.start", "n")
    write = lambda rows_, n: rows_.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")
    query = each_batch(counts, write, f"{folder}/c2")
    split.check(query)
    return query


def test_late_rows_are_kept_and_all_rows_accounted_for(spark, folder):
    split = LateSplit(spark, f"{folder}/split", EVENTS, "ts", "30 seconds")
    split_run(spark, folder, split, [(1, at(0)), (2, at(300)), (3, None)])
    split_run(spark, folder, split, [(4, at(269)), (5, at(270)), (6, at(100)), (7, at(1000))])
    split_run(spark, folder, split, [(8, at(970)), (9, at(969)), (10, at(5000))])
    split_run(spark, folder, split, [(11, at(9000))])
    assert rows(split.late().select("id")) == [(4,), (6,), (9,)]
    assert rows(split.figures()) == [(1, 3, 0), (2, 4, 2), (3, 3, 1), (4, 1, 0)]
    counted = read_if_present(spark, f"{folder}/out", "start TIMESTAMP, n BIGINT")
    # 1, 2, 5, 7, 8 are in closed windows, 10 and 11 in open ones (a window comes out with the next micro-batch), 3 has no time
    assert rows(counted.select("start", "n")) == [(at(0), 1), (at(960), 2), (at(240), 1), (at(300), 1)]
    assert counted.agg(F.sum("n")).first()[0] + split.late().count() + 3 == 11


def test_a_failed_micro_batch_is_delivered_once(spark, folder, monkeypatch):
    split = LateSplit(spark, f"{folder}/split", EVENTS, "ts", "30 seconds")
    land(spark, f"{folder}/in", [(1, at(0))], EVENTS)
    real = LateSplit._write

    def torn(self, batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{self.path}/changes/_commit_version={batch_id + 1}")
        raise RuntimeError("lost")

    monkeypatch.setattr(LateSplit, "_write", torn)
    with pytest.raises(Exception, match="lost"):
        split.run(stream(spark, f"{folder}/in", EVENTS), f"{folder}/c1")
    monkeypatch.setattr(LateSplit, "_write", real)
    assert append_to(split.on_time_stream(), f"{folder}/a", f"{folder}/ca").count() == 0
    split.run(stream(spark, f"{folder}/in", EVENTS), f"{folder}/c1")
    assert rows(append_to(split.on_time_stream(), f"{folder}/a", f"{folder}/ca").select("id")) == [(1,)]
    real(split, spark.createDataFrame([(9, at(9))], EVENTS), 0)  # a replay after the commit
    assert rows(split.figures()) == [(1, 1, 0)]


def test_dropped_rows_are_reported(spark, folder):
    split = LateSplit(spark, f"{folder}/split", EVENTS, "ts", "30 seconds")
    query = None
    for n, batch in enumerate([[(1, at(0))], [(2, at(600))], [(3, at(601))], [(4, at(5))]]):
        land(spark, f"{folder}/in", batch, EVENTS)
        plain = stream(spark, f"{folder}/in", EVENTS).withWatermark("ts", "30 seconds").dropDuplicates(["id", "ts"])
        query = each_batch(plain, lambda b, _: None, f"{folder}/c")
    assert dropped_rows(query) == 1
    with pytest.raises(RowsDropped):
        split.check(query)
