"""The multi-topic flow as a whole."""

import gzip
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from conftest import SMALL, rows
from millrace.operators import assert_unique
from millrace.plans import medallion
from millrace.plans.feeds import message_batches
from millrace.plans.inputs import ORDER_SCHEMA, Tables, cents, countries, order_documents
from millrace.plans.medallion import Medallion, steps_for
from millrace.queries.streams import _Run
from millrace.session import STATE_STORE
from millrace.sources.envelope import envelope_of
from millrace.streaming import append_to, dedup_stream, dedup_upsert


def test_flow_is_incremental_and_repeatable(spark, folder):
    t = Tables(spark, SMALL)
    flow = Medallion(spark, folder, countries(t), "flow_current_books", fold_every=2)
    first, second = message_batches(t)
    flow.run_batch(first)
    orders = spark.read.parquet(f"{folder}/orders_silver").count()
    flow.run_batch(second)
    assert spark.read.parquet(f"{folder}/orders_silver").count() > orders
    tables = (flow.customers, flow.books, flow.customers_orders)
    state = [rows(x.current()) for x in tables] + [flow.spark.read.parquet(f"{folder}/books_sales").count()]

    # the same messages once more: bronze keeps them, no later table changes
    before = flow.bronze().count()
    flow.run_batch(second)
    assert flow.bronze().count() > before
    again = [rows(x.current()) for x in tables] + [flow.spark.read.parquet(f"{folder}/books_sales").count()]
    assert again == state

    for x in tables:
        assert_unique(x.current(), x.keys)
    assert_unique(flow.books.current().where("current"), ["book_id"])

    flow.process_delete_requests()
    flow.process_deletes()
    asked = flow.requests.current()
    gone = asked.select("customer_id")
    assert asked.count() > 0
    assert flow.customers.current().join(gone, ["customer_id"], "left_semi").count() == 0
    assert flow.customers_orders.current().join(gone, ["customer_id"], "left_semi").count() == 0
    done = rows(asked)
    flow.process_delete_requests()
    flow.process_deletes()
    assert rows(flow.requests.current()) == done

    flow.customers.expire(older_than_hours=0, force=True)
    stored = spark.read.schema(flow.customers.schema).option("recursiveFileLookup", "true").parquet(
        f"{folder}/customers_silver/base", f"{folder}/customers_silver/changes")
    assert stored.join(gone, ["customer_id"], "left_semi").count() == 0


def test_only_the_needed_steps_run(spark, folder):
    assert steps_for("current_books") == {"bronze", "books_silver", "current_books"}
    t, steps = Tables(spark, SMALL), steps_for("deletes")
    flow = Medallion(spark, folder, countries(t), "deletes_current_books")
    for messages in message_batches(t):
        flow.run_batch(messages, steps)
    before = flow.customers.current().count()
    flow.process_delete_requests()
    flow.process_deletes()
    asked = flow.requests.current()
    assert asked.where("status = 'deleted'").count() > 0
    gone = asked.select("customer_id").distinct()
    assert flow.customers.current().join(gone, ["customer_id"], "left_semi").count() == 0 < flow.customers.current().count() < before
    assert sorted(p.name for p in Path(folder).iterdir() if not p.name.startswith("_")) == [
        "bronze", "customers_silver", "delete_requests", "raw"]


class _Updates(StreamingQueryListener):
    """Rows that the state of a query has taken in, until it ends."""

    def __init__(self):
        self.rows, self.ended = 0, threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows += sum(o.numRowsUpdated for o in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()


def test_a_batch_out_of_state_is_made_once(spark, folder):
    t, keys = Tables(spark, SMALL), ["order_id", "order_timestamp"]
    flow = Medallion(spark, folder, countries(t), "once_current_books")
    flow.run_batch(message_batches(t)[0], steps_for("bronze"))
    watch = _Updates()
    spark.streams.addListener(watch)
    try:
        unique = dedup_stream(flow.topic_stream("orders", ORDER_SCHEMA), keys, "order_timestamp")
        table = dedup_upsert(unique, f"{folder}/unique", ORDER_SCHEMA, keys, f"{folder}/checkpoint", "order_timestamp")
        assert watch.ended.wait(30)
    finally:
        spark.streams.removeListener(watch)
    assert watch.rows == table.count() > 0


def test_order_documents_are_made_once_for_both_batches(spark):
    first, _ = message_batches(Tables(spark, SMALL))
    assert not [f for f in first.inputFiles() if "lineitem" in f]


def test_commits_of_state_write_changes_only(spark, folder):
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        spark.range(1, 21).selectExpr("id", "timestamp_seconds(id) AS ts").write.parquet(f"{folder}/in")
        rows_in = spark.readStream.schema("id LONG, ts TIMESTAMP").parquet(f"{folder}/in")
        append_to(dedup_stream(rows_in, ["id", "ts"], "ts"), f"{folder}/t", f"{folder}/c")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    assert list(Path(folder, "c", "state").rglob("*.changelog"))
    assert spark.read.parquet(f"{folder}/t").count() == 20


def test_state_is_logged_with_zstd(spark, folder):
    """Rows of state are written for good at every commit; a new checkpoint packs them with zstd and notes it."""
    spark.range(1, 21).selectExpr("id", "timestamp_seconds(id) AS ts").write.parquet(f"{folder}/in")
    rows_in = spark.readStream.schema("id LONG, ts TIMESTAMP").parquet(f"{folder}/in")
    append_to(dedup_stream(rows_in, ["id", "ts"], "ts"), f"{folder}/t", f"{folder}/c")
    assert '"spark.sql.streaming.stateStore.compression.codec":"zstd"' in Path(folder, "c", "offsets", "0").read_text()
    assert spark.read.parquet(f"{folder}/t").count() == 20


def test_documents_of_orders_move_numbers_and_round_without_text(spark):
    """Lines meet as numbers, and amounts are rounded like ``round`` does, but without decimals made from text."""
    amounts = [0.0, -0.0, 1.005, 2.675, 0.125, -0.125, 0.005, -0.005, 0.0049999999999999994, 123456.785, -7.5, 9e13, None]
    frame = spark.createDataFrame([(a,) for a in amounts], "a double")
    got = frame.select(cents("a").alias("ours"), F.round(F.col("a") * 100).cast("bigint").alias("rounded")).collect()
    assert [r.ours for r in got] == [r.rounded for r in got]

    t = Tables(spark, SMALL)
    plan = order_documents(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
    collected = next(part for part in plan.split("\n") if "collect_list(" in part)
    assert "cast(book_key" not in collected
    lines = {(r.order_id, b.book_id, b.quantity, b.subtotal) for r in order_documents(t).collect() for b in r.books}
    plain = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").cast("string"), F.sum(F.col("l_quantity").cast("bigint")), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")))
    assert lines == {(str(r[0]), r[2], r[3], r[4]) for r in plain.collect()}


def test_raw_messages_are_packed_and_cut_into_files(spark, folder, monkeypatch):
    """Raw files take a fraction of their JSON, none holds more than a task should read, and bronze gets every message as it was."""
    monkeypatch.setattr(medallion, "MESSAGES_PER_FILE", 400)
    sent = envelope_of(
        spark.range(0, 1000, 1, 1).selectExpr("id", "concat('somebody', id, '@example.com') AS email", "timestamp_seconds(id) AS ts"),
        "customers", "id", F.col("id"), F.col("ts"))
    flow = Medallion(spark, folder, spark.createDataFrame([], "code STRING, country STRING"), "packed_current_books")
    flow.land(sent)
    files = list(Path(folder, "raw").glob("part-*"))
    texts = [gzip.decompress(p.read_bytes()) for p in files]
    assert sorted(t.count(b"\n") for t in texts) == [200, 400, 400]
    assert sum(p.stat().st_size for p in files) < sum(map(len, texts)) / 3
    flow.process_bronze()
    kept = ["key", "value", "topic", "partition", "offset"]
    assert rows(flow.bronze().select(kept)) == rows(sent.select(kept))


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in blocks.mkString("\n").split("\n") if "/shuffle_" in f}


def test_a_run_keeps_no_shuffles_and_stores_in_half(spark):
    """Shuffles of batches and micro-batches, with and without state, go as they end; what stays is written with zstd."""
    def left():
        wait_until = time.time() + 10
        while _shuffle_files(spark) - before and time.time() < wait_until:
            time.sleep(0.2)
        return _shuffle_files(spark) - before

    before, begin = _shuffle_files(spark), time.time()
    run = _Run(Tables(spark, SMALL), steps_for("books_sales"))
    assert not left()
    documents = [p for p in Path(run.flow.root).parent.glob("order-documents-*") if p.stat().st_ctime >= begin]
    assert documents and sum(spark.read.parquet(str(p)).count() for p in documents) == 0
    for step in ("bronze", "orders_silver", "books_sales"):
        files = list(Path(run.flow.root, step).rglob("part-*.parquet"))
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}

    # only within: a frame run twice by others has its shuffles still
    counts = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(counts.collect()) == len(counts.collect()) == 7
    assert _shuffle_files(spark) - before
