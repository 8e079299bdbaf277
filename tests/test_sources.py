import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace.functions import domain_part, json_path
from millrace.session import new_folder, read_if_present, shared_root, written
from millrace.sources import (
    ENVELOPE_SCHEMA, bronze_envelope, copy_into, envelope_of, ingest_files, parse_topic, with_provenance,
)
from millrace.sources.files import evolving_schema, file_stream, merge_schemas
from millrace.streaming import append_to


def test_shared_root_is_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert new_folder(spark, "x").startswith(f"{root}/x-") and new_folder(spark, "x") != new_folder(spark, "x")


def test_written_cuts_lineage(spark, folder):
    df = written(spark.range(5).selectExpr("id", "id % 2 AS p"), f"{folder}/w", ["p"])
    assert df.columns == ["id", "p"] and df.count() == 5
    assert read_if_present(spark, f"{folder}/none", "a INT").count() == 0


def test_copy_into_loads_each_file_once(spark, folder):
    source, target, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    spark.range(3).write.json(source)
    for _ in range(2):
        assert copy_into(spark, target, source, "json", checkpoint).count() == 3
    spark.range(3, 5).write.mode("append").json(source)
    assert copy_into(spark, target, source, "json", checkpoint).count() == 5


def test_copy_into_refuses_unknown_fields(spark, folder):
    source, target, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    spark.range(3).write.json(source)
    copy_into(spark, target, source, "json", checkpoint)
    spark.range(3, 5).selectExpr("id", "'x' AS extra").write.mode("append").json(source)
    for _ in range(2):  # a refused file stays refused
        with pytest.raises(ValueError, match="extra"):
            copy_into(spark, target, source, "json", checkpoint)
    assert spark.read.parquet(target).count() == 3
    assert copy_into(spark, target, source, "json", checkpoint, merge_schema=True).count() == 5


def test_files_of_any_date_are_loaded(spark, folder):
    source, target, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    spark.range(2).coalesce(1).write.parquet(source)
    assert copy_into(spark, target, source, "parquet", checkpoint, schema="id BIGINT").count() == 2
    spark.range(2, 4).coalesce(1).write.mode("append").parquet(source)
    old = time.time() - 10 * 86400
    for path in Path(source).glob("*.parquet"):
        os.utime(path, (old, old))
    spark.range(4, 5).coalesce(1).write.mode("append").parquet(source)
    loaded = copy_into(spark, target, source, "parquet", checkpoint, schema="id BIGINT")
    assert {r.id for r in loaded.collect()} == {0, 1, 2, 3, 4}


def test_schemas_merge_at_any_depth():
    merge = lambda a, b, text=True: merge_schemas(T.StructType.fromDDL(a), T.StructType.fromDDL(b), text).simpleString()
    assert merge("a INT, s STRUCT<x: INT>", "s STRUCT<y: INT>, b INT") == "struct<a:int,s:struct<x:int,y:int>,b:int>"
    assert merge("l ARRAY<STRUCT<x: INT>>", "l ARRAY<STRUCT<x: BIGINT, z: STRING>>") == "struct<l:array<struct<x:bigint,z:string>>>"
    assert merge("a BIGINT, b INT", "a STRING, b DOUBLE") == "struct<a:string,b:double>"
    for a, b, text in (("a BIGINT", "a STRING", False), ("a BIGINT", "a STRUCT<x: INT>", True)):
        with pytest.raises(ValueError, match="no common type"):
            merge(a, b, text)


def test_new_nested_fields_and_parquet_columns_are_found(spark, folder):
    def run(fmt, place):
        stream = ingest_files(spark, f"{folder}/{place}", fmt, schema_location=f"{folder}/{place}-schema")
        append_to(stream, f"{folder}/{place}-t", f"{folder}/{place}-c")
        return spark.read.option("mergeSchema", "true").parquet(f"{folder}/{place}-t")

    spark.range(2).selectExpr("id", "struct(id AS a) AS s").write.json(f"{folder}/j")
    run("json", "j")
    spark.range(2, 4).selectExpr("id", "struct(id AS a, 'x' AS b) AS s").write.mode("append").json(f"{folder}/j")
    assert rows(run("json", "j").selectExpr("id", "s.a", "s.b")) == [(0, 0, None), (1, 1, None), (2, 2, "x"), (3, 3, "x")]
    spark.range(2).write.parquet(f"{folder}/p")
    run("parquet", "p")
    spark.range(2, 3).selectExpr("id", "'n' AS extra").write.mode("append").parquet(f"{folder}/p")
    assert rows(run("parquet", "p").selectExpr("id", "extra")) == [(0, None), (1, None), (2, "n")]


def test_a_restart_infers_from_new_files_only(spark, folder):
    spark.range(2).write.json(f"{folder}/in")
    first = evolving_schema(spark, f"{folder}/in", "json", f"{folder}/schema")
    for path in Path(f"{folder}/in").glob("part-*"):  # what was read once is not read again
        if path.stat().st_size:
            path.write_text("not json")
    assert evolving_schema(spark, f"{folder}/in", "json", f"{folder}/schema") == first
    spark.range(2).selectExpr("id", "1 AS n").write.mode("append").json(f"{folder}/in")
    assert evolving_schema(spark, f"{folder}/in", "json", f"{folder}/schema").fieldNames() == ["id", "n"]


def test_a_stream_gives_the_same_rows_in_bounded_batches(spark, folder):
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in", "parquet", "id BIGINT", max_bytes=1)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/t").option(
        "checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/t").count() == 40
    assert len(query.recentProgress) >= 4


def test_copy_into_can_widen_the_table(spark, folder):
    source, target, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    spark.range(3).write.json(source)
    copy_into(spark, target, source, "json", checkpoint, merge_schema=True)
    spark.range(3, 5).selectExpr("id", "'x' AS extra").write.mode("append").json(source)
    wide = copy_into(spark, target, source, "json", checkpoint, merge_schema=True)
    assert rows(wide.select("id", "extra")) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x")]


def test_copy_into_csv_with_options(spark, folder):
    spark.createDataFrame([("B1", 2.5)], "book_id STRING, price DOUBLE").write.option("header", True).option(
        "delimiter", ";").csv(f"{folder}/in")
    options = {"header": "true", "delimiter": ";"}
    df = copy_into(spark, f"{folder}/out", f"{folder}/in", "csv", f"{folder}/c",
                   schema="book_id STRING, price DOUBLE", options=options)
    assert rows(df) == [("B1", 2.5)]


def test_ingestion_needs_a_schema_or_its_place(spark, folder):
    with pytest.raises(ValueError):
        ingest_files(spark, folder, "json")


def test_ingestion_picks_up_new_fields_on_restart(spark, folder):
    def run():
        stream = ingest_files(spark, f"{folder}/in", "json", schema_location=f"{folder}/schema")
        return append_to(stream, f"{folder}/t", f"{folder}/c")

    spark.range(2).write.json(f"{folder}/in")
    assert run().columns == ["id"]
    spark.range(2, 4).selectExpr("id", "id * 2 AS twice").write.mode("append").json(f"{folder}/in")
    assert rows(run().select("id", "twice")) == [(0, None), (1, None), (2, 4), (3, 6)]


def test_envelope_round_trip(spark, folder):
    rows_in = spark.createDataFrame([("a", 1), ("b", 2)], "id STRING, n INT").withColumn(
        "at", F.expr("timestamp_micros(1700000000123456)"))
    messages = envelope_of(rows_in, "things", "id", F.col("n"), F.col("at"))
    messages.write.json(f"{folder}/raw")
    raw = spark.read.schema(ENVELOPE_SCHEMA).json(f"{folder}/raw")
    bronze = bronze_envelope(raw)
    assert {r.year_month for r in bronze.collect()} == {"2023-11"}
    parsed = parse_topic(bronze, "things", "id STRING, n INT, at TIMESTAMP", keep=["offset"])
    assert rows(parsed.select("id", "n", "_offset")) == [("a", 1, 1), ("b", 2, 2)]
    assert parsed.select("at").distinct().collect() == rows_in.select("at").distinct().collect()
    assert parse_topic(bronze, "other", "id STRING").count() == 0


def test_topic_filter_prunes_partitions(spark, folder):
    rows_in = spark.createDataFrame([("a", 1)], "id STRING, n INT")
    for topic in ("x", "y"):
        messages = bronze_envelope(envelope_of(rows_in, topic, "id", F.col("n"), F.lit("2024-01-01")))
        messages.write.mode("append").partitionBy("topic", "year_month").parquet(f"{folder}/bronze")
    parsed = parse_topic(spark.read.parquet(f"{folder}/bronze"), "x", "id STRING")
    assert parsed.count() == 1
    assert "PartitionFilters: [isnotnull(topic" in parsed._jdf.queryExecution().toString()


def test_provenance(spark, folder):
    spark.range(3).write.json(f"{folder}/in")
    got = with_provenance(spark.read.json(f"{folder}/in"))
    assert got.columns == ["id", "arrival_time", "source_file"]
    assert got.where("source_file LIKE '%.json'").count() == 3


def test_json_paths_and_malformed_text(spark):
    df = spark.createDataFrame([('{"a": {"b": "x"}}',), ("not json",), (None,)], "j STRING")
    assert [r[0] for r in df.select(json_path("j", "a.b")).collect()] == ["x", None, None]
    assert [r[0] for r in df.select(F.from_json("j", "n INT").alias("s")).select("s.n").collect()] == [None] * 3


def test_mail_without_at_sign(spark):
    df = spark.createDataFrame([("a@b.com",), ("nobody",), (None,)], "e STRING")
    assert [r[0] for r in df.select(domain_part("e")).collect()] == ["b.com", None, None]
