import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from millrace.functions import is_member, redact, row_policy
from millrace.operators.joins import small
from millrace.operators import (
    Check, CheckViolation, add_check, archive_partitions, assert_unique, compact, drop_check, enforce,
    file_stats, item_sets, lookup_join, missed_rows, not_null, partition_report, replace_table,
    salted_join, snapshots, split_valid, table_detail, zorder,
)
from millrace.operators import layout
from millrace.operators.layout import files_of, with_z_value, write_partitions, zorder_bits

ORDERS = "id STRING, at STRING, quantity INT"


def orders(spark):
    return spark.createDataFrame(
        [("1", "2022-02-01", 0), ("2", "2019-05-01", 0), ("3", "2023-01-01", 4), ("4", None, 5)], ORDERS
    )


def test_a_violated_check_rejects_the_whole_write(spark, folder):
    recent = {"recent": Check("recent", "at >= '2020-01-01'")}
    with pytest.raises(Exception, match="recent"):
        enforce(orders(spark), recent).write.parquet(f"{folder}/t")
    good = orders(spark).where("id <> '2'")
    enforce(good, recent).write.mode("overwrite").parquet(f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 3


def test_null_passes_unless_strict(spark):
    good, bad = split_valid(orders(spark), {"r": Check("r", "at >= '2020-01-01'")})
    assert good.count() == 3
    good, bad = split_valid(orders(spark), {"r": Check("r", "at >= '2020-01-01'", strict=True)})
    assert rows(bad.select("id", "failed_checks")) == [("2", ["r"]), ("4", ["r"])]


def test_adding_a_check_counts_violators(spark):
    with pytest.raises(CheckViolation, match="2 rows"):
        add_check(orders(spark), {}, Check("some", "quantity > 0"))
    checks = add_check(orders(spark), {}, not_null("id"))
    checks = add_check(orders(spark), checks, Check("sane", "quantity < 100"))
    assert list(drop_check(checks, "sane")) == ["id_not_null"]
    with pytest.raises(KeyError):
        drop_check(checks, "absent")
    with pytest.raises(CheckViolation):
        add_check(orders(spark), {}, not_null("at"))


def test_unique(spark):
    assert_unique(orders(spark), ["id"])
    with pytest.raises(AssertionError):
        assert_unique(orders(spark), ["quantity"])


def test_access_depends_on_the_user_at_query_time(spark):
    me = spark.sql("SELECT current_user()").first()[0]
    members = spark.createDataFrame([("admins", me), ("other", "nobody")], "group_name STRING, user_name STRING")
    people = spark.createDataFrame([("a", "France"), ("b", "Spain")], "email STRING, country STRING")
    for group, emails, n in (("admins", {"a", "b"}, 2), ("other", {"REDACTED"}, 1)):
        allowed = is_member(members, group)
        view = redact(people, ["email"], allowed)
        assert {r.email for r in view.collect()} == emails
        assert row_policy(view, allowed, "country = 'France'").count() == n


def test_row_policy_drops_rows_with_a_null_condition(spark):
    people = spark.createDataFrame([(None,), ("France",)], "country STRING")
    assert row_policy(people, F.lit(False), "country = 'France'").count() == 1
    assert row_policy(people, F.lit(True), "country = 'France'").count() == 2


def test_dynamic_view_in_sql(spark):
    """The same rule as a stored view, with the group looked up by a subquery."""
    me = spark.sql("SELECT current_user()").first()[0]
    spark.createDataFrame([("admins", me)], "group_name STRING, user_name STRING").createOrReplaceTempView("members")
    spark.createDataFrame([("a",)], "email STRING").createOrReplaceTempView("people")
    for group, want in (("admins", "a"), ("none", "REDACTED")):
        got = spark.sql(f"""
            SELECT CASE WHEN (SELECT count(*) > 0 FROM members WHERE group_name = '{group}'
                              AND user_name = current_user()) THEN email ELSE 'REDACTED' END AS email FROM people
        """).first()[0]
        assert got == want


def test_file_statistics_and_detail(spark, folder):
    df = spark.range(100).selectExpr("id", "IF(id < 10, NULL, id * 2) AS v", "struct(id AS x) AS s")
    df.repartitionByRange(4, "id").write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    stats = file_stats(table)
    assert stats.agg(F.sum("row_count"), F.min("id_min"), F.max("v_max"), F.sum("v_nulls"), F.max("s_x_max")).first() \
        == (100, 0, 198, 10, 99)
    assert "v_min" not in file_stats(table, max_columns=1).columns
    detail = table_detail(table).first()
    assert (detail.num_files, detail.num_rows, detail.num_columns) == (4, 100, 3)
    assert detail.size_in_bytes == stats.agg(F.sum("file_bytes")).first()[0]


def test_compaction_keeps_rows_and_reduces_files(spark, folder):
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, NULL, id % 3) AS p")
    df.repartition(10).write.partitionBy("p").parquet(f"{folder}/parts")
    before = files_of(spark.read.parquet(f"{folder}/parts")).count()
    packed = compact(spark, f"{folder}/parts", f"{folder}/packed", partition_by=["p"])
    assert files_of(packed).count() == 3 < before
    assert rows(packed.select("id", "p")) == rows(df)
    flat = compact(spark, f"{folder}/parts", f"{folder}/flat")
    assert files_of(flat).count() == 1 and rows(flat.select("id", "p")) == rows(df)


def test_a_large_partition_becomes_several_files(spark, folder):
    df = spark.range(20000).selectExpr("0 AS p", "7 AS same")
    df.repartition(4).write.partitionBy("p").parquet(f"{folder}/parts")
    size = files_of(spark.read.parquet(f"{folder}/parts")).agg(F.sum("file_bytes")).first()[0]
    packed = compact(spark, f"{folder}/parts", f"{folder}/out", target_bytes=size // 4, partition_by=["p"])
    assert packed.count() == 20000 and files_of(packed).count() >= 2


def test_every_compacted_file_has_a_task_that_sorts_nothing(spark, folder, monkeypatch):
    df = spark.range(3000).selectExpr("id", "id % 7 AS p")
    df.repartition(4).write.partitionBy("p").parquet(f"{folder}/parts")
    written = []
    monkeypatch.setattr(layout, "write_partitions", lambda out, path, columns: (written.append(out), write_partitions(out, path, columns)))
    packed = compact(spark, f"{folder}/parts", f"{folder}/out", partition_by=["p"])
    assert rows(packed.select("id", "p")) == rows(df)
    dealt = written[0].groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("p"))
    assert sorted(tuple(r) for r in dealt.collect()) == [(n, 1) for n in range(7)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_partition_report(spark, folder):
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{folder}/t")
    report = partition_report(spark.read.parquet(f"{folder}/t"), ["p"], min_bytes=1)
    assert rows(report.select("p", "row_count", "undersized")) == [(0, 5, False), (1, 5, False)]
    report = partition_report(spark.read.parquet(f"{folder}/t"), ["p"])
    assert report.where("undersized").count() == 2


def test_zorder_clusters_both_columns(spark, folder):
    df = spark.range(4096).selectExpr("id % 64 AS a", "id DIV 64 AS b", "cast(id AS STRING) AS name")
    df.repartition(4).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    zorder(table, ["a", "b"], files=16).write.parquet(f"{folder}/z")
    clustered = spark.read.parquet(f"{folder}/z")
    assert rows(clustered) == rows(df)
    touched = file_stats(clustered).where("a_min <= 3 AND a_max >= 0 AND b_min <= 3 AND b_max >= 0")
    assert touched.count() <= 4


def test_z_ranges_of_strings_with_a_common_prefix(spark):
    names = spark.range(1000).selectExpr("format_string('Customer#%09d', id) AS name").withColumn("other", F.lit("x"))
    z = with_z_value(names, ["name"], bits=6).select("name", "_z").collect()
    assert len({r["_z"] for r in z}) > 50
    ordered = [r["_z"] for r in sorted(z, key=lambda r: r["name"])]
    assert ordered == sorted(ordered)
    odd = spark.createDataFrame([(None,), ("",), ("a",), ("Z",)], "name STRING")
    assert with_z_value(odd, ["name"], bits=2).count() == 4
    assert zorder_bits(2, 16) == 6 and 2 * zorder_bits(2, 1_000_000) > 20 and zorder_bits(4, 10**9) * 4 <= 62


def test_zorder_spreads_one_common_value(spark, folder):
    spark.range(20000).selectExpr("1 AS a", "'x' AS b").repartition(4).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    zorder(table, ["a", "b"], files=4).write.parquet(f"{folder}/z")
    sizes = files_of(spark.read.parquet(f"{folder}/z"))
    assert sizes.count() == 4 and sizes.agg(F.max("row_count")).first()[0] < 8000


def test_z_value_orders_strings_dates_and_nulls(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, None)], "s STRING, n INT").selectExpr(
        "s", "n", "date_add(DATE'2024-01-01', n) AS d")
    z = with_z_value(with_z_value(df, ["s"], bits=2, name="zs"), ["d"], bits=2, name="zd")
    got = {r.s: (r.zs, r.zd) for r in z.collect()}
    assert got[None] == (0, 0) and got["a"][0] <= got["b"][0] < got["c"][0] and got["a"][1] <= got["c"][1]
    with pytest.raises(ValueError):
        with_z_value(df, ["s", "n"], bits=32)


def test_archive_before_delete(spark, folder):
    df = spark.createDataFrame([(1, 2020), (2, 2024), (3, None)], "id INT, year INT")
    kept = archive_partitions(df, "year < 2023", f"{folder}/archive")
    assert rows(kept) == [(2, 2024), (3, None)] and rows(spark.read.parquet(f"{folder}/archive")) == [(1, 2020)]


def test_partition_pruning_reaches_the_scan(spark, folder):
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{folder}/t")
    plan = spark.read.parquet(f"{folder}/t").where("p = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_lookup_is_broadcast_only_when_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df, lookup = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
        for limit, kind in ((1600, "BroadcastHashJoin"), (1199, "SortMergeJoin")):
            joined = lookup_join(df, lookup, ["k"], max_bytes=limit)
            assert kind in joined._jdf.queryExecution().toString() and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_values_are_not_broadcast(spark):
    """The bound is in bytes: a few rows with long or nested values are no small lookup."""
    few = spark.range(20).selectExpr("id AS k", "repeat('x', 100000) AS v")
    nested = spark.range(20).selectExpr("id AS k", "array_repeat('x', 100000) AS v")
    assert small(few.select("k"), 1000) and not small(few, 1_000_000) and not small(nested, 1_000_000)
    assert small(few, 3_000_000)


def test_salted_join_equals_the_plain_join(spark):
    many = spark.range(200).selectExpr("id", "IF(id % 3 = 0, 0, id % 7) AS k")
    few = spark.range(5).selectExpr("id AS k", "id * 10 AS v")
    assert rows(salted_join(many, few, ["k"], ["id"], 4).select("id", "k", "v")) == rows(
        many.join(few, ["k"]).select("id", "k", "v"))


def test_missed_rows(spark):
    lines = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "id INT, k STRING")
    result = spark.createDataFrame([(1, "a", 1)], "id INT, k STRING, v INT")
    static = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    assert rows(missed_rows(lines, result, static, ["id"], ["k"]).select("id", "k", "v")) == [(2, "b", 2)]


def test_item_sets(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (1, ["b"]), (2, []), (2, ["c"])], "k INT, items ARRAY<STRING>")
    assert rows(item_sets(df, ["k"], "items", "s")) == [(1, ["a", "b"]), (2, ["c"])]


def test_replaced_table_keeps_old_snapshots(spark, folder):
    first = replace_table(spark.range(3).toDF("id"), "replaced_t", folder)
    replace_table(spark.table("replaced_t").where("id > 0").selectExpr("id", "'x' AS more"), "replaced_t", folder)
    assert spark.table("replaced_t").columns == ["id", "more"] and spark.table("replaced_t").count() == 2
    assert spark.read.parquet(first).count() == 3
    with pytest.raises(Exception):
        replace_table(spark.table("replaced_t").selectExpr("raise_error('no') AS id"), "replaced_t", folder)
    assert spark.table("replaced_t").count() == 2
    spark.sql("INSERT INTO replaced_t VALUES (9, 'y')")
    assert spark.table("replaced_t").count() == 3
    spark.range(1).selectExpr("id", "'z' AS more").createOrReplaceTempView("only_z")
    spark.sql("INSERT OVERWRITE replaced_t TABLE only_z")
    assert rows(spark.table("replaced_t")) == [(0, "z")]
    assert snapshots(spark, folder, "id BIGINT").count() == 2
    spark.sql("DROP TABLE replaced_t")


def test_small_tables_are_readable():
    import pathlib

    assert pathlib.Path(SMALL).exists()
