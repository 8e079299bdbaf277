"""Quality rules, access-dependent views and file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import is_member, redact, row_policy
from millrace.operators import (
    Check, add_check, archive_partitions, compact, drop_check, enforce, file_stats,
    key_counts, not_null, partition_report, split_valid, violations, zorder,
)
from millrace.operators.layout import write_partitions
from millrace.plans.inputs import Tables, cents
from millrace.queries.registry import query
from millrace.session import new_folder

# -- quality ----------------------------------------------------------------------

CHECKS = {
    "enough": Check("enough", "l_quantity > 5"),
    "on_time": Check("on_time", "l_shipdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00'"),
    "discount_ok": Check("discount_ok", "l_discount <= 0.09"),
}
LINE = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_shipdate"


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(*LINE.split(", "))


@query("Q7", f"""
    SELECT {LINE}, list_filter([
        CASE WHEN l_quantity <= 5 THEN 'enough' END,
        CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN 'on_time' END,
        CASE WHEN l_discount > 0.09 THEN 'discount_ok' END], lambda x: x IS NOT NULL) AS failed_checks
    FROM lineitem
    WHERE l_quantity <= 5 OR l_shipdate < TIMESTAMP '1996-01-01' OR l_discount > 0.09
""")
def quarantined_lines(t: Tables) -> DataFrame:
    return split_valid(_lines(t), CHECKS)[1]


@query("Q7 Q3", f"""
    SELECT {LINE} FROM lineitem
    WHERE l_quantity > 5 AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_discount <= 0.09
""")
def valid_lines(t: Tables) -> DataFrame:
    """The good rows, written under the same constraints they were chosen by."""
    good, _ = split_valid(_lines(t), CHECKS)
    folder = new_folder(t.spark, "valid-lines")
    enforce(good, CHECKS).write.parquet(folder)
    return t.spark.read.parquet(folder)


@query("Q5", "SELECT doc_id, quality, toxic FROM labels WHERE quality <= 0")
def rule_violators(t: Tables) -> DataFrame:
    return violations(t.labels, Check("useful", "quality > 0"))


@query("Q1 Q2 Q4", """
    SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1
""")
def constrained_orders(t: Tables) -> DataFrame:
    """Constraints added after a check of the present rows, one dropped, the rest enforced."""
    checks = add_check(t.orders, {}, not_null("o_orderkey"))
    checks = add_check(t.orders, checks, Check("positive", "o_totalprice > 0"))
    checks = add_check(t.orders, checks, Check("dated", "o_orderdate >= TIMESTAMP_NTZ '1990-01-01 00:00:00'"))
    checks = drop_check(checks, "positive")
    return enforce(t.orders, checks).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("Q2 Q5", """
    SELECT 'enough' AS rule, CAST(count(*) FILTER (WHERE l_quantity <= 5) AS BIGINT) AS violators FROM lineitem
    UNION ALL SELECT 'on_time', count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01') FROM lineitem
    UNION ALL SELECT 'discount_ok', count(*) FILTER (WHERE l_discount > 0.09) FROM lineitem
""")
def violation_counts(t: Tables) -> DataFrame:
    """All rules counted in one pass over the table."""
    counts = t.lineitem.agg(*[F.count_if(c.violated()).alias(n) for n, c in CHECKS.items()])
    return counts.unpivot([], list(CHECKS), "rule", "violators")


@query("Q8 A8", "SELECT count(*) AS row_count, count(DISTINCT event_id) AS key_count FROM events")
def unique_events(t: Tables) -> DataFrame:
    return key_counts(t.events, ["event_id"])


# -- access -----------------------------------------------------------------------

MEMBERS_SQL = "members AS (SELECT n_name AS group_name, s_name AS user_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"


def _members(t: Tables) -> DataFrame:
    """Every supplier is a user who belongs to the group of their nation."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
    return rows.select(F.col("n_name").alias("group_name"), F.col("s_name").alias("user_name"))


def _customer_view(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return rows.select("c_custkey", "c_name", F.col("n_name").alias("country"), "c_mktsegment", "c_acctbal")


USER = "Supplier#000000001"
CUSTOMERS_SQL = """
    view_rows AS (SELECT c_custkey, c_name, n_name AS country, c_mktsegment, c_acctbal
                  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""
ALLOWED_SQL = "(SELECT count(*) > 0 FROM members WHERE group_name = {group} AND user_name = '" + USER + "')"
OWN_GROUP_SQL = f"(SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_name = '{USER}')"


def _policy_sql(group: str) -> str:
    return f"""
        WITH {MEMBERS_SQL}, {CUSTOMERS_SQL}, a AS (SELECT {ALLOWED_SQL.format(group=group)} AS ok)
        SELECT c_custkey, CASE WHEN ok THEN c_name ELSE 'REDACTED' END AS c_name, country,
               CASE WHEN ok THEN c_mktsegment ELSE 'REDACTED' END AS c_mktsegment, c_acctbal
        FROM view_rows, a WHERE CASE WHEN ok THEN TRUE ELSE country = 'NATION_7' AND c_acctbal > 0 END
    """


def _policy(t: Tables, group: str) -> DataFrame:
    allowed = is_member(_members(t), group, F.lit(USER))
    redacted = redact(_customer_view(t), ["c_name", "c_mktsegment"], allowed)
    return row_policy(redacted, allowed, "country = 'NATION_7' AND c_acctbal > 0")


@query("G1 G4", f"""
    WITH {MEMBERS_SQL}, {CUSTOMERS_SQL}
    SELECT c_custkey, 'REDACTED' AS c_name, country, 'REDACTED' AS c_mktsegment, c_acctbal FROM view_rows
""")
def redacted_customers(t: Tables) -> DataFrame:
    """The view of the session's own user, who is in none of the groups."""
    allowed = is_member(_members(t), "NATION_1")
    return redact(_customer_view(t), ["c_name", "c_mktsegment"], allowed)


@query("G2", f"WITH {CUSTOMERS_SQL} SELECT * FROM view_rows WHERE country = 'NATION_7' AND c_acctbal > 0")
def filtered_customers(t: Tables) -> DataFrame:
    allowed = is_member(_members(t), "NATION_1")
    return row_policy(_customer_view(t), allowed, "country = 'NATION_7' AND c_acctbal > 0")


@query("G1 G2 G3 G4 X18", _policy_sql(OWN_GROUP_SQL))
def policy_for_one_group(t: Tables) -> DataFrame:
    """Row policy on top of the redacted view, for the group that the member table gives the user."""
    own = _members(t).where(F.col("user_name") == USER).first()["group_name"]
    return _policy(t, own)


@query("G1 G2 G3 G4", _policy_sql("'no such group'"))
def policy_for_other_group(t: Tables) -> DataFrame:
    return _policy(t, "no such group")


# -- layout -----------------------------------------------------------------------

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)
STATS_SQL = ", ".join(
    f"min({c}) AS {c}_min, max({c}) AS {c}_max, CAST(count(*) - count({c}) AS BIGINT) AS {c}_nulls"
    for c in LINE_COLUMNS
)


@query("A9 L6", f"SELECT count(*) AS row_count, {STATS_SQL} FROM lineitem")
def file_statistics(t: Tables) -> DataFrame:
    """Statistics per file, combined over the files so that the layout does not matter."""
    columns = list(LINE_COLUMNS)
    stats = file_stats(t.lineitem, max_columns=len(columns))
    merged = [F.sum("row_count").alias("row_count")]
    for c in columns:
        merged += [
            F.min(f"{c}_min").alias(f"{c}_min"), F.max(f"{c}_max").alias(f"{c}_max"),
            F.sum(f"{c}_nulls").alias(f"{c}_nulls"),
        ]
    return stats.agg(*merged)


@query("L3", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS row_count FROM orders GROUP BY 1, 2
""")
def partition_sizes(t: Tables) -> DataFrame:
    """Report on a table partitioned by two columns; bytes and files depend on the layout."""
    folder = new_folder(t.spark, "orders-parts")
    t.orders.write.partitionBy("o_orderstatus", "o_orderpriority").parquet(folder)
    report = partition_report(t.spark.read.parquet(folder), ["o_orderstatus", "o_orderpriority"])
    return report.where("undersized AND byte_count > 0 AND file_count > 0").select(
        "o_orderstatus", "o_orderpriority", "row_count"
    )


LINE_COPY = ", ".join(LINE_COLUMNS)


@query("L4", f"SELECT {LINE_COPY} FROM lineitem")
def compacted(t: Tables) -> DataFrame:
    """Many small files rewritten into few."""
    scattered, packed = new_folder(t.spark, "scattered"), new_folder(t.spark, "packed")
    t.lineitem.select(*LINE_COPY.split(", ")).repartition(24).write.parquet(scattered)
    return compact(t.spark, scattered, packed)


@query("L4 L1", """
    SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM lineitem GROUP BY 1
""")
def compacted_partitions(t: Tables) -> DataFrame:
    scattered, packed = new_folder(t.spark, "scattered"), new_folder(t.spark, "packed")
    write_partitions(t.lineitem.repartition(16), scattered, ["l_returnflag"])
    rows = compact(t.spark, scattered, packed, partition_by=["l_returnflag"])
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("l_extendedprice")).alias("cents")
    )


@query("L5", f"SELECT {LINE_COPY} FROM lineitem")
def zordered(t: Tables) -> DataFrame:
    """Lines clustered by part, supplier and ship date at once."""
    folder = new_folder(t.spark, "zordered")
    rows = t.lineitem.select(*LINE_COPY.split(", "))
    zorder(rows, ["l_partkey", "l_suppkey", "l_shipdate"], files=16).write.parquet(folder)
    return t.spark.read.parquet(folder)


@query("L5 L6", f"""
    SELECT {LINE_COPY} FROM lineitem WHERE l_partkey BETWEEN 100 AND 120 AND l_suppkey < 10
""")
def skipping_scan(t: Tables) -> DataFrame:
    """A range filter on the clustered columns; the scan skips files by their statistics."""
    folder = new_folder(t.spark, "zordered")
    rows = t.lineitem.select(*LINE_COPY.split(", "))
    zorder(rows, ["l_partkey", "l_suppkey"], files=16).write.parquet(folder)
    return t.spark.read.parquet(folder).where("l_partkey BETWEEN 100 AND 120 AND l_suppkey < 10")


@query("L7 D3 L1 L2", """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year,
           CASE WHEN year(o_orderdate) < 1998 THEN 'archive' ELSE 'table' END AS place
    FROM orders
""")
def archived_years(t: Tables) -> DataFrame:
    """Old partitions copied elsewhere and deleted; what remains and the archive, side by side."""
    folder, archive = new_folder(t.spark, "orders-years"), new_folder(t.spark, "archive")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    rows.write.partitionBy("order_year").parquet(folder)
    kept = archive_partitions(t.spark.read.parquet(folder), "order_year < 1998", archive)
    return kept.withColumn("place", F.lit("table")).unionByName(
        t.spark.read.parquet(archive).withColumn("place", F.lit("archive"))
    )
