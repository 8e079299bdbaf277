"""Row-level updates, deletes and merges.

Where a merge needs a target and a source, customers with a debt stand for rows the
target has in an older form, and the whole customer table is the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scd import scd2_splice
from millrace.operators import (
    Insert, Update, apply_cdc, current_rows, delete_matching, delete_rows, insert_new, latest_per_key,
    merge_rows, newest_wins, scd2_apply, update_rows,
)
from millrace.plans.inputs import Tables, book_updates, books, customer_email, row_status
from millrace.plans.medallion import delete_requests
from millrace.queries.registry import query
from millrace.session import new_folder


@query("D1", """
    SELECT c_custkey, c_name, CASE WHEN c_name LIKE '%7' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
    FROM customer
""")
def updated_rows(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return update_rows(rows, {"c_acctbal": "c_acctbal + 1"}, "c_name LIKE '%7'")


@query("D2", "SELECT count(*) AS before, 0 AS after FROM supplier")
def deleted_all(t: Tables) -> DataFrame:
    before = t.supplier.agg(F.count(F.lit(1)).alias("before"))
    after = delete_rows(t.supplier, F.lit(True)).agg(F.count(F.lit(1)).cast("int").alias("after"))
    return before.withColumn("after", after.scalar())


@query("D3", "SELECT o_orderkey, o_orderdate FROM orders WHERE NOT (year(o_orderdate) < 1998)")
def deleted_range(t: Tables) -> DataFrame:
    return delete_rows(t.orders.select("o_orderkey", "o_orderdate"), "year(o_orderdate) < 1998")


@query("D4 J7", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def deleted_by_subquery(t: Tables) -> DataFrame:
    doomed = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return delete_matching(t.orders.select("o_orderkey", "o_custkey"), doomed, ["o_custkey"])


@query("D5", """
    SELECT c_custkey, lower(c_name) || '@' || lower(c_mktsegment) || '.com' AS email,
           CASE WHEN c_acctbal < 5000 AND c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'target'
                ELSE 'source' END AS updated
    FROM customer
""")
def merge_fill_missing(t: Tables) -> DataFrame:
    """Missing e-mails are filled, present ones kept, unknown customers inserted."""
    email = customer_email(F.col("c_name"), F.col("c_mktsegment"))
    source = t.customer.select("c_custkey", email.alias("email"), F.lit("source").alias("updated"))
    known = t.customer.where("c_acctbal < 5000").select(
        "c_custkey",
        F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), email).alias("email"),
        F.lit("target").alias("updated"),
    )
    return merge_rows(
        known, source, ["c_custkey"],
        matched=[
            Update({"email": "s.email", "updated": "s.updated"}, when="t.email IS NULL AND s.email IS NOT NULL")
        ],
        not_matched=[Insert()],
        check_source=True,
    )


@query("D6", """
    SELECT p_partkey, p_name, p_type, p_retailprice FROM part WHERE p_size <= 25
    UNION ALL
    SELECT p_partkey, p_name, p_type, p_retailprice + 1 FROM part WHERE p_size > 25 AND p_type = 'PROMO'
""")
def merge_insert_condition(t: Tables) -> DataFrame:
    """Insert-only merge on two keys, taking new rows of one kind only."""
    target = t.part.where("p_size <= 25").select("p_partkey", "p_name", "p_type", "p_retailprice")
    source = t.part.select("p_partkey", "p_name", "p_type", (F.col("p_retailprice") + 1).alias("p_retailprice"))
    return merge_rows(
        target, source, ["p_partkey", "p_name"], not_matched=[Insert(when="s.p_type = 'PROMO'")]
    )


@query("D7 J7", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def inserted_new_rows(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return insert_new(rows.where("o_totalprice > 200000"), rows, ["o_orderkey", "o_orderdate"])


CHANGES = """
    changes AS (
        SELECT user_id, event_id, ts AS row_time, value,
               CASE WHEN event_type = 'error' AND value > 150 THEN 'delete'
                    WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS row_status
        FROM events
    )
"""


def _changes(t: Tables) -> DataFrame:
    return t.events.select(
        "user_id", "event_id", F.col("ts").alias("row_time"), "value", row_status().alias("row_status")
    )


def _early_customers(t: Tables) -> DataFrame:
    early = _changes(t).where("row_time < TIMESTAMP_NTZ '2024-01-16 00:00:00' AND row_status <> 'delete'")
    newest = latest_per_key(early, ["user_id"], [F.col("row_time").desc()])
    return newest.select("user_id", "event_id", "row_time", "value")


@query("D8 D15 N2", f"""
    WITH {CHANGES}
    SELECT user_id, event_id, row_time, value FROM (
        SELECT *, rank() OVER (PARTITION BY user_id ORDER BY row_time DESC) AS place
        FROM changes WHERE row_status <> 'delete'
    ) WHERE place = 1
""")
def merge_newest_wins(t: Tables) -> DataFrame:
    """Type 1 upsert of the newest insert or update per user into an earlier state."""
    kept = _changes(t).where(F.col("row_status").isin("insert", "update"))
    newest = latest_per_key(kept, ["user_id"], [F.col("row_time").desc()])
    return merge_rows(_early_customers(t), newest, ["user_id"], **newest_wins("row_time"))


@query("D9 D11 D15", f"""
    WITH {CHANGES}
    SELECT user_id, event_id, row_time, value FROM (
        SELECT *, rank() OVER (PARTITION BY user_id ORDER BY row_time DESC) AS place FROM changes
    ) WHERE place = 1 AND row_status <> 'delete'
""")
def merge_with_delete(t: Tables) -> DataFrame:
    """The newest change per user applied, including deletes."""
    return apply_cdc(_early_customers(t), _changes(t), ["user_id"], "row_time", "row_status")


@query("D10", """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'blocked'
                ELSE o_orderstatus END AS status
    FROM orders
""")
def merge_update_only(t: Tables) -> DataFrame:
    """Several target rows per merge key, each changed by one source row."""
    target = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    source = t.customer.where("c_acctbal < 0").select(F.col("c_custkey"))
    return merge_rows(
        target, source, {"o_custkey": "c_custkey"}, matched=[Update({"status": "'blocked'"})],
    )


SCD2_SQL = """
    WITH sold AS (
        SELECT l_partkey, max(l_extendedprice) AS price, max(l_shipdate) AS updated FROM lineitem GROUP BY 1
    ), old AS (
        SELECT p_partkey, p_name, p_brand, p_retailprice, price, updated,
               l_partkey IS NOT NULL AS is_sold,
               l_partkey IS NOT NULL AND price <> p_retailprice AS changed
        FROM part LEFT JOIN sold ON p_partkey = l_partkey
    ), history AS (
        SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title, p_brand AS author, p_retailprice AS price,
               NOT changed AS current, TIMESTAMP '1990-01-01' AS effective_date,
               CASE WHEN changed THEN updated END AS end_date
        FROM old WHERE p_brand <> 'Brand#1'
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand, price, TRUE, updated, NULL
        FROM old WHERE is_sold AND (p_brand = 'Brand#1' OR changed)
    )
"""


def _book_history(t: Tables) -> DataFrame:
    """Books of all brands but one, open since 1990, then a new price for every book sold."""
    known = books(t).where("author <> 'Brand#1'")
    start = known.select(
        "book_id", "title", "author", "price", F.lit(True).alias("current"),
        F.col("updated").alias("effective_date"), F.lit(None).cast("timestamp").alias("end_date"),
    )
    return scd2_apply(start, book_updates(t), "book_id", ["price"], "updated")


@query("D12", f"{SCD2_SQL} SELECT * FROM history")
def scd2_books(t: Tables) -> DataFrame:
    history = _book_history(t)
    return history.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("effective_date", "end_date")}
    )


CHAINED_SQL = """
    WITH daily AS (
        SELECT l_partkey, l_shipdate AS moment, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2
    ), points AS (
        SELECT p_partkey AS k, TIMESTAMP '1990-01-01' AS moment, p_retailprice AS price FROM part
        UNION ALL SELECT l_partkey, moment, price FROM daily WHERE day(moment) % 2 = 0
    ), first AS (
        SELECT k, moment, price FROM (SELECT *, lag(price) OVER w AS old, row_number() OVER w AS i FROM points WINDOW w AS (PARTITION BY k ORDER BY moment))
        WHERE i = 1 OR price <> old
    ), more AS (
        SELECT * FROM first UNION ALL SELECT l_partkey, moment, price FROM daily WHERE day(moment) % 2 = 1
    ), kept AS (
        SELECT k, moment, price FROM (SELECT *, lag(price) OVER w AS old, row_number() OVER w AS i FROM more WINDOW w AS (PARTITION BY k ORDER BY moment))
        WHERE i = 1 OR price <> old
    )
    SELECT CAST(k AS VARCHAR) AS book_id, price, lead(moment) OVER w IS NULL AS current, moment AS effective_date, lead(moment) OVER w AS end_date
    FROM kept WINDOW w AS (PARTITION BY k ORDER BY moment)
"""


@query("D12 K4", CHAINED_SQL)
def scd2_chained(t: Tables) -> DataFrame:
    """Every day's highest price of a part is a change; those of odd days come in a second call, between the others."""
    start = t.part.select(
        F.col("p_partkey").cast("string").alias("book_id"), F.col("p_retailprice").alias("price"), F.lit(True).alias("current"),
        F.lit("1990-01-01").cast("timestamp").alias("effective_date"), F.lit(None).cast("timestamp").alias("end_date"))
    daily = t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("book_id"), F.col("l_shipdate").cast("timestamp").alias("updated")).agg(
        F.max("l_extendedprice").alias("price"))
    history = start
    for late in (False, True):
        changes = daily.where((F.dayofmonth("updated") % 2 == 1) == F.lit(late))
        history = scd2_splice(history, changes, "book_id", ["price"], "updated")
    return history.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("effective_date", "end_date")})


@query("D14", f"{SCD2_SQL} SELECT book_id, title, author, price FROM history WHERE current")
def current_books(t: Tables) -> DataFrame:
    return current_rows(_book_history(t))


@query("D13 W7", "SELECT s_suppkey, s_name FROM supplier")
def static_lookup(t: Tables) -> DataFrame:
    """A type 0 dimension: appended once, never changed."""
    folder = new_folder(t.spark, "type0")
    t.supplier.select("s_suppkey", "s_name").write.mode("append").parquet(folder)
    return t.spark.read.parquet(folder)


@query("D21 X14", """
    SELECT CAST(user_id AS VARCHAR) AS customer_id, ts AS request_timestamp,
           CAST(ts AS DATE) + 30 AS deadline, 'requested' AS status
    FROM events WHERE event_type = 'error' AND value > 150
""")
def delete_requests_batch(t: Tables) -> DataFrame:
    feed = t.events.select(
        F.col("user_id").cast("string").alias("customer_id"), F.col("ts").cast("timestamp").alias("row_time"),
        row_status().alias("row_status"),
    )
    return delete_requests(feed).withColumn("request_timestamp", F.col("request_timestamp").cast("timestamp_ntz"))
