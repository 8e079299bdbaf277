"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import key_counts, latest_per_key, lookup_join
from millrace.plans.inputs import Tables, cents, order_lines
from millrace.queries.registry import query

# -- projections and filters ------------------------------------------------------


@query("F1 F5 F13 X17", """
    SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal + 1 AS balance_plus_one,
           'active' AS status
    FROM customer
""")
def projected_customers(t: Tables) -> DataFrame:
    return (
        t.customer.withColumn("balance_plus_one", F.col("c_acctbal") + 1)
        .withColumn("status", F.lit("active"))
        .withColumnRenamed("c_custkey", "customer_id")
        .withColumnRenamed("c_name", "name")
        .drop("c_acctbal", "c_mktsegment")
    )


@query("F6 F10", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice > 100000 AND o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '1996-01-01'
      AND o_orderpriority IS NOT NULL AND o_orderpriority = '1-URGENT'
""")
def urgent_open_orders(t: Tables) -> DataFrame:
    return t.orders.where(
        "o_totalprice > 100000 AND o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00' "
        "AND o_orderpriority IS NOT NULL AND o_orderpriority = '1-URGENT'"
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@query("F7", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt'")
def parts_by_name_pattern(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("red%") | F.col("p_name").like("%bolt")).select(
        "p_partkey", "p_name"
    )


@query("F8", """
    SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('signup', 'click')
""")
def events_of_types(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type").isin(["signup", "click"])).select(
        "event_id", "user_id", "event_type"
    )


@query("F9 J7", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
""")
def customers_with_large_orders(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(large, ["c_custkey"], "left_semi").select("c_custkey", "c_name")


@query("J7", """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def customers_without_urgent_orders(t: Tables) -> DataFrame:
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(urgent, ["c_custkey"], "left_anti").select("c_custkey", "c_name")


@query("F11", """
    SELECT p_partkey,
           CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_class
    FROM part
    WHERE CASE WHEN p_type = 'PROMO' THEN p_size > 5 ELSE TRUE END
""")
def size_classes(t: Tables) -> DataFrame:
    size = F.col("p_size")
    kind = F.when(size <= 10, "small").when(size <= 30, "medium").otherwise("large")
    kept = F.when(F.col("p_type") == "PROMO", size > 5).otherwise(F.lit(True))
    return t.part.where(kept).select("p_partkey", kind.alias("size_class"))


@query("F12 X14", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(trunc(l_extendedprice * 0.8) AS INTEGER) AS discounted,
           CAST(l_orderkey AS VARCHAR) AS order_text,
           CAST(l_shipdate AS DATE) + 30 AS due
    FROM lineitem
""")
def casted_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice") * 0.8).cast("int").alias("discounted"),
        F.col("l_orderkey").cast("string").alias("order_text"),
        F.date_add("l_shipdate", 30).alias("due"),
    )


@query("F14", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_status_priority(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("F15", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_order_lines(t: Tables) -> DataFrame:
    return t.lineitem.dropDuplicates(["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


# -- joins ------------------------------------------------------------------------


@query("J2", """
    SELECT c_custkey, c_name, n_name AS country, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def customers_with_country(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
    return lookup_join(t.customer, places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )


@query("J6", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_retailprice
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_extendedprice <> p_retailprice * l_quantity AND l_quantity > p_size
""")
def lines_off_list_price(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "inner")
        .where("l_extendedprice <> p_retailprice * l_quantity AND l_quantity > p_size")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "p_retailprice")
    )


# -- aggregates and pivot ---------------------------------------------------------


@query("A1", "SELECT count(*) AS row_count FROM lineitem")
def count_lines(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("row_count"))


@query("A2", "SELECT p_brand AS author, count(p_partkey) AS total_books FROM part GROUP BY p_brand")
def author_counts(t: Tables) -> DataFrame:
    return t.part.groupBy(F.col("p_brand").alias("author")).agg(F.count("p_partkey").alias("total_books"))


COUNTRY_DAILY_SQL = """
    WITH sold AS (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS quantity FROM lineitem GROUP BY 1)
    SELECT n_name AS country, date_trunc('day', o_orderdate) AS order_date,
           count(o_orderkey) AS orders_count, CAST(sum(quantity) AS BIGINT) AS books_count
    FROM orders JOIN sold ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2
"""


@query("A3 X10 J1 J2 K7", COUNTRY_DAILY_SQL)
def country_daily_sales(t: Tables) -> DataFrame:
    """Orders and books per country and day.

    Lines are added up per order and orders per customer and day before each join, so
    a hot order or customer reaches the join as a few rows, and only the small nation
    table is broadcast.
    """
    sold = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    daily = (
        t.orders.join(sold, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
        .groupBy("o_custkey", F.date_trunc("day", "o_orderdate").alias("order_date"))
        .agg(F.count("o_orderkey").alias("n"), F.sum("quantity").alias("q"))
    )
    customers = t.customer.select("c_custkey", "c_nationkey")
    rows = daily.join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return (
        lookup_join(rows, t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), F.col("order_date").cast("timestamp_ntz").alias("order_date"))
        .agg(F.sum("n").alias("orders_count"), F.sum("q").alias("books_count"))
    )


@query("A4", """
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
           time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
           event_type, count(event_id) AS events, avg(user_id) AS avg_user
    FROM events GROUP BY 1, 2, 3
""")
def event_windows(t: Tables) -> DataFrame:
    return (
        t.events.groupBy(F.window("ts", "5 minutes").alias("w"), "event_type")
        .agg(F.count("event_id").alias("events"), F.avg("user_id").alias("avg_user"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "event_type", "events", "avg_user",
        )
    )


@query("A7", """
    SELECT o_custkey,
           CAST(sum(n) FILTER (WHERE p = '1-URGENT') AS BIGINT) AS "1-URGENT",
           CAST(sum(n) FILTER (WHERE p = '2-HIGH') AS BIGINT) AS "2-HIGH",
           CAST(sum(n) FILTER (WHERE p = '3-MEDIUM') AS BIGINT) AS "3-MEDIUM",
           CAST(sum(n) FILTER (WHERE p = '4-LATER') AS BIGINT) AS "4-LATER"
    FROM (SELECT o_custkey, o_orderpriority AS p, CAST(round(o_totalprice * 100) AS BIGINT) AS n FROM orders)
    GROUP BY o_custkey
""")
def priority_pivot(t: Tables) -> DataFrame:
    """Sums per customer and priority; a listed value that does not occur gives NULLs."""
    listed = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-LATER"]
    rows = t.orders.select("o_custkey", "o_orderpriority", cents("o_totalprice").alias("n"))
    return rows.groupBy("o_custkey").pivot("o_orderpriority", listed).agg(F.sum("n"))


@query("A7", """
    SELECT l_suppkey,
           CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS A,
           CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS N,
           CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS R
    FROM lineitem GROUP BY l_suppkey
""")
def returnflag_pivot_sql(t: Tables) -> DataFrame:
    t.lineitem.createOrReplaceTempView("millrace_lines")
    return t.spark.sql("""
        SELECT * FROM (SELECT l_suppkey, l_returnflag, l_quantity FROM millrace_lines)
        PIVOT (sum(l_quantity) FOR l_returnflag IN ('A', 'N', 'R'))
    """)


@query("A8 Q8", """
    SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS key_count FROM lineitem
""")
def line_key_counts(t: Tables) -> DataFrame:
    return key_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


# -- windows, sorts, limits -------------------------------------------------------


@query("N1 D15", """
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS place FROM events
        WHERE event_type IN ('signup', 'click', 'view', 'purchase')
    ) WHERE place = 1
""")
def newest_change_per_user(t: Tables) -> DataFrame:
    kept = t.events.where(F.col("event_type").isin("signup", "click", "view", "purchase"))
    return latest_per_key(kept, ["user_id"], [F.col("ts").desc()]).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )


@query("N1", """
    SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM (
        SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) AS place FROM lineitem
    ) WHERE place = 1
""")
def newest_sales_with_ties(t: Tables) -> DataFrame:
    """``rank`` keeps every sale of the newest day of a part."""
    return latest_per_key(t.lineitem, ["l_partkey"], [F.col("l_shipdate").desc()]).select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@query("T1", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def customers_by_balance(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey")


@query("T1 T2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def largest_orders(t: Tables) -> DataFrame:
    """Top 20: each task keeps its own 20 rows, so the sort is never global."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


# -- set operations ---------------------------------------------------------------


@query("U1", """
    SELECT o_custkey AS key, o_orderstatus AS flag FROM orders
    UNION SELECT l_suppkey, l_linestatus FROM lineitem
""")
def set_union(t: Tables) -> DataFrame:
    left = t.orders.select(F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("flag"))
    return left.union(t.lineitem.select("l_suppkey", "l_linestatus")).distinct()


@query("U2", """
    SELECT c_custkey AS key, c_name AS name, 'customer' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier
""")
def set_union_all(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("kind")
    )
    suppliers = t.supplier.select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)


@query("U3", """
    SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'P'
    INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def set_intersect(t: Tables) -> DataFrame:
    key = F.col("o_custkey").alias("key")
    return t.orders.where("o_orderstatus = 'P'").select(key).intersect(
        t.orders.where("o_orderpriority = '1-URGENT'").select(key)
    )


@query("U4", """
    SELECT c_custkey AS key FROM customer
    EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000
""")
def set_minus(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("key")).subtract(
        t.orders.where("o_totalprice > 300000").select("o_custkey")
    )


@query("U1 U4", """
    WITH lines AS (
        SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2
    ), docs AS (
        SELECT l_orderkey AS order_id, list_sort(list(p)) AS books FROM lines GROUP BY 1
    )
    SELECT order_id, books FROM docs
    EXCEPT SELECT order_id, books FROM docs WHERE len(books) > 2
""")
def set_minus_with_arrays(t: Tables) -> DataFrame:
    """Set difference of rows holding arrays (an order has at most one entry per line number)."""
    docs = order_lines(t).groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.array_sort(F.collect_list("book_key")).alias("books")
    )
    return docs.subtract(docs.where(F.size("books") > 2))
