"""JSON text, structs, arrays, higher-order functions and SQL functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import domain_part, json_path
from millrace.operators import item_sets, lookup_join
from millrace.plans.inputs import Tables, cents, customer_profiles, order_documents
from millrace.functions.text import whole_schema
from millrace.queries.registry import query

# Orders with their lines: copies of a line number are added up under the lowest part.
DOCS = """
    lines AS (
        SELECT l_orderkey, l_linenumber, CAST(min(l_partkey) AS VARCHAR) AS book_id,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS subtotal
        FROM lineitem GROUP BY 1, 2
    ), docs AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_timestamp,
               CAST(o_custkey AS VARCHAR) AS customer_id, l_linenumber, book_id, quantity, subtotal
        FROM orders JOIN lines ON o_orderkey = l_orderkey
    )
"""

PROFILES = """
    profiles AS (
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name, c_mktsegment, n_name, c_nationkey,
               lower(c_name) || '@' || lower(c_mktsegment) || '.com' AS email
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    )
"""

SAMPLE_PROFILE = '{"first_name": "a", "last_name": "b", "address": {"country": "c", "code": 1}}'


@query("X1", """
    SELECT event_id, json_extract_string(props, '$.k') AS k FROM events
""")
def json_path_props(t: Tables) -> DataFrame:
    return t.events.select("event_id", json_path("props", "k").alias("k"))


@query("X1", f"""
    WITH {PROFILES} SELECT customer_id, c_name AS first_name, n_name AS country FROM profiles
""")
def json_path_profile(t: Tables) -> DataFrame:
    return customer_profiles(t).select(
        "customer_id",
        json_path("profile", "first_name").alias("first_name"),
        json_path("profile", "address.country").alias("country"),
    )


@query("X1", f"""
    WITH {PROFILES} SELECT customer_id, n_name AS country, c_nationkey AS code FROM profiles
""")
def variant_path_profile(t: Tables) -> DataFrame:
    """The same paths with the colon syntax, which works on VARIANT values."""
    rows = customer_profiles(t).select("customer_id", F.parse_json("profile").alias("profile"))
    return rows.selectExpr(
        "customer_id", "profile:address.country::string AS country", "profile:address.code::int AS code"
    )


@query("X2 X3 F2 F3", f"""
    WITH {PROFILES}
    SELECT customer_id, c_name AS first_name, c_mktsegment AS last_name, n_name AS country,
           CAST(c_nationkey AS BIGINT) AS code
    FROM profiles
""")
def json_struct_flatten(t: Tables) -> DataFrame:
    """Parse by a schema taken from a sample, then spread the struct and its sub-struct."""
    parsed = customer_profiles(t).select(
        "customer_id", F.from_json("profile", F.schema_of_json(SAMPLE_PROFILE)).alias("p")
    )
    return parsed.select("customer_id", "p.*", "p.address.*").drop("address")


@query("F2", f"WITH {PROFILES} SELECT customer_id, n_name AS country FROM profiles")
def nested_field(t: Tables) -> DataFrame:
    parsed = customer_profiles(t).select(
        "customer_id", F.from_json("profile", "address STRUCT<country: STRING>").alias("p")
    )
    return parsed.select("customer_id", "p.address.country")


@query("X4 F4 J1", f"""
    WITH {DOCS}
    SELECT order_id, customer_id, book_id, d.quantity, subtotal, p_name AS title, p_brand AS author
    FROM docs d JOIN part ON book_id = CAST(p_partkey AS VARCHAR)
""")
def explode_order_lines(t: Tables) -> DataFrame:
    """One row per book of an order, with the book's own columns."""
    lines = order_documents(t).select("order_id", "customer_id", F.explode("books").alias("book"))
    books = t.part.select(
        F.col("p_partkey").cast("string").alias("part_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
    )
    return lines.join(books, F.col("book.book_id") == F.col("part_id"), "inner").select(
        "order_id", "customer_id", "book.book_id", "book.quantity", "book.subtotal", "title", "author"
    )


@query("F4 X8", f"""
    WITH {DOCS}
    SELECT order_id, list_sort(list(DISTINCT book_id)) AS book_ids, count(*) AS n_lines,
           CAST(sum(quantity) AS BIGINT) AS quantity
    FROM docs GROUP BY order_id
""")
def book_ids_of_orders(t: Tables) -> DataFrame:
    return order_documents(t).select(
        "order_id",
        F.array_sort(F.array_distinct("books.book_id")).alias("book_ids"),
        F.size("books").cast("bigint").alias("n_lines"),
        "quantity",
    )


@query("A5", """
    SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS statuses,
           list_sort(list(DISTINCT o_orderpriority)) AS priorities
    FROM orders GROUP BY o_custkey
""")
def customer_sets(t: Tables) -> DataFrame:
    """Sets of values from small domains; each task sends at most one copy per customer."""
    return t.orders.groupBy("o_custkey").agg(
        F.array_sort(F.collect_set("o_orderstatus")).alias("statuses"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"),
    )


@query("A5 A6 X8", """
    SELECT c_mktsegment, list_sort(list(DISTINCT p_brand)) AS authors
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    GROUP BY c_mktsegment
""")
def author_sets(t: Tables) -> DataFrame:
    """Authors bought per customer segment, from arrays of authors per order."""
    lines = lookup_join(
        t.lineitem.select("l_orderkey", "l_partkey"), t.part.select("p_partkey", "p_brand"),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    authors = lines.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("authors"))
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select("c_custkey", "c_mktsegment")
    rows = authors.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner").join(
        customers, F.col("o_custkey") == F.col("c_custkey"), "inner"
    )
    return item_sets(rows, ["c_mktsegment"], "authors", "authors")


@query("A6 X8", """
    SELECT l_suppkey, list_sort(list(DISTINCT l_returnflag)) AS flags
    FROM lineitem GROUP BY l_suppkey
""")
def flattened_flag_sets(t: Tables) -> DataFrame:
    """``array_distinct(flatten(collect_set(array)))`` over arrays from a domain of a few values."""
    arrays = t.lineitem.select("l_suppkey", F.array("l_returnflag").alias("flags"))
    return arrays.groupBy("l_suppkey").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("flags")))).alias("flags")
    )


@query("X5 X6", f"""
    WITH {DOCS}
    SELECT order_id, list_sort(list(book_id)) AS multiple_copies FROM docs WHERE quantity >= 40
    GROUP BY order_id
""")
def basket_filter(t: Tables) -> DataFrame:
    """Books bought in number, only for orders that have any."""
    kept = order_documents(t).select(
        "order_id", F.filter("books", lambda b: b.quantity >= 40).alias("multiple_copies")
    )
    return kept.where(F.size("multiple_copies") > 0).select(
        "order_id", F.array_sort("multiple_copies.book_id").alias("multiple_copies")
    )


@query("X7 F12", f"""
    WITH {DOCS}
    SELECT order_id, list_sort(list(CAST(trunc(subtotal * 0.8) AS BIGINT))) AS discounted
    FROM docs GROUP BY order_id
""")
def basket_discount(t: Tables) -> DataFrame:
    return order_documents(t).select(
        "order_id",
        F.array_sort(F.transform("books", lambda b: (b.subtotal * F.lit(0.8)).cast("bigint"))).alias("discounted"),
    )


@query("X5 X7", """
    SELECT vec_id, label, len(list_filter(embedding, lambda x: x > 0)) AS positives, len(embedding) AS dims
    FROM embeddings
""")
def positive_dimensions(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", "label",
        F.size(F.filter("embedding", lambda x: x > 0)).cast("bigint").alias("positives"),
        F.size("embedding").cast("bigint").alias("dims"),
    )


@query("X9", f"""
    WITH {PROFILES}
    SELECT customer_id, 'https://www.' || split_part(email, '@', 2) AS url FROM profiles
""")
def customer_urls(t: Tables) -> DataFrame:
    return customer_profiles(t).select(
        "customer_id", F.concat(F.lit("https://www."), domain_part("email")).alias("url")
    )


@query("X10 X11 X12 X13", """
    SELECT event_id, date_trunc('day', ts) AS day, strftime(ts, '%Y-%m') AS year_month,
           date_trunc('second', ts) AS at_second, date_trunc('milliseconds', ts) AS at_milli
    FROM events
""")
def event_times(t: Tables) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    second = F.to_timestamp(F.from_unixtime(F.unix_timestamp(at), "yyyy-MM-dd HH:mm:ss"))
    return t.events.select(
        "event_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        second.cast("timestamp_ntz").alias("at_second"),
        F.timestamp_millis(F.unix_millis(at)).cast("timestamp_ntz").alias("at_milli"),
    )


@query("X15", "SELECT count(*) AS row_count, count(*) AS stamped FROM orders")
def stamped_orders(t: Tables) -> DataFrame:
    stamped = t.orders.withColumn("processed", F.current_timestamp())
    return stamped.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("processed") > F.col("o_orderdate").cast("timestamp")).alias("stamped"),
    )


@query("Y1 Y2 Y3 F7 F11 X9", """
    SELECT page_id, 'https://www.' || host AS address,
           CASE WHEN host LIKE '%.com' THEN 'commercial' WHEN host LIKE '%.org' THEN 'organisation'
                ELSE 'other: ' || host END AS category
    FROM (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages)
""")
def sql_udf_case(t: Tables) -> DataFrame:
    """SQL functions kept in the catalog; Spark inlines them into the plan."""
    tag = uuid.uuid4().hex[:8]
    spark = t.spark
    spark.sql(f"""
        CREATE OR REPLACE FUNCTION host_address_{tag}(host STRING) RETURNS STRING
        RETURN concat('https://www.', host)
    """)
    spark.sql(f"""
        CREATE OR REPLACE FUNCTION host_category_{tag}(host STRING) RETURNS STRING
        RETURN CASE WHEN host LIKE '%.com' THEN 'commercial' WHEN host LIKE '%.org' THEN 'organisation'
                    ELSE concat('other: ', host) END
    """)
    host = F.get(F.split(F.get(F.split("url", "://"), F.lit(1)), "/"), F.lit(0))
    result = t.pages.select("page_id", host.alias("host")).selectExpr(
        "page_id", f"host_address_{tag}(host) AS address", f"host_category_{tag}(host) AS category"
    )
    spark.sql(f"DESCRIBE FUNCTION EXTENDED host_category_{tag}")
    spark.sql(f"DROP FUNCTION host_address_{tag}")
    spark.sql(f"DROP FUNCTION host_category_{tag}")
    return result


@query("X3", """
    SELECT doc_id, CAST(NULL AS VARCHAR) AS parsed FROM documents
""")
def malformed_json(t: Tables) -> DataFrame:
    """Text that is not JSON parses to NULL fields instead of failing the query."""
    return t.documents.select("doc_id", F.from_json("text", "title STRING").alias("j")).select(
        "doc_id", F.col("j.title").alias("parsed")
    )


@query("F12", f"""
    WITH {PROFILES} SELECT customer_id, octet_length(encode(email)) AS n_bytes, email FROM profiles
""")
def binary_round_trip(t: Tables) -> DataFrame:
    coded = customer_profiles(t).select("customer_id", F.col("email").cast("binary").alias("b"))
    return coded.select(
        "customer_id", F.octet_length("b").cast("bigint").alias("n_bytes"), F.col("b").cast("string").alias("email")
    )


@query("A3 F12", """
    SELECT l_returnflag, l_linestatus, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           count(*) AS n_lines
    FROM lineitem GROUP BY 1, 2
""")
def revenue_by_flag(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(cents("l_extendedprice")).alias("cents"), F.count(F.lit(1)).alias("n_lines")
    )


@query("X2 S14 F2", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events
""")
def props_by_whole_schema(t: Tables) -> DataFrame:
    """JSON text read with a schema merged from every row, not from a sample."""
    schema = whole_schema(t.events, "props")
    return t.events.select("event_id", F.from_json("props", schema).alias("p")).select("event_id", F.col("p.k").cast("string").alias("k"))
