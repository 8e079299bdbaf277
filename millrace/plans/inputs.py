"""Inputs of a book shop, derived from the supplied tables.

Parts are the books, brands their authors, nations the countries, order lines the
``books`` array of an order, and events the change feed of the customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import file_stream

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# fixed values: the payload schemas of the three topics
ORDER_SCHEMA = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total BIGINT, "
    "books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: BIGINT>>"
)
CUSTOMER_EVENT_SCHEMA = (
    "customer_id STRING, email STRING, first_name STRING, last_name STRING, gender STRING, "
    "street STRING, city STRING, country_code STRING, row_status STRING, row_time TIMESTAMP"
)
BOOK_SCHEMA = "book_id STRING, title STRING, author STRING, price DOUBLE, updated TIMESTAMP"

# an error event above this value stands for a request to delete the customer
DELETE_VALUE = 150


class Tables:
    """The supplied tables by attribute: ``Tables(spark, folder).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream of its files; the pattern only fits the table's own path."""
        schema = getattr(self, name).schema
        return file_stream(self.spark, f"{self.path(name)[:-1]}[t]", "parquet", schema)


def cents(column: str | Column) -> Column:
    """A money amount as a whole number, so that sums do not depend on their order.

    Halves go away from zero, as with ``round``, whose way through decimal text costs more than the rest of a sum of lines.
    """
    amount = (F.col(column) if isinstance(column, str) else column) * 100
    whole = amount.cast("bigint")
    return F.when(amount - whole >= 0.5, whole + 1).when(amount - whole <= -0.5, whole - 1).otherwise(whole)


def order_lines(t: Tables) -> DataFrame:
    """One row per order and line number; repeated lines are added up.

    The grouping has a partial step before its shuffle, so an order listed very many
    times arrives as a handful of rows.
    """
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("book_key"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("subtotal"),
    )


def order_documents(t: Tables) -> DataFrame:
    """Orders with their ``books`` array; an order has at most one entry per line number."""
    # numbers only while lines are shuffled and sorted; keys become text in the finished array
    line = F.struct(F.col("l_linenumber").alias("line"), "book_key", "quantity", "subtotal")
    baskets = order_lines(t).groupBy("l_orderkey").agg(
        F.sum("quantity").alias("quantity"),
        F.sum("subtotal").alias("total"),
        F.array_sort(F.collect_list(line)).alias("books"),
    )
    return t.orders.join(baskets, F.col("o_orderkey") == F.col("l_orderkey"), "inner").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        "quantity",
        "total",
        F.transform("books", lambda b: F.struct(
            b.book_key.cast("string").alias("book_id"), b.quantity.alias("quantity"), b.subtotal.alias("subtotal"))).alias("books"),
    )


def customer_email(name: Column, segment: Column) -> Column:
    return F.concat(F.lower(name), F.lit("@"), F.lower(segment), F.lit(".com"))


def customer_profiles(t: Tables) -> DataFrame:
    """Customers with an e-mail and a JSON ``profile`` text."""
    nation = t.nation.select(F.col("n_nationkey"), F.col("n_name"))
    rows = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    profile = F.to_json(
        F.struct(
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.struct(F.col("n_name").alias("country"), F.col("c_nationkey").alias("code")).alias("address"),
        )
    )
    return rows.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        customer_email(F.col("c_name"), F.col("c_mktsegment")).alias("email"),
        profile.alias("profile"),
    )


def row_status() -> Column:
    """What an event does to its customer."""
    return (
        F.when((F.col("event_type") == "error") & (F.col("value") > DELETE_VALUE), "delete")
        .when(F.col("event_type") == "signup", "insert")
        .otherwise("update")
    )


def customer_events(t: Tables) -> DataFrame:
    """The change feed of the customers, one full row per change."""
    customer = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return t.events.join(customer, F.col("user_id") == F.col("c_custkey"), "inner").select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("e"), F.col("event_id"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com")).alias("email"),
        F.col("c_name").alias("first_name"),
        F.col("event_type").alias("last_name"),
        F.lit(None).cast("string").alias("gender"),
        F.get_json_object("props", "$.k").alias("street"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        row_status().alias("row_status"),
        F.col("ts").cast("timestamp").alias("row_time"),
    )


def books(t: Tables) -> DataFrame:
    """The books as first published."""
    return t.part.select(
        F.col("p_partkey").cast("string").alias("book_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        F.col("p_retailprice").alias("price"),
        F.lit("1990-01-01").cast("timestamp").alias("updated"),
    )


def book_updates(t: Tables) -> DataFrame:
    """A new price for every book sold: the highest amount of one of its order lines."""
    sold = t.lineitem.groupBy("l_partkey").agg(
        F.max("l_extendedprice").alias("price"), F.max("l_shipdate").alias("updated")
    )
    return t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "inner").select(
        F.col("p_partkey").cast("string").alias("book_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        "price",
        F.col("updated").cast("timestamp").alias("updated"),
    )


def countries(t: Tables) -> DataFrame:
    """Country lookup."""
    return t.nation.select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("country")
    )
