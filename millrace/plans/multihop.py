"""The single-source three-layer flow: order files to daily books per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import json_path
from millrace.sources.files import file_stream, ingest_files
from millrace.streaming.joins import stream_static_join
from millrace.streaming.sinks import append_to, complete_to

FILE_SCHEMA = (
    "order_id STRING, order_timestamp BIGINT, customer_id STRING, quantity BIGINT, "
    "books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: BIGINT>>"
)


class MultiHop:
    """Folders of one run below ``root``; ``name`` is the gold table's catalog name."""

    def __init__(self, spark: SparkSession, orders: str, customers: str, root: str, name: str):
        self.spark, self.orders, self.customers = spark, orders, customers
        self.root, self.name = root.rstrip("/"), name

    def bronze(self) -> DataFrame:
        """Raw rows plus where and when they came in, stated as SQL over a streaming view."""
        raw = ingest_files(self.spark, self.orders, "parquet", FILE_SCHEMA)
        raw.select("*", "_metadata").createOrReplaceTempView(f"{self.name}_raw")
        stamped = self.spark.sql(f"""
            SELECT * EXCEPT (_metadata), current_timestamp() AS arrival_time,
                   _metadata.file_path AS source_file
            FROM {self.name}_raw
        """)
        return append_to(stamped, f"{self.root}/bronze", f"{self.root}/_checkpoints/bronze")

    def silver(self) -> DataFrame:
        """Orders with a quantity, joined with the customers as they are now."""
        schema = f"{FILE_SCHEMA}, arrival_time TIMESTAMP, source_file STRING"
        orders = file_stream(self.spark, f"{self.root}/bronze", "parquet", schema).where("quantity > 0")
        cleaned = orders.select(
            "order_id", "quantity", "customer_id",
            F.to_timestamp(F.from_unixtime("order_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("order_timestamp"),
            "books",
        )
        lookup_schema = "customer_id STRING, email STRING, profile STRING"

        def lookup() -> DataFrame:
            return self.spark.read.schema(lookup_schema).json(self.customers).select(
                "customer_id",
                json_path("profile", "first_name").alias("f_name"),
                json_path("profile", "last_name").alias("l_name"),
            )

        return stream_static_join(
            cleaned, lookup, ["customer_id"], f"{self.root}/silver", f"{self.root}/_checkpoints/silver"
        )

    def gold(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/silver").schema
        silver = file_stream(self.spark, f"{self.root}/silver", "parquet", schema)
        daily = silver.groupBy(
            "customer_id", "f_name", "l_name", F.date_trunc("day", "order_timestamp").alias("order_date")
        ).agg(F.sum("quantity").alias("books_count"))
        return complete_to(daily, self.name, f"{self.root}/gold", f"{self.root}/_checkpoints/gold")

    def run(self) -> DataFrame:
        self.bronze()
        self.silver()
        return self.gold()
