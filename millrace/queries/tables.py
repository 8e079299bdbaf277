"""Catalog objects: managed and external tables, views, overwrites, metadata."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import replace_table, snapshots, table_detail
from millrace.plans.inputs import Tables
from millrace.queries.registry import query
from millrace.session import new_folder


def _schema(t: Tables) -> str:
    """A new catalog schema with its own location in the shared folder."""
    name = f"millrace_{uuid.uuid4().hex[:10]}"
    t.spark.sql(f"CREATE SCHEMA {name} LOCATION '{new_folder(t.spark, name)}'")
    return name


@query("W1 S12 W14", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def managed_table(t: Tables) -> DataFrame:
    db = _schema(t)
    t.supplier.createOrReplaceTempView("millrace_supplier")
    t.spark.sql(f"""
        CREATE TABLE {db}.suppliers (s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE)
        USING parquet
    """)
    t.spark.sql(f"INSERT INTO {db}.suppliers SELECT * FROM millrace_supplier")
    return t.spark.table(f"{db}.suppliers")


@query("W2 W13", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def dropped_external_table(t: Tables) -> DataFrame:
    """Dropping an external table keeps its files."""
    db, folder = _schema(t), new_folder(t.spark, "suppliers")
    t.supplier.createOrReplaceTempView("millrace_supplier")
    t.spark.sql(f"""
        CREATE TABLE {db}.suppliers (s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE)
        USING parquet LOCATION '{folder}'
    """)
    t.spark.sql(f"INSERT INTO {db}.suppliers SELECT s_suppkey, s_name, s_acctbal FROM millrace_supplier")
    t.spark.sql(f"DROP TABLE {db}.suppliers")
    t.spark.sql(f"DROP SCHEMA IF EXISTS {db} CASCADE")
    return t.spark.read.parquet(folder)


@query("W3", "SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0")
def ctas_renamed(t: Tables) -> DataFrame:
    db = _schema(t)
    t.customer.createOrReplaceTempView("millrace_customer")
    t.spark.sql(f"""
        CREATE TABLE {db}.solvent USING parquet AS
        SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM millrace_customer WHERE c_acctbal > 0
    """)
    return t.spark.table(f"{db}.solvent")


@query("W4 L1 L2", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
""")
def partitioned_ctas(t: Tables) -> DataFrame:
    """A partitioned table with a comment; the filter reads one partition folder."""
    db, folder = _schema(t), new_folder(t.spark, "orders-by-status")
    t.orders.createOrReplaceTempView("millrace_orders")
    t.spark.sql(f"""
        CREATE TABLE {db}.orders USING parquet PARTITIONED BY (o_orderstatus)
        LOCATION '{folder}' COMMENT 'orders by status'
        AS SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM millrace_orders
    """)
    return t.spark.table(f"{db}.orders").where("o_orderstatus = 'P'").drop("o_orderstatus")


BOOKS_DDL = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_retailprice DOUBLE"
BOOKS_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part"


def _books_csv(t: Tables) -> str:
    folder = new_folder(t.spark, "books-csv")
    books = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    books.write.option("header", "true").option("delimiter", ";").csv(folder)
    return folder


@query("S8", BOOKS_SQL)
def csv_table(t: Tables) -> DataFrame:
    db = _schema(t)
    t.spark.sql(f"""
        CREATE TABLE {db}.books ({BOOKS_DDL}) USING CSV
        OPTIONS (header = 'true', delimiter = ';') LOCATION '{_books_csv(t)}'
    """)
    return t.spark.table(f"{db}.books")


@query("S9 W3 V2", BOOKS_SQL)
def csv_view_to_table(t: Tables) -> DataFrame:
    """Options belong to a view over the files; the table made from it is parquet."""
    db = _schema(t)
    t.spark.sql(f"""
        CREATE OR REPLACE TEMPORARY VIEW millrace_books ({BOOKS_DDL}) USING CSV
        OPTIONS (path = '{_books_csv(t)}', header = 'true', delimiter = ';')
    """)
    t.spark.sql(f"CREATE TABLE {db}.books USING parquet AS SELECT * FROM millrace_books")
    return t.spark.table(f"{db}.books")


@query("W5", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders")
def replaced_table(t: Tables) -> DataFrame:
    """Replace a table by a query that reads the table itself."""
    db, folder = _schema(t), new_folder(t.spark, "replaced")
    name = f"{db}.orders"
    replace_table(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), name, folder)
    doubled = t.spark.table(name).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_table(doubled, name, folder)
    return t.spark.table(name)


@query("W6 W7 A1", """
    SELECT o_orderstatus, count(*) * 2 AS n FROM orders GROUP BY o_orderstatus
""")
def overwritten_then_appended(t: Tables) -> DataFrame:
    """INSERT OVERWRITE replaces, INSERT INTO adds - also rows that are there already."""
    db = _schema(t)
    t.orders.createOrReplaceTempView("millrace_orders")
    t.spark.sql(f"CREATE TABLE {db}.orders USING parquet AS SELECT * FROM millrace_orders")
    t.spark.sql(f"INSERT OVERWRITE {db}.orders SELECT * FROM millrace_orders")
    t.orders.write.insertInto(f"{db}.orders")
    return t.spark.table(f"{db}.orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("W15", "SELECT count(*) * 2 AS row_count FROM orders")
def refreshed_table(t: Tables) -> DataFrame:
    """Files added behind the catalog's back are seen after a refresh."""
    db, folder = _schema(t), new_folder(t.spark, "orders")
    t.orders.write.parquet(folder)
    t.spark.sql(f"CREATE TABLE {db}.orders USING parquet LOCATION '{folder}'")
    t.spark.table(f"{db}.orders").count()
    t.orders.write.mode("append").parquet(folder)
    t.spark.sql(f"REFRESH TABLE {db}.orders")
    return t.spark.table(f"{db}.orders").agg(F.count(F.lit(1)).alias("row_count"))


@query("W16", """
    SELECT column_name AS col_name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                WHEN 'VARCHAR' THEN 'string' END AS data_type
    FROM (DESCRIBE customer) d(column_name, data_type, n, k, df, e)
""")
def described_table(t: Tables) -> DataFrame:
    db = _schema(t)
    t.customer.write.saveAsTable(f"{db}.customers")
    return t.spark.sql(f"DESCRIBE TABLE {db}.customers").select("col_name", "data_type")


@query("W16 W13 V5", "SELECT 'customers' AS name, FALSE AS is_temporary UNION ALL SELECT 'debtors', FALSE")
def listed_tables(t: Tables) -> DataFrame:
    """Tables and views of a schema after one of each was dropped again."""
    db = _schema(t)
    t.customer.write.saveAsTable(f"{db}.customers")
    t.customer.write.saveAsTable(f"{db}.dropped")
    t.spark.sql(f"CREATE VIEW {db}.debtors AS SELECT * FROM {db}.customers WHERE c_acctbal < 0")
    t.spark.sql(f"CREATE VIEW {db}.unused AS SELECT * FROM {db}.customers")
    t.spark.sql(f"DROP TABLE {db}.dropped")
    t.spark.sql(f"DROP VIEW {db}.unused")
    return t.spark.sql(f"SHOW TABLES IN {db}").where("NOT isTemporary").select(
        F.col("tableName").alias("name"), F.col("isTemporary").alias("is_temporary")
    )


@query("W19 W20", "SELECT 'quality' AS key, 'checked' AS value")
def table_properties(t: Tables) -> DataFrame:
    db = _schema(t)
    t.spark.sql(f"USE {db}")
    try:
        t.spark.sql("SET spark.sql.parquet.compression.codec = snappy")
        t.customer.write.saveAsTable("customers")
        t.spark.sql("ALTER TABLE customers SET TBLPROPERTIES ('quality' = 'checked')")
        return t.spark.sql(f"SHOW TBLPROPERTIES {db}.customers").where("key = 'quality'")
    finally:
        t.spark.sql("USE default")


@query("W17", "SELECT count(*) AS num_rows, 11 AS num_columns FROM lineitem")
def described_detail(t: Tables) -> DataFrame:
    """Size, files and rows of a table; the figures that depend on the layout are left out."""
    return table_detail(t.lineitem).select("num_rows", "num_columns")


@query("V1 V4 F14", """
    SELECT DISTINCT p_brand FROM part WHERE p_type = 'PROMO' AND p_size > 10
""")
def stored_views(t: Tables) -> DataFrame:
    """A view on a view over a table."""
    db = _schema(t)
    t.part.write.saveAsTable(f"{db}.parts")
    t.spark.sql(f"CREATE VIEW IF NOT EXISTS {db}.promo AS SELECT * FROM {db}.parts WHERE p_type = 'PROMO'")
    t.spark.sql(f"CREATE OR REPLACE VIEW {db}.brands AS SELECT DISTINCT p_brand FROM {db}.promo WHERE p_size > 10")
    return t.spark.table(f"{db}.brands")


@query("V2 V3 V5 T1", """
    SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 40 ORDER BY p_size DESC, p_partkey
""")
def temporary_views(t: Tables) -> DataFrame:
    """A session view and one shared by all sessions, dropped after use."""
    name = f"millrace_{uuid.uuid4().hex[:10]}"
    t.part.createOrReplaceTempView(f"{name}_local")
    t.spark.sql(
        f"CREATE GLOBAL TEMPORARY VIEW {name} AS SELECT p_partkey, p_name, p_size FROM {name}_local WHERE p_size > 40"
    )
    rows = t.spark.sql(f"SELECT * FROM global_temp.{name} ORDER BY p_size DESC, p_partkey")
    t.spark.sql(f"DROP VIEW global_temp.{name}")
    t.spark.catalog.dropTempView(f"{name}_local")
    return rows


@query("W5 W6 W7 W15", """
    WITH urgent AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'),
         high AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '2-HIGH')
    SELECT *, CAST(2 AS BIGINT) AS snapshot_count FROM (SELECT * FROM urgent UNION ALL SELECT * FROM high UNION ALL SELECT * FROM high)
""")
def four_writes(t: Tables) -> DataFrame:
    """One table created, replaced, overwritten and appended to; earlier snapshots stay."""
    folder, name = new_folder(t.spark, "four-writes"), f"millrace_four_{uuid.uuid4().hex[:8]}"
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    chosen = lambda p: rows.where(F.col("o_orderpriority") == p).drop("o_orderpriority")
    replace_table(chosen("5-LOW"), name, folder)
    replace_table(chosen("2-HIGH"), name, folder)
    urgent, high = f"{name}_urgent", f"{name}_high"
    chosen("1-URGENT").createOrReplaceTempView(urgent)
    chosen("2-HIGH").createOrReplaceTempView(high)
    t.spark.sql(f"INSERT OVERWRITE {name} TABLE {urgent}")
    for _ in range(2):
        t.spark.sql(f"INSERT INTO {name} TABLE {high}")
    count = snapshots(t.spark, folder, t.spark.table(name).schema).count()
    return t.spark.table(name).withColumn("snapshot_count", F.lit(count).cast("bigint"))
