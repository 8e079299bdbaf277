"""Reading files in several formats, once and incrementally.

The files are written by Spark from the supplied tables, so each query covers a
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import delete_rows, lookup_join
from millrace.plans.inputs import Tables, countries
from millrace.queries.registry import query
from millrace.session import new_folder
from millrace.sources import bronze_envelope, copy_into, ingest_files, with_provenance
from millrace.streaming import append_to

CUSTOMER_ROWS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _customer_json(t: Tables) -> str:
    folder = new_folder(t.spark, "customers-json")
    t.customer.write.json(folder)
    return folder


@query("S1 S2 S11", """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def scan_json_glob(t: Tables) -> DataFrame:
    """JSON files picked by a pattern, with the schema inferred from them."""
    folder = _customer_json(t)
    return t.spark.sql(
        f"SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM json.`{folder}/part-*.json`"
    )


@query("S3 A1", "SELECT count(*) AS row_count FROM customer")
def scan_json_folder_count(t: Tables) -> DataFrame:
    return t.spark.sql(f"SELECT count(*) AS row_count FROM json.`{_customer_json(t)}/`")


@query("S11", CUSTOMER_ROWS)
def scan_json_typed(t: Tables) -> DataFrame:
    return t.spark.read.schema(t.customer.schema).json(_customer_json(t))


@query("S4 X15 X16", """
    SELECT 'lineitem.parquet' AS source_table, count(*) AS row_count, count(*) AS stamped FROM lineitem
""")
def scan_with_provenance(t: Tables) -> DataFrame:
    """Source file and arrival time of every row, counted per source table."""
    rows = with_provenance(t.lineitem)
    return rows.groupBy(
        F.regexp_extract("source_file", "(lineitem\\.parquet)", 1).alias("source_table")
    ).agg(F.count(F.lit(1)).alias("row_count"), F.count("arrival_time").alias("stamped"))


@query("S5", r"""
    SELECT count(*) AS line_count, CAST(sum(CASE WHEN line = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_count,
           CAST(sum(length(line)) AS BIGINT) AS char_count
    FROM (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents)
""")
def scan_text_lines(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "documents-text")
    t.documents.select("text").write.text(folder)
    return t.spark.sql(f"SELECT value FROM text.`{folder}`").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("value") == "").alias("blank_count"),
        F.sum(F.length("value").cast("bigint")).alias("char_count"),
    )


@query("S6", """
    SELECT CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS byte_count,
           CAST(sum(length(text) + 1) AS BIGINT) AS char_count FROM documents
""")
def scan_binary_files(t: Tables) -> DataFrame:
    """Whole files as bytes plus metadata: the bytes are decoded and counted as characters."""
    folder = new_folder(t.spark, "documents-binary")
    t.documents.select("text").write.text(folder)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.agg(F.sum("length").alias("byte_count"), F.sum(F.length(F.decode("content", "utf-8"))).alias("char_count"))


def _book_csv(t: Tables) -> str:
    folder = new_folder(t.spark, "books-csv")
    books = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    books.write.option("header", "true").option("delimiter", ";").csv(folder)
    return folder


@query("S7", "SELECT count(*) AS data_lines, TRUE AS header_is_data FROM part")
def scan_csv_without_options(t: Tables) -> DataFrame:
    """Without options the header is data and a ``;`` file has a single column."""
    raw = t.spark.sql(f"SELECT * FROM csv.`{_book_csv(t)}`")
    (only,) = raw.columns
    is_header = F.startswith(only, F.lit("p_partkey;"))
    return raw.agg(
        F.count_if(~is_header).alias("data_lines"), (F.count_if(is_header) > 0).alias("header_is_data")
    )


@query("S10", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def scan_parquet_by_path(t: Tables) -> DataFrame:
    return t.spark.sql(
        f"SELECT o_orderstatus, count(*) AS n FROM parquet.`{t.path('orders')}` GROUP BY o_orderstatus"
    )


@query("S20", """
    SELECT o_orderkey, label, weight FROM orders
    JOIN (VALUES ('F', 'filled', 1), ('O', 'open', 2), ('P', 'partial', 3)) v(code, label, weight)
      ON o_orderstatus = code
""")
def inline_rows(t: Tables) -> DataFrame:
    labels = t.spark.sql(
        "SELECT * FROM VALUES ('F', 'filled', 1), ('O', 'open', 2), ('P', 'partial', 3) AS v(code, label, weight)"
    )
    return t.orders.join(labels, F.col("o_orderstatus") == F.col("code"), "inner").select(
        "o_orderkey", "label", "weight"
    )


@query("W8 S7", "SELECT p_partkey, p_name, p_retailprice FROM part UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def appended_csv(t: Tables) -> DataFrame:
    """Appending the same rows to CSV files twice duplicates them."""
    folder = new_folder(t.spark, "books-appended")
    rows = t.part.select("p_partkey", "p_name", "p_retailprice")
    for _ in range(2):
        rows.write.mode("append").format("csv").option("header", "true").option("delimiter", ";").save(folder)
    return t.spark.read.schema(rows.schema).option("header", "true").option("delimiter", ";").csv(folder)


@query("S14 R12", """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer
""")
def ingested_with_new_field(t: Tables) -> DataFrame:
    """Two runs of one incremental load; the files of the second bring a new field."""
    folder, base = new_folder(t.spark, "arrivals"), new_folder(t.spark, "ingest")
    debtors = F.col("c_acctbal") < 0

    def load() -> None:
        stream = ingest_files(t.spark, folder, "json", schema_location=f"{base}/schema")
        append_to(stream, f"{base}/table", f"{base}/checkpoint")

    t.customer.where(debtors).select("c_custkey", "c_name").write.mode("append").json(folder)
    load()
    later = delete_rows(t.customer, debtors).select("c_custkey", "c_name", "c_mktsegment")
    later.write.mode("append").json(folder)
    load()
    return t.spark.read.option("mergeSchema", "true").parquet(f"{base}/table").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


def _arrivals(t: Tables, fmt: str, first: DataFrame, later: DataFrame) -> DataFrame:
    """Two runs of one incremental load, with other columns in the second run's files."""
    folder, base = new_folder(t.spark, "arrivals"), new_folder(t.spark, "ingest")
    for rows in (first, later):
        rows.write.mode("append").format(fmt).save(folder)
        stream = ingest_files(t.spark, folder, fmt, schema_location=f"{base}/schema")
        append_to(stream, f"{base}/table", f"{base}/checkpoint")
    return t.spark.read.option("mergeSchema", "true").parquet(f"{base}/table")


@query("S14 R12", """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer
""")
def ingested_nested_field(t: Tables) -> DataFrame:
    """The later files have one more field within a known struct."""
    first = t.customer.where("c_acctbal < 0").select("c_custkey", F.struct("c_name").alias("profile"))
    later = t.customer.where("c_acctbal >= 0").select("c_custkey", F.struct("c_name", "c_mktsegment").alias("profile"))
    return _arrivals(t, "json", first, later).select("c_custkey", "profile.c_name", "profile.c_mktsegment")


@query("S14 R12", """
    SELECT c_custkey, CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS BIGINT) AS c_nationkey FROM customer
""")
def ingested_new_parquet_column(t: Tables) -> DataFrame:
    """The later parquet files have one more column."""
    first = t.customer.where("c_acctbal < 0").select("c_custkey")
    later = t.customer.where("c_acctbal >= 0").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"))
    return _arrivals(t, "parquet", first, later).select("c_custkey", "c_nationkey")


@query("S15", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def copy_into_idempotent(t: Tables) -> DataFrame:
    """Files loaded before are skipped, so the second and third call change nothing or only add."""
    folder, base = new_folder(t.spark, "orders-files"), new_folder(t.spark, "copied")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")

    def load() -> DataFrame:
        return copy_into(
            t.spark, f"{base}/table", folder, "json", f"{base}/checkpoint", schema=rows.schema
        )

    rows.where("o_orderstatus = 'F'").write.mode("append").json(folder)
    load()
    load()
    rows.where("o_orderstatus <> 'F'").write.mode("append").json(folder)
    return load()


@query("S21 F12", """
    SELECT event_type AS topic, strftime(ts, '%Y-%m') AS year_month, count(*) AS messages,
           CAST(sum(octet_length(encode(CAST(user_id AS VARCHAR)))) AS BIGINT) AS key_bytes
    FROM events GROUP BY 1, 2
""")
def event_envelopes(t: Tables) -> DataFrame:
    """Events as messages of several topics, with the partition columns of the bronze table."""
    raw = t.events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "value", "props")).cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.lit(0).cast("bigint").alias("partition"),
        F.col("event_id").alias("offset"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    return bronze_envelope(raw).groupBy("topic", "year_month").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.octet_length("key").cast("bigint")).alias("key_bytes")
    )


@query("J2 S11", """
    SELECT c_custkey, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def country_lookup_file(t: Tables) -> DataFrame:
    """Customers joined with a country lookup read from JSON, broadcast after a size check."""
    folder = new_folder(t.spark, "countries")
    countries(t).write.json(folder)
    lookup = t.spark.read.schema("code STRING, country STRING").json(folder)
    rows = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("country_code"))
    return lookup_join(rows, lookup, F.col("country_code") == F.col("code")).select("c_custkey", "country")
