"""Versions, change feeds and their maintenance.

The versioned table holds every part. Version 1 inserts them, version 2 raises the
price of one type, version 3 deletes the large ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import ChangeTable, Update, diff_changes, lost_rows, sync_copy
from millrace.plans.inputs import Tables
from millrace.queries.registry import query
from millrace.session import new_folder
from millrace.streaming import append_to

SCHEMA = "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"

V1 = "SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM part"
V2 = """
    SELECT p_partkey, p_name, p_type, p_size,
           CASE WHEN p_type = 'PROMO' THEN p_retailprice + 5 ELSE p_retailprice END AS p_retailprice
    FROM part
"""
V3 = f"SELECT * FROM ({V2}) WHERE p_size <= 40"
FEED_2 = f"""
    SELECT *, 'update_preimage' AS _change_type, CAST(2 AS BIGINT) AS _commit_version FROM ({V1}) WHERE p_type = 'PROMO'
    UNION ALL
    SELECT *, 'update_postimage', 2 FROM ({V2}) WHERE p_type = 'PROMO'
"""
FEED_3 = f"SELECT *, 'delete' AS _change_type, CAST(3 AS BIGINT) AS _commit_version FROM ({V2}) WHERE p_size > 40"


def _parts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")


def _versioned(t: Tables) -> ChangeTable:
    table = ChangeTable(t.spark, new_folder(t.spark, "parts"), SCHEMA, ["p_partkey"])
    table.insert(_parts(t))
    _raise_and_delete(t, table)
    return table


def _raise_and_delete(t: Tables, table: ChangeTable) -> None:
    promo = t.part.where("p_type = 'PROMO'").select("p_partkey")
    table.merge(promo, ["p_partkey"], [Update({"p_retailprice": "t.p_retailprice + 5"})], operation="UPDATE")
    table.delete(table.current().where("p_size > 40"))


def _without_time(feed: DataFrame) -> DataFrame:
    return feed.drop("_commit_timestamp")


@query("S17 D16", f"{FEED_2} UNION ALL {FEED_3}")
def change_feed(t: Tables) -> DataFrame:
    return _without_time(_versioned(t).feed(2))


@query("S17", FEED_2)
def change_feed_between(t: Tables) -> DataFrame:
    return _without_time(_versioned(t).feed(2, 2))


@query("S16 W9", f"{FEED_2} UNION ALL {FEED_3}")
def change_feed_stream(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "feed")
    stream = _without_time(_versioned(t).feed_stream(start=2))
    return append_to(stream, f"{folder}/table", f"{folder}/checkpoint")


@query("S19", f"""
    SELECT *, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM ({V1})
""")
def stream_ignoring_deletes(t: Tables) -> DataFrame:
    """Inserted rows keep streaming although rows are updated and deleted later."""
    folder = new_folder(t.spark, "inserts")
    stream = _without_time(_versioned(t).feed_stream(types=["insert"]))
    return append_to(stream, f"{folder}/table", f"{folder}/checkpoint")


@query("S18", V1)
def as_of_version(t: Tables) -> DataFrame:
    return _versioned(t).as_of(1)


@query("S18", V2)
def as_of_timestamp(t: Tables) -> DataFrame:
    """Content at the moment version 2 was committed."""
    table = _versioned(t)
    moment = table.commits().where("version = 2").first()["committed_at"]
    return table.as_of(timestamp=moment)


@query("S18 D3", V3)
def current_version(t: Tables) -> DataFrame:
    return _versioned(t).current()


@query("W18", """
    SELECT CAST(1 AS BIGINT) AS version, 'WRITE' AS operation, count(*) AS rows_inserted,
           CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted FROM part
    UNION ALL SELECT 2, 'UPDATE', 0, count(*), 0 FROM part WHERE p_type = 'PROMO'
    UNION ALL SELECT 3, 'DELETE', 0, 0, count(*) FROM part WHERE p_size > 40
""")
def table_history(t: Tables) -> DataFrame:
    return _versioned(t).history().drop("committed_at")


@query("D17", V1)
def restored(t: Tables) -> DataFrame:
    """Version 1 brought back as version 4."""
    table = _versioned(t)
    table.restore(1)
    return table.current()


@query("D18 U4", f"SELECT * FROM ({V2}) WHERE p_size > 40")
def rows_lost_since(t: Tables) -> DataFrame:
    table = _versioned(t)
    return lost_rows(table.as_of(2), table.current())


@query("D19", f"""
    SELECT *, CAST(3 AS BIGINT) AS oldest_version FROM ({V3}) WHERE p_size <= 20
""")
def expired(t: Tables) -> DataFrame:
    """Older versions dropped, then one more delete on top of the folded base."""
    table = _versioned(t)
    oldest = table.expire(older_than_hours=0, force=True)
    table.delete(table.current().where("p_size > 20"))
    return table.current().withColumn("oldest_version", F.lit(oldest).cast("bigint"))


@query("D20", f"SELECT *, CAST(2 AS BIGINT) AS copy_version FROM ({V3})")
def synced_copy(t: Tables) -> DataFrame:
    """A full copy, brought up to date with a second call after the source has changed."""
    table = ChangeTable(t.spark, new_folder(t.spark, "parts"), SCHEMA, ["p_partkey"])
    copy = ChangeTable(t.spark, new_folder(t.spark, "copy"), SCHEMA, ["p_partkey"])
    table.insert(_parts(t))
    sync_copy(table, copy)
    _raise_and_delete(t, table)
    sync_copy(table, copy)
    return copy.current().withColumn("copy_version", F.lit(copy.version()).cast("bigint"))


@query("D16", """
    WITH old AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_nationkey < 20),
         new AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS v
                 FROM customer WHERE c_nationkey >= 5)
    SELECT n.k, n.v, 'insert' AS _change_type FROM new n WHERE k NOT IN (SELECT k FROM old)
    UNION ALL SELECT o.k, o.v, 'delete' FROM old o WHERE k NOT IN (SELECT k FROM new)
    UNION ALL SELECT o.k, o.v, 'update_preimage' FROM old o JOIN new n ON o.k = n.k WHERE o.v <> n.v
    UNION ALL SELECT n.k, n.v, 'update_postimage' FROM old o JOIN new n ON o.k = n.k WHERE o.v <> n.v
""")
def table_differences(t: Tables) -> DataFrame:
    """The changes between two states of the customers that overlap in part."""
    key, balance = F.col("c_custkey").alias("k"), F.col("c_acctbal")
    old = t.customer.where("c_nationkey < 20").select(key, balance.alias("v"))
    raised = F.when(balance < 0, 0.0).otherwise(balance).alias("v")
    return diff_changes(old, t.customer.where("c_nationkey >= 5").select(key, raised), ["k"])


@query("Q1 Q2 Q3 Q4", f"""
    SELECT p_partkey, p_name, p_type, p_size, p_retailprice, 'sensible_price' AS constraints
    FROM ({V1}) WHERE p_size <= 25
""")
def rejected_write(t: Tables) -> DataFrame:
    """A table with a constraint of its own: the insert that breaks it changes nothing, the other one counts."""
    table = ChangeTable(t.spark, new_folder(t.spark, "parts"), SCHEMA, ["p_partkey"])
    table.insert(_parts(t).where("p_size <= 10"))
    table.add_constraint("sensible_price", "p_retailprice > 0")
    broken = _parts(t).where("p_size > 10").withColumn("p_retailprice", F.when(F.col("p_size") > 40, -1.0).otherwise(F.col("p_retailprice")))
    try:
        table.insert(broken)
    except ValueError:
        table.insert(broken.where("p_size <= 25"))
    names = ",".join(table.constraints())
    return table.current().withColumn("constraints", F.lit(names))
