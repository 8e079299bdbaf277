"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the number of local cores. Batch
queries are timed to a sink that drops the rows, best of two runs; flows that write
tables run once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.plans.feeds import message_batches  # noqa: E402
from millrace.plans.inputs import Tables, countries  # noqa: E402
from millrace.plans.medallion import Medallion  # noqa: E402
from millrace.queries import CATALOG  # noqa: E402
from millrace.session import build_session, new_folder  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

BATCH = (
    "country_daily_sales explode_order_lines author_sets customer_sets basket_filter basket_discount "
    "revenue_by_flag priority_pivot returnflag_pivot_sql set_union set_intersect set_minus "
    "distinct_order_lines newest_sales_with_ties newest_change_per_user largest_orders lines_off_list_price "
    "merge_fill_missing merge_newest_wins merge_with_delete merge_update_only inserted_new_rows scd2_books "
    "table_differences quarantined_lines violation_counts policy_for_one_group file_statistics"
).split()
FLOWS = (
    "restored expired synced_copy change_feed_stream copy_into_idempotent dedup_lines_stream "
    "dedup_upsert_lines window_stats_stream author_counts_stream stream_static_sales stream_stream_orders "
    "newest_event_stream daily_customer_books compacted zordered"
).split()


def seconds(work) -> float:
    begin = time.perf_counter()
    work()
    return time.perf_counter() - begin


def medallion(spark) -> dict[str, float]:
    """Both message batches through every table, then the deletes."""
    t = Tables(spark, FOLDER)
    flow = Medallion(spark, new_folder(spark, "bench-flow"), countries(t), "bench_current_books")
    batches = message_batches(t)
    times = {f"flow_batch_{n}": seconds(lambda m=m: flow.run_batch(m)) for n, m in enumerate(batches, 1)}
    times["flow_deletes"] = seconds(lambda: (flow.process_delete_requests(), flow.process_deletes()))
    return times


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"), spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    drop = lambda name: CATALOG[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    drop("count_lines")
    times = {name: min(seconds(lambda: drop(name)) for _ in range(2)) for name in BATCH}
    times |= {name: seconds(lambda: drop(name)) for name in FLOWS}
    times |= medallion(spark)
    times = {name: round(value, 3) for name, value in times.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(FOLDER).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
