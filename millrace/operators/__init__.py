"""Batch operators on DataFrames."""

from millrace.operators.changes import ChangeTable, diff_changes, lost_rows, sync_copy
from millrace.operators.collections import item_sets
from millrace.operators.dml import delete_matching, delete_rows, insert_new, rows_not_in, update_rows
from millrace.operators.joins import lookup_join, missed_rows, salted_join
from millrace.operators.latest import latest_per_key
from millrace.operators.layout import (
    archive_partitions, compact, file_stats, files_of, partition_report, table_detail, zorder,
)
from millrace.operators.merge import Delete, Insert, Update, apply_cdc, merge_changes, merge_rows, newest_wins
from millrace.operators.quality import (
    Check, CheckViolation, add_check, assert_unique, drop_check, enforce, key_counts, not_null,
    split_valid, violations,
)
from millrace.operators.scd import current_rows, scd2_apply, scd2_changes
from millrace.operators.tables import replace_table, snapshots

__all__ = [
    "ChangeTable", "Check", "CheckViolation", "Delete", "Insert", "Update", "add_check", "apply_cdc",
    "archive_partitions", "assert_unique", "compact", "current_rows", "delete_matching", "delete_rows",
    "diff_changes", "drop_check", "enforce", "file_stats", "files_of", "insert_new", "item_sets",
    "key_counts", "latest_per_key", "lookup_join", "lost_rows", "merge_changes", "merge_rows",
    "missed_rows", "newest_wins", "not_null", "partition_report", "replace_table", "rows_not_in",
    "salted_join", "scd2_apply", "scd2_changes", "snapshots", "split_valid", "sync_copy", "table_detail",
    "update_rows", "violations", "zorder",
]
