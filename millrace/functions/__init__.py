"""Column-level helpers."""

from millrace.functions.access import is_member, redact, row_policy
from millrace.functions.text import domain_part, json_path

__all__ = ["domain_part", "is_member", "json_path", "redact", "row_policy"]
