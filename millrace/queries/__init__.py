"""All registered queries; importing this package fills ``CATALOG``."""

from millrace.queries import (  # noqa: F401
    files, nested, relational, rows, rules, streams, tables, versions,
)
from millrace.queries.registry import CATALOG, Query

__all__ = ["CATALOG", "Query"]
