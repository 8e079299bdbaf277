"""The message batches that feed the multi-topic flow, from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dml import delete_rows
from millrace.plans.inputs import Tables, book_updates, books, customer_events, order_documents
from millrace.session import STORED, new_folder, written
from millrace.sources.envelope import envelope_of

# the first batch holds the orders and events before these moments, the second the rest
ORDER_CUT = "1998-07-01"
EVENT_CUT = "2024-01-16"


def message_batches(t: Tables, documents: str | None = None) -> list[DataFrame]:
    """Two batches that together carry every order, customer event, book and new price.

    The documents of the orders are made once, for both, in the folder ``documents``. Once both have landed nothing needs it.
    """
    orders = written(order_documents(t), documents or new_folder(t.spark, "order-documents"), **STORED)
    events = customer_events(t)

    def batch(first: bool, book_rows: DataFrame) -> DataFrame:
        order_part = F.col("order_timestamp") < ORDER_CUT
        event_part = F.col("row_time") < EVENT_CUT
        some_orders = orders.where(order_part) if first else delete_rows(orders, order_part)
        some_events = events.where(event_part) if first else delete_rows(events, event_part)
        return (
            envelope_of(some_orders, "orders", "order_id", F.col("order_id"), F.col("order_timestamp"))
            .unionByName(
                envelope_of(some_events, "customers", "customer_id", F.col("event_id"), F.col("row_time"))
            )
            .unionByName(envelope_of(book_rows, "books", "book_id", F.col("book_id"), F.col("updated")))
        )

    return [batch(True, books(t)), batch(False, book_updates(t))]
