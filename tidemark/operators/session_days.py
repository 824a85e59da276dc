"""Sessions as counted rows: one per customer, day, device and number of pages.

Every signal of sessions is computed from such rows, so that a table of them,
kept once, serves the matrix and the label of any number of dates in place of the
sessions. Sessions themselves pass as rows that count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.columns import aggregate

KEYS = ["customer_id", "session_date", "device", "pages_viewed"]
#: How many sessions a row stands for, and the highest of their ids.
COUNTS = {"n": "sum(n)", "last_id": "max(last_id)"}


def counted_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions, or rows of ``session_days``, as counted rows."""
    if "n" in sessions.columns:
        return sessions.select(*KEYS, *COUNTS)
    return sessions.selectExpr(*KEYS, "1L AS n", "session_id AS last_id")


def session_days(sessions: DataFrame) -> DataFrame:
    """Equal sessions of a customer and day as one row with their number."""
    return aggregate(counted_sessions(sessions), KEYS, COUNTS)
