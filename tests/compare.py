"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter


def _plain(value):
    """Values with their kind; NaN equals NaN but not NULL."""
    if isinstance(value, float):
        return "float", "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return "int", value
    return type(value).__name__, value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, cursor) -> str | None:
    """A description of the first differences, or None."""
    theirs = [c[0] for c in cursor.description]
    ours = spark_df.columns
    if sorted(ours) != sorted(theirs):
        return f"columns differ: {sorted(set(ours) ^ set(theirs))}"
    got = rows_of(ours, [tuple(r) for r in spark_df.collect()])
    want = rows_of(theirs, cursor.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return f"{sum(extra.values())} unexpected {list(extra)[:3]}, {sum(missing.values())} missing {list(missing)[:3]}"
