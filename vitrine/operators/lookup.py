"""Lookups: a table whose row count is measured once, broadcast when small, joined by a shuffle beyond."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows up to which a lookup is copied to every executor (some tens of bytes a row)
BROADCAST_ROWS = 200_000


def size_checked(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`table` with a broadcast hint if it holds at most `rows` rows, else as it is.

    Counting stops after `rows` + 1 rows.  Give it a table that is cheap to read
    (checkpointed or stored): the count is one job.
    """
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table
