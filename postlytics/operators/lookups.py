"""Lookup tables that are broadcast only after their size was measured."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(table: DataFrame, max_rows: int) -> DataFrame:
    """`table` marked for broadcast when it has at most `max_rows` rows, else unchanged.

    A larger table is joined as any other, where adaptive execution splits skewed partitions.
    The counted rows are kept, so counting does not compute the table twice.
    """
    kept = table.persist(StorageLevel.MEMORY_AND_DISK)
    if kept.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(kept)
    kept.unpersist()
    return table
