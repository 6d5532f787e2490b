"""The relational view table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the view table's name.
VIEW_TABLE = "topics"


def view_rows(view: DataFrame) -> DataFrame:
    """The table's five columns in insert order; counts become 32-bit integers here only."""
    return view.select(
        F.col("ts").alias("timeStamp"),
        "region",
        F.col("follower_group").alias("followerGroup"),
        "topic",
        F.col("count").cast("int").alias("count"),
    )


def append_view(
    view: DataFrame, fmt: str = "jdbc", batch_size: int = 1000, **options: str
) -> None:
    """Append view rows with batched inserts.

    The caller names url, driver, user and password as options; none has a default. Other
    formats take their own options, such as `path`.
    """
    if fmt == "jdbc":
        options = {"dbtable": VIEW_TABLE, "batchsize": str(batch_size), **options}
    view_rows(view).write.format(fmt).mode("append").options(**options).save()
