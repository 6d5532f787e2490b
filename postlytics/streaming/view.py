"""The minute view as a stream over assigned posts, and what came too late for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from postlytics import schemas
from postlytics.operators.view import topic_view
from postlytics.session import folder_names
from postlytics.settings import DEFAULTS, Settings
from postlytics.sources.batches import write_batch


def read_assigned(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.schema(schemas.ASSIGNED).options(**options).parquet(path)


def minute_view(assigned: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Closed flush intervals; each is emitted once, when the watermark has passed its end.

    A batch that the writer of `assigned` had to repeat may be read twice; its rows, known by
    batch and number, are dropped the second time.
    """
    timed = assigned.withWatermark("ts", settings.watermark)
    once = timed.dropDuplicatesWithinWatermark(["batch_id", "row"])
    return topic_view(once, "label", settings)


def view_writer(
    view: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """`sink(rows, batch_id)` stores each batch, such as `write_batch` or `append_view`."""
    return (
        view.writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )


def closed_counts(assigned: DataFrame, shown: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The view of all stored posts, late ones included, for the intervals the stream has closed.

    The stream emits all intervals that its watermark has passed at once, so those up to the latest
    in `shown` are closed, however far the stream is behind the stored posts. Rows that a repeated
    batch stored twice count once.
    """
    whole = topic_view(assigned.dropDuplicates(["batch_id", "row"]), "label", settings)
    return whole.filter(F.col("ts") <= shown.agg(F.max("ts")).scalar())


def late_corrections(assigned: DataFrame, shown: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows (ts, region, follower_group, topic, count) that bring the shown view up to date.

    `shown` holds what the stream emitted and earlier corrections. Both sides are counts per view
    row, so the posts themselves are shuffled as partial counts only; both may be cut to a range of
    time before. Added to `shown` and summed, the rows give what a batch run counts.
    """
    columns = ("ts", "region", "follower_group", "topic")
    whole = closed_counts(assigned, shown, settings).select(*columns, "count")
    both = whole.unionByName(shown.select(*columns, (-F.col("count")).alias("count")))
    return both.groupBy(*columns).agg(F.sum("count").alias("count")).filter("count > 0")


def late_counts(assigned: DataFrame, shown: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(ts, posts, shown, late) of the closed intervals: all posts, those in the view, those that came too late."""
    whole = closed_counts(assigned, shown, settings)
    whole = whole.select("ts", F.col("count").alias("posts"), F.lit(0).alias("shown"))
    seen = shown.select("ts", F.lit(0).alias("posts"), F.col("count").alias("shown"))
    total = lambda name: F.sum(name).cast("long").alias(name)
    counts = whole.unionByName(seen).groupBy("ts").agg(total("posts"), total("shown"))
    return counts.withColumn("late", F.col("posts") - F.col("shown"))


def mend_view(spark: SparkSession, assigned: str, view: str, settings: Settings = DEFAULTS) -> None:
    """Add the corrections for late posts to a view stored by `write_batch`, under numbers below zero.

    Readers sum the counts of a view row. A run that is repeated finds nothing left to add, and the
    view's stream may go on meanwhile; two such runs must not overlap.
    """
    names = folder_names(spark, view)
    numbers = [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]
    if numbers:
        stored = spark.read.schema(schemas.ASSIGNED).parquet(assigned)
        shown = spark.read.schema(schemas.VIEW).parquet(view)
        write_batch(late_corrections(stored, shown, settings), view, min(*numbers, 0) - 1)
