"""One-second buckets kept between micro-batches.

Two forms. A bucket table keeps all history: every batch adds its partial counts and readers add
them up, so there is no state store, late rows simply land in their second, and a replayed batch
replaces its own rows. A window state keeps only what the next batch can look back to, as one
small folder per batch, so that a batch reads a single folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from postlytics.operators.windows import second_buckets
from postlytics.session import delete_path, folder_names
from postlytics.sources.batches import write_batch

_DAY = 86_400
_COUNTS = [T.StructField("sec", T.LongType()), T.StructField("n", T.LongType())]
_TAG = T.StructField("tag", T.StringType())


def add_buckets(buckets: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch's buckets to the table, one folder per day of event time.

    The rebalance hint writes few files per day and still splits a day that holds most rows.
    """
    days = buckets.withColumn("day", F.floor(F.col("sec") / _DAY)).hint("rebalance", "day")
    write_batch(days, path, batch_id, "day")


def read_buckets(
    spark: SparkSession, path: str, first_sec: int | None = None, last_sec: int | None = None
) -> DataFrame:
    """Merged (tag, sec, n) of a time range; day folders outside it are not read."""
    days = [T.StructField("day", T.LongType()), T.StructField("batch_id", T.LongType())]
    rows = spark.read.schema(T.StructType([_TAG, *_COUNTS, *days])).parquet(path)
    if first_sec is not None:
        rows = rows.filter((F.col("day") >= first_sec // _DAY) & (F.col("sec") >= first_sec))
    if last_sec is not None:
        rows = rows.filter((F.col("day") <= last_sec // _DAY) & (F.col("sec") <= last_sec))
    return rows.groupBy("tag", "sec").agg(F.sum("n").alias("n"))


def bucket_writer(events: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream of (tag, sec) rows to a bucket table."""

    def add(batch: DataFrame, batch_id: int) -> None:
        add_buckets(second_buckets(batch, "tag"), path, batch_id)

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


class WindowState:
    """Buckets of the last window, one folder per batch; `keys` are `tag`, `sec` or `sec` alone."""

    def __init__(self, spark: SparkSession, path: str, *keys: str) -> None:
        self.spark, self.path, self.keys = spark, path, keys

    def _batches(self) -> list[int]:
        names = folder_names(self.spark, self.path)
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def before(self, batch_id: int) -> DataFrame:
        """What the batch before left; empty for the first."""
        schema = T.StructType([_TAG, *_COUNTS] if "tag" in self.keys else _COUNTS)
        earlier = [b for b in self._batches() if b < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch={earlier[-1]}")

    def save(self, merged: DataFrame, batch_id: int, after_sec: int) -> None:
        """Store the buckets later than `after_sec` for the next batch."""
        recent = merged.filter((F.col("sec") > after_sec) & (F.col("n") > 0))
        recent.select(*self.keys, "n").write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def forget(self, batch_id: int) -> None:
        """Delete folders that neither the next batch nor a repeat of this one reads."""
        earlier = [b for b in self._batches() if b < batch_id]
        for old in earlier[:-1]:
            delete_path(self.spark, f"{self.path}/batch={old}")
