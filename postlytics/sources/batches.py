"""Writes of micro-batches that a replayed batch repeats without doubling rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write rows as the batch's own partitions, replacing what an earlier try left there.

    An empty batch writes nothing. Rows never pass through the driver. Texts are most of what is
    written, so files are compressed with zstd.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )
