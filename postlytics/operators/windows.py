"""Sliding sums over one-second buckets (A1-A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlytics.settings import DEFAULTS, Settings


def second_buckets(events: DataFrame, *keys: str | Column) -> DataFrame:
    """Count rows per (keys.., sec)."""
    return events.groupBy(*keys, "sec").agg(F.count(F.lit(1)).alias("n"))


def sliding_sum(buckets: DataFrame, *keys: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Replace `n` of each bucket by the sum over the window that ends with its second.

    `buckets` holds at most one row per (keys.., sec). The window at second s covers
    s - window_seconds + 1 .. s; its end is s + 1.

    Time is cut into chunks and the last window of a chunk is repeated in the next one, so each
    window task sorts at most twice chunk_seconds + window_seconds rows per key, however hot the
    key and however long the history. With no keys the chunks alone spread the work.

    Within a chunk each bucket adds its n at its second and takes it away when it leaves the
    window, so the running sum is the window's: linear work, also where every second is filled.
    """
    size, chunk = settings.window_seconds, settings.chunk_seconds
    if chunk < size:
        raise ValueError("chunk_seconds must be at least window_seconds")
    sec = F.col("sec")
    here = F.struct(F.floor(sec / chunk).alias("chunk"), F.lit(True).alias("own"))
    next_ = F.struct((F.floor(sec / chunk) + 1).alias("chunk"), F.lit(False).alias("own"))
    needed_later = F.pmod(sec, F.lit(chunk)) > chunk - size
    places = F.when(needed_later, F.array(here, next_)).otherwise(F.array(here))
    placed = (
        buckets.select(*keys, "sec", "n", F.explode(places).alias("place"))
        .select(*keys, "place.chunk", "sec", "n", "place.own")
        .repartition(*keys, "chunk")
    )
    enters = F.struct(sec.alias("at"), F.col("n").alias("change"), F.col("own").alias("own"))
    leaves = F.struct((sec + size).alias("at"), (-F.col("n")).alias("change"), F.lit(False).alias("own"))
    until_now = (
        Window.partitionBy(*keys, "chunk").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    )
    return (
        placed.select(*keys, "chunk", F.explode(F.array(enters, leaves)).alias("step"))
        .select(*keys, "chunk", "step.*")
        .select(*keys, F.col("at").alias("sec"), F.sum("change").over(until_now).alias("n"), "own")
        .filter("own")
        .drop("own")
    )
