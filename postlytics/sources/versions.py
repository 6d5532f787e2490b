"""Announced versions: a table of numbers, whose largest one is current."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from postlytics.session import path_exists


def current_version(spark: SparkSession, root: str) -> int | None:
    if not path_exists(spark, f"{root}/versions"):
        return None
    return spark.read.schema("version long").parquet(f"{root}/versions").agg(F.max("version")).first()[0]


def announce(spark: SparkSession, root: str, version: int) -> None:
    """Make a version current, as the last step of writing it."""
    announced = spark.createDataFrame([(version,)], "version long").coalesce(1)
    announced.write.mode("append").parquet(f"{root}/versions")
