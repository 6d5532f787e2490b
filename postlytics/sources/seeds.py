"""Seed hashtags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_seed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """`tag#tag#..` lines to distinct lowercase tags; byte-order mark and blanks are dropped."""
    text = F.lower(F.regexp_replace(column, "\ufeff", ""))
    return (
        lines.select(F.explode(F.split(text, "#")).alias("tag"))
        .filter(F.trim("tag") != "")
        .distinct()
    )


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return parse_seed_lines(spark.read.text(path))
