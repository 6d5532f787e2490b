"""Batch reads of stored collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """A collection by path, or by the options of a connector such as `mongodb`."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def scan_spread(spark: SparkSession, path: str, key: str, *columns: str) -> DataFrame:
    """Columns of a stored table, dealt out evenly by a unique key, for tables derived once.

    A file may be one row group, whatever its size, and one task would then do all later text work.
    The number of parts follows the session's shuffle partitions and the bytes dealt.
    """
    return scan(spark, path).select(*columns).repartition(F.col(key))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(collection, documents) of each table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("documents")).select(F.lit(name).alias("collection"), "documents")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
