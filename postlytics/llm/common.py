"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postlytics.session import shared_root, workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its texts will pass to Python in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as a string, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hex_digest(value: Column) -> Column:
    """Lowercase hex SHA-256 of a string in UTF-8."""
    return F.sha2(value, 256)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Rows written as Parquet in the shared folder and read back.

    Cuts the lineage, survives the loss of executors, and keeps a result that is used more than
    once from being computed again.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for the small state of an iteration."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


# Rows that the JVM hands to Python at once; Spark's default of 10,000 is meant for short rows.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Keep batches of whole texts small, unless the session already has smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name, "10000")) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def in_slices(column: pa.Array, rows: int = 256) -> Iterator[list]:
    """Python values of a column, few rows at a time, so that long texts are not all held twice."""
    for start in range(0, len(column), rows):
        yield column.slice(start, rows).to_pylist()


# Tables that an operator keeps in a Python worker: key to (task that used it last, table).
_TABLES: dict[str, tuple[int, object]] = {}


def _task() -> int:
    context = TaskContext.get()
    return context.taskAttemptId() if context else -1


def worker_table(key: str, build: Callable[[], object]):
    """A table that is built once per Python worker and kept for its later tasks of the operator."""
    table = _TABLES[key][1] if key in _TABLES else build()
    _TABLES[key] = (_task(), table)
    return table


def drop_unused_tables() -> None:
    """Forget the tables that earlier tasks left; a worker outlives a stage and serves the next one."""
    now = _task()
    for key in [key for key, (task, _) in _TABLES.items() if task != now]:
        del _TABLES[key]


def text_function(row: Callable[[str | None], object], kind: T.DataType, once: bool = False):
    """A column function that gives one value of the kind for every text, whatever its length.

    `once` keeps the optimizer from copying the call, as it does into a filter on its result.
    """

    small_batches(SparkSession.active())

    @F.arrow_udf(kind)
    def apply(text: pa.Array) -> pa.Array:
        drop_unused_tables()
        arrow = to_arrow_type(kind)
        parts = [pa.array([row(value) for value in values], arrow) for values in in_slices(text)]
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return apply.asNondeterministic() if once else apply


# bytes A-Z to a-z; all others, and so every other character of UTF-8, stay
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def most_frequent(counts: DataFrame, number: str, most: int) -> DataFrame:
    """At most `most` rows, those with the largest numbers (1 or more); all rows where they fit.

    Rows above a bound are taken, which a histogram of some hundred bins finds: no sort, no task or
    driver sees more than a bin's size.
    """
    binned = counts.withColumn("bin", F.floor(F.log2(number) * 16))
    lowest, taken = None, 0
    for bin_, size in binned.groupBy("bin").count().orderBy(F.desc("bin")).collect():
        taken += size
        if taken > most:
            break
        lowest = bin_
    return binned.filter(F.lit(False) if lowest is None else F.col("bin") >= lowest).drop("bin")
