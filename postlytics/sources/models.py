"""Published topic models: one folder per version and a table of version numbers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postlytics import schemas
from postlytics.operators.topics import require_single_weights, topic_labels
from postlytics.settings import DEFAULTS
from postlytics.sources.versions import announce, current_version


@dataclass(frozen=True)
class Model:
    version: int
    word_topics: DataFrame
    topics: DataFrame


def publish(word_topics: DataFrame, root: str, words_per_topic: int = DEFAULTS.words_per_topic) -> int:
    """Replace both tables: write them under a new version, then announce it.

    The labels come from the weights as stored, which are then not computed twice, and the
    guards read the same rows that readers will. Readers see the old pair until the last step
    and never an empty or mixed one. A run that dies before it leaves an unannounced folder that
    the next run overwrites.
    """
    spark = word_topics.sparkSession
    version = (current_version(spark, root) or 0) + 1
    folder = f"{root}/version={version}"
    columns = schemas.WORD_TOPICS.fieldNames()
    word_topics.select(*columns).write.mode("overwrite").parquet(f"{folder}/word_topics")
    stored = spark.read.schema(schemas.WORD_TOPICS).parquet(f"{folder}/word_topics")
    require_single_weights(stored)
    labels = topic_labels(stored, words_per_topic).select(*schemas.TOPICS.fieldNames())
    labels.coalesce(1).write.mode("overwrite").parquet(f"{folder}/topics")
    announce(spark, root, version)
    return version


def load(spark: SparkSession, root: str, version: int | None = None) -> Model | None:
    """The announced model, or None before the first."""
    version = version or current_version(spark, root)
    if version is None:
        return None
    folder = f"{root}/version={version}"
    return Model(
        version,
        spark.read.schema(schemas.WORD_TOPICS).parquet(f"{folder}/word_topics"),
        spark.read.schema(schemas.TOPICS).parquet(f"{folder}/topics"),
    )
