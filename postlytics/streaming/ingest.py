"""Landed statuses to messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics import schemas
from postlytics.operators.promotion import ingest_columns
from postlytics.operators.records import lower_tags, statuses_to_records
from postlytics.operators.tags import TagList, tracked
from postlytics.settings import DEFAULTS, Settings
from postlytics.sources.streams import to_messages


def read_statuses(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A stream over JSON statuses as the landing job writes them."""
    return spark.readStream.schema(schemas.STATUS).options(**options).json(path)


def ingest(statuses: DataFrame, seeds: TagList, settings: Settings = DEFAULTS) -> DataFrame:
    """Tracked statuses as (key, value).

    The counters appear in the query's progress as observed metrics named `ingest`.
    """
    records = statuses_to_records(statuses, settings).withColumn("tags", lower_tags(F.col("hashtagList")))
    kept = tracked(records, seeds, settings).observe("ingest", *ingest_columns())
    return to_messages(kept, F.col("source_id"))
