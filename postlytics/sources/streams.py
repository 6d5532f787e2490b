"""Message streams in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from postlytics import schemas
from postlytics.functions.records import message_key
from postlytics.operators.records import record_json


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """A stream of (key string, value string).

    From Kafka the key is topic-partition-offset, which no two messages share; a producer's own
    keys may repeat. Give `subscribe` and `kafka.bootstrap.servers` as options. File formats
    read `schemas.MESSAGE`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
        return reader.load().select(place.alias("key"), F.col("value").cast("string").alias("value"))
    return reader.schema(schema or schemas.MESSAGE).load(path)


def to_messages(records: DataFrame, source_id: Column | None = None) -> DataFrame:
    """Records to (key, value)."""
    messages = records.select(
        (F.lit(None) if source_id is None else source_id).alias("source_id"),
        record_json().alias("value"),
    )
    return messages.select(message_key(F.col("value"), F.col("source_id")).alias("key"), "value")


# Delivery settings of the message producer.
KAFKA_PRODUCER = {
    "kafka.acks": "all",
    "kafka.retries": "0",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "1",
    "kafka.buffer.memory": "33554432",
}


def write_messages(
    messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataStreamWriter:
    """A writer for (key, value); call `start()` on it. Kafka needs `topic` and its servers."""
    if fmt == "kafka":
        options = {**KAFKA_PRODUCER, **options}
    if path:
        options["path"] = path
    return (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
