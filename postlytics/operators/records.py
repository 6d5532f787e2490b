"""Raw statuses, records and their JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics import schemas
from postlytics.functions.records import (
    country,
    follower_group,
    geo_point,
    geo_polygon,
    iso_date,
    parse_date,
)
from postlytics.settings import DEFAULTS, Settings


def lower_tags(hashtags: Column) -> Column:
    """Lowercase tags; a missing list is an empty one."""
    return F.transform(F.coalesce(hashtags, F.array().cast("array<string>")), lambda t: F.lower(t))


def statuses_to_records(statuses: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Statuses as landed (`schemas.STATUS`) to records (`schemas.RECORD`) plus `source_id`."""
    place = F.col("place")
    record_place = F.when(
        place.isNotNull(),
        F.struct(
            place["name"].alias("name"),
            place["street_address"].alias("streetAddress"),
            place["country_code"].alias("countryCode"),
            place["id"].alias("id"),
            place["country"].alias("country"),
            place["place_type"].alias("placeType"),
            place["url"].alias("uRL"),
            place["full_name"].alias("fullName"),
            place["bounding_box_type"].alias("boundingBoxType"),
            geo_polygon(place["bounding_box"]).alias("boundingBoxCoordinates"),
            place["geometry_type"].alias("geometryType"),
            geo_polygon(place["geometry"]).alias("geometryCoordinates"),
        ),
    )
    return statuses.select(
        F.col("id").alias("source_id"),
        "text",
        F.transform("entities.hashtags", lambda h: h["text"]).alias("hashtagList"),
        F.lit(None).cast("array<string>").alias("cleanedWords"),
        iso_date(parse_date(F.col("created_at"))).alias("creationDate"),
        F.col("lang").alias("language"),
        F.lit(None).cast("string").alias("topic"),
        geo_point(F.col("coordinates")[0], F.col("coordinates")[1]).alias("location"),
        record_place.alias("place"),
        follower_group(F.col("user.followers_count"), settings).alias("followerGroup"),
    )


def record_json() -> Column:
    """The record columns of the current row as one JSON text; nulls are left out."""
    return F.to_json(F.struct(*schemas.RECORD.fieldNames()))


# reasons of the quarantine table
NO_JSON, NO_DATE, FUTURE = "json", "date", "future"


def parse_messages(messages: DataFrame, latest: Column | None = None) -> DataFrame:
    """Adds `record`, `reason` and `bad`.

    Texts that are no JSON object keep a null record. A message is bad for that reason, when its
    date is given but fits no pattern, or, if `latest` is given, when its date lies after it.
    """
    corrupt = "_corrupt"
    schema = T.StructType([*schemas.RECORD.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )
    created = F.col("_parsed.creationDate")
    date = parse_date(created)
    reason = F.when(F.col("_parsed").isNull() | F.col(f"_parsed.{corrupt}").isNotNull(), NO_JSON).when(
        created.isNotNull() & date.isNull(), NO_DATE
    )
    if latest is not None:
        reason = reason.when(date > latest, FUTURE)
    return (
        messages.withColumn("_parsed", parsed)
        .select(*messages.columns, F.col("_parsed").alias("record"), reason.alias("reason"))
        .withColumn("bad", F.col("reason").isNotNull())
    )


def good_posts(parsed: DataFrame, *carry: str) -> DataFrame:
    """Parsed messages to posts: key, text, tags, ts, sec, language, country, follower_group."""
    ts = parse_date(F.col("record.creationDate"))
    return parsed.filter(~F.col("bad")).select(
        "key",
        *carry,
        F.col("record.text").alias("text"),
        F.col("record.language").alias("language"),
        lower_tags(F.col("record.hashtagList")).alias("tags"),
        ts.alias("ts"),
        F.unix_seconds(ts).alias("sec"),
        country(F.col("record.place")).alias("country"),
        F.col("record.followerGroup").alias("follower_group"),
    )


def bad_messages(parsed: DataFrame) -> DataFrame:
    """Messages for the quarantine table, each with its reason."""
    return parsed.filter("bad").select("key", "value", "reason")
