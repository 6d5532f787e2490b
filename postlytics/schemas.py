"""Row shapes on the wire and in the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
POLYGON = T.ArrayType(T.ArrayType(LOCATION))

# fixed values: field names of the message format, odd spelling of uRL included
PLACE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("streetAddress", T.StringType()),
    T.StructField("countryCode", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("placeType", T.StringType()),
    T.StructField("uRL", T.StringType()),
    T.StructField("fullName", T.StringType()),
    T.StructField("boundingBoxType", T.StringType()),
    T.StructField("boundingBoxCoordinates", POLYGON),
    T.StructField("geometryType", T.StringType()),
    T.StructField("geometryCoordinates", POLYGON),
])

RECORD = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("hashtagList", T.ArrayType(T.StringType())),
    T.StructField("cleanedWords", T.ArrayType(T.StringType())),
    T.StructField("creationDate", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("location", LOCATION),
    T.StructField("place", PLACE),
    T.StructField("followerGroup", T.StringType()),
])

# a status as the landing job writes it: coordinates are arrays of [latitude, longitude]
COORDINATE = T.ArrayType(T.DoubleType())
STATUS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("entities", T.StructType([
        T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    ])),
    T.StructField("coordinates", COORDINATE),
    T.StructField("place", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("street_address", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("place_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("bounding_box_type", T.StringType()),
        T.StructField("bounding_box", T.ArrayType(T.ArrayType(COORDINATE))),
        T.StructField("geometry_type", T.StringType()),
        T.StructField("geometry", T.ArrayType(T.ArrayType(COORDINATE))),
    ])),
    T.StructField("user", T.StructType([T.StructField("followers_count", T.LongType())])),
])

MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

BUCKETS = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("sec", T.LongType()),
    T.StructField("n", T.LongType()),
])

WORD_TOPICS = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("topic", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
])

TOPICS = T.StructType([
    T.StructField("topic", T.IntegerType()),
    T.StructField("label", T.StringType()),
])

CORPUS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("words", T.ArrayType(T.StringType())),
    T.StructField("ingested_ms", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

# `row` numbers the messages of one micro-batch
VIEW = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("follower_group", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

ASSIGNED = T.StructType([
    T.StructField("row", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("country", T.StringType()),
    T.StructField("follower_group", T.StringType()),
    T.StructField("match_kind", T.StringType()),
    T.StructField("topic", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
