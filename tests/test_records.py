import json

import pytest
from pyspark.sql import functions as F

from postlytics.functions.records import follower_group, geo_polygon, message_key, parse_date
from postlytics.operators.records import bad_messages, good_posts, parse_messages
from postlytics.sources.streams import to_messages


def messages(spark, *values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")


def test_bad_json_goes_to_quarantine(spark):
    good = json.dumps({"text": "x", "hashtagList": ["A"], "creationDate": "2024-01-01T00:00:05Z"})
    parsed = parse_messages(messages(spark, good, "no json", '{"text": ', "", None))
    assert [r.key for r in good_posts(parsed).collect()] == ["0"]
    assert sorted(r.key for r in bad_messages(parsed).collect()) == ["1", "2", "3", "4"]


def test_bad_and_future_dates_go_to_quarantine_with_a_reason(spark):
    dates = ["2024-01-01T00:00:05Z", "yesterday", "2999-01-01T00:00:00Z", None]
    values = [json.dumps({"text": "x"} | ({"creationDate": d} if d else {})) for d in dates]
    parsed = parse_messages(messages(spark, *values, "no json"), F.lit("2900-01-01").cast("timestamp"))
    assert [r.key for r in good_posts(parsed).collect()] == ["0", "3"]
    assert {r.key: r.reason for r in bad_messages(parsed).collect()} == {"1": "date", "2": "future", "4": "json"}


def test_unknown_followers_have_no_group(spark):
    rows = spark.createDataFrame([(None,), (300,)], "n long").select(follower_group(F.col("n")).alias("g")).collect()
    assert [r.g for r in rows] == [None, "Small"]


def test_missing_fields_are_null_and_tags_empty(spark):
    [row] = good_posts(parse_messages(messages(spark, '{"text":"x"}'))).collect()
    assert row.tags == []
    assert (row.country, row.ts, row.follower_group) == (None, None, None)


def test_place_without_country(spark):
    [row] = good_posts(parse_messages(messages(spark, '{"place":{"name":"n"}}'))).collect()
    assert row.country is None


def test_tags_are_lowercased(spark):
    [row] = good_posts(parse_messages(messages(spark, '{"hashtagList":["Maga","MAGA","maga"]}'))).collect()
    assert row.tags == ["maga"] * 3


@pytest.mark.parametrize("text", [
    "Jan 1, 2024 12:00:05 AM",
    "Jan 1, 2024, 12:00:05 AM",
    "2024-01-01T00:00:05Z",
    "2024-01-01T00:00:05.000Z",
    "2024-01-01T01:00:05+01:00",
    "2024-01-01 00:00:05",
    "Mon Jan 01 00:00:05 +0000 2024",
])
def test_date_patterns(spark, text):
    row = spark.createDataFrame([(text,)], "d string").select(F.unix_seconds(parse_date(F.col("d")))).first()
    assert row[0] == 1704067205


def test_unknown_date_is_null(spark):
    assert spark.createDataFrame([("soon",)], "d string").select(parse_date(F.col("d"))).first()[0] is None


def test_follower_edges(spark):
    df = spark.createDataFrame([(n,) for n in (0, 300, 301, 1800, 1801)], "n long")
    assert [r[0] for r in df.select(follower_group(F.col("n"))).collect()] == [
        "Small", "Small", "Medium", "Medium", "Large"]


def test_polygon_keeps_null(spark):
    df = spark.createDataFrame([([[[1.0, 2.0]]],), (None,)], "r array<array<array<double>>>")
    first, second = df.select(geo_polygon(F.col("r")).alias("p")).collect()
    assert (first.p[0][0].latitude, first.p[0][0].longitude) == (1.0, 2.0)
    assert second.p is None


def test_message_key(spark):
    df = spark.createDataFrame([("v", 7), ("v", None)], "value string, id long")
    with_id, without = (r[0] for r in df.select(message_key(F.col("value"), F.col("id"))).collect())
    assert with_id == "7"
    assert len(without) == 64


def test_nulls_are_left_out_of_messages(spark):
    parsed = parse_messages(messages(spark, '{"text":"x","hashtagList":["A"]}'))
    [row] = to_messages(parsed.select("record.*")).collect()
    assert json.loads(row.value) == {"text": "x", "hashtagList": ["A"]}
