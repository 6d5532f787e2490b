import datetime
import random

import pytest
from pyspark.sql import functions as F

from postlytics.operators import view


def test_missing_country_is_a_group(spark):
    df = spark.createDataFrame(
        [(None, "Small", "t"), (None, "Small", "t"), ("DE", "Small", "t")], "country string, follower_group string, label string"
    )
    got = {r.region: r["count"] for r in view.topic_counts(df).collect()}
    assert got == {None: 2, "DE": 1}


def test_minutes_are_stamped_with_their_end(spark):
    df = spark.createDataFrame([(s,) for s in (0, 59, 60)], "s long").select(
        F.timestamp_seconds("s").alias("ts"), F.lit("DE").alias("country"),
        F.lit("Small").alias("follower_group"), F.lit("t").alias("label"),
    )
    got = {r.t: r["count"] for r in view.topic_view(df).withColumn("t", F.unix_seconds("ts")).collect()}
    assert got == {60: 2, 120: 1}


def terciles(values):
    """Thirds by rank from 1: the cut ranks n // 3 and 2n // 3 open the next third."""
    ordered, n = sorted(values), len(values)
    groups = {}
    for rank, value in enumerate(ordered, 1):
        name = "big" if rank >= n * 2 // 3 else "medium" if rank >= n // 3 else "small"
        groups.setdefault(name, []).append(value)
    return {k: (len(v), sum(v) / len(v), v[0], v[-1]) for k, v in groups.items()}


@pytest.mark.parametrize("values", [
    [5], [5, 5], [1, 2, 3], [7] * 10, list(range(10)), [0, 2**31 - 1, 16384, 16383, 16385, 5],
    [random.Random(1).randint(0, 40) for _ in range(200)],
    [random.Random(2).randint(0, 10**6) for _ in range(500)] + [77] * 250,
])
def test_terciles_equal_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "followers long")
    got = {r.tercile: (r.n, r.average, r.lowest, r.highest) for r in view.follower_terciles(df).collect()}
    assert got == {k: (n, pytest.approx(a), lo, hi) for k, (n, a, lo, hi) in terciles(values).items()}


def test_counts_by_location(spark):
    df = spark.createDataFrame([((1.5, 2.0),), (None,), (None,)], "location struct<latitude double, longitude double>")
    got = {r.location: r["count"] for r in view.counts_by(df, view.location_text(F.col("location")), "location").collect()}
    assert got == {"1.5,2.0": 1, "null": 2}


def test_timestamps_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    row = spark.sql("SELECT timestamp_seconds(0) AS t").select(F.date_format("t", "HH")).first()
    assert row[0] == "00" and datetime.datetime.fromtimestamp(0, datetime.timezone.utc).hour == 0
