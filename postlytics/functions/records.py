"""Column expressions on posts: geo, follower bucket, dates, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlytics.settings import DEFAULTS, Settings

# Names of the follower buckets.
SMALL, MEDIUM, LARGE = "Small", "Medium", "Large"

# How message producers print dates. The first is what our own
# jobs write, the next two come from Java's default locale pattern before and after JDK 9, the last from the status feed (its weekday is cut off first).
DATE_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]",
    "MMM d, yyyy h:mm:ss a",
    "MMM d, yyyy, h:mm:ss a",
    "yyyy-MM-dd HH:mm:ss[.SSS]",
    "MMM dd HH:mm:ss Z yyyy",
)


def follower_group(followers: Column, settings: Settings = DEFAULTS) -> Column:
    """The bucket of a follower count; null for an unknown one."""
    return (
        F.when(followers.isNull(), F.lit(None).cast("string"))
        .when(followers <= settings.small_max_followers, SMALL)
        .when(followers <= settings.medium_max_followers, MEDIUM)
        .otherwise(LARGE)
    )


def geo_point(latitude: Column, longitude: Column) -> Column:
    """A location, or null when either coordinate is missing."""
    return F.when(
        latitude.isNotNull() & longitude.isNotNull(),
        F.struct(latitude.cast("double").alias("latitude"), longitude.cast("double").alias("longitude")),
    )


def geo_polygon(rings: Column) -> Column:
    """Rings of [latitude, longitude] pairs to rings of locations; null stays null."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda c: geo_point(c[0], c[1])))


def country(place: Column) -> Column:
    return place["country"]


def parse_date(text: Column) -> Column:
    """First pattern that fits; null when none does."""
    without_weekday = F.regexp_replace(text, r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) ", "")
    return F.coalesce(*[F.try_to_timestamp(without_weekday, F.lit(p)) for p in DATE_PATTERNS])


def iso_date(ts: Column) -> Column:
    """ISO-8601 in UTC, whatever the session's time zone is."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def message_key(value: Column, source_id: Column | None = None) -> Column:
    """Key of a message: the id the source gave it, else a hash of its content.

    A running number would need one counter for all tasks. Content hashes are equal for equal
    messages, so only source ids may serve where keys have to be unique.
    """
    digest = F.sha2(value, 256)
    return digest if source_id is None else F.coalesce(source_id.cast("string"), digest)
