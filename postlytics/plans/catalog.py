"""Named queries: each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics import schemas
from postlytics.functions import text as words
from postlytics.functions.records import country, geo_polygon, message_key
from postlytics.functions.weights import decode_weights, encode_weights
from postlytics.operators import pairs, promotion, scoring, tags, topics, view, windows
from postlytics.operators.lookups import lookup
from postlytics.operators.records import (
    good_posts,
    parse_messages,
    record_json,
    statuses_to_records,
)
from postlytics.plans import fixtures
from postlytics.session import folder_names, workspace
from postlytics.settings import DEFAULTS
from postlytics.sources import batches, corpus, models, relational, seeds, tables
from postlytics.sources.streams import read_messages, to_messages, write_messages
from postlytics.streaming import control
from postlytics.streaming.buckets import bucket_writer, read_buckets
from postlytics.streaming.ingest import ingest
from postlytics.streaming.pipeline import Pipeline, TopicModel
from postlytics.streaming.progress import FunnelTotals
from postlytics.streaming.view import late_corrections, late_counts, minute_view, read_assigned, view_writer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    in_utc.__doc__ = run.__doc__
    QUERIES[run.__name__] = in_utc
    return in_utc


# --- sources and sinks -------------------------------------------------------------------------


@query
def s3_collection_scan(spark, sf_dir):
    """A stored collection, only the columns in use."""
    rows = fixtures.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", "role", F.length("text").cast("long").alias("length"))


@query
def s4_corpus_append(spark, sf_dir):
    """Two batches of cleaned posts, the second delivered twice."""
    path = workspace(spark, "corpus")
    posts = fixtures.posts(spark, sf_dir).select(
        F.col("post_id").alias("key"),
        words.clean_words(F.col("text")).alias("words"),
        "language",
        "sec",
    )
    english = F.col("language") == "en"
    written_ms = F.col("sec") * 1000
    table = corpus.BatchTable(spark, path, schemas.CORPUS)
    for batch_id, part in ((0, english), (1, ~english), (1, ~english)):
        corpus.append_corpus(posts.filter(part), table, batch_id, written_ms)
    return table.read().select(
        "key",
        F.size("words").cast("long").alias("words"),
        "ingested_ms",
        F.col("batch_id").cast("long").alias("batch_id"),
    )


def _published(spark, sf_dir) -> models.Model:
    root = workspace(spark, "model")
    weights = fixtures.word_topics(spark, sf_dir)
    old = weights.withColumn("weight", F.col("weight") + 1)
    models.publish(old, root, 1)
    models.publish(weights, root)
    return models.load(spark, root)


@query
def s5_word_topics_replace(spark, sf_dir):
    return _published(spark, sf_dir).word_topics


@query
def s6_topics_replace(spark, sf_dir):
    return _published(spark, sf_dir).topics


@query
def s7_view_append(spark, sf_dir):
    """View rows as they go into the relational table, through a file sink."""
    path = workspace(spark, "view")
    posts = tags.with_seed_tag(fixtures.split_posts(spark, sf_dir))
    relational.append_view(view.topic_view(posts, "language"), fmt="parquet", path=path)
    return tables.scan(spark, path).select(
        F.unix_seconds("timeStamp").alias("ts"), "region", "followerGroup", "topic", "count"
    )


@query
def s8_seed_list(spark, sf_dir):
    """Each document's tags as one '#'-separated line, parsed like the seed file."""
    lines = fixtures.posts(spark, sf_dir).select(F.array_join("hashtags", "#").alias("value"))
    return seeds.parse_seed_lines(lines)


@query
def s9_retention(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    rows = events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ingested_ms"))
    return corpus.retain(rows, 3, 1)


def _event_rows(spark, sf_dir) -> DataFrame:
    """Events as corpus rows: key, words and write time."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    events = fixtures.table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("key"), F.array("event_type").alias("words"), millis.alias("ms"))


def _corpus_seen(table: corpus.BatchTable) -> DataFrame:
    return table.read().select(
        F.col("key").cast("long").alias("event_id"), "ingested_ms", F.col("batch_id").cast("long").alias("batch_id")
    )


@query
def s9_corpus_switch(spark, sf_dir):
    """Two batches, a retention that readers apply, a third batch, then what readers see."""
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    events = _event_rows(spark, sf_dir)
    for batch_id in range(3):
        if batch_id == 2:
            table.forget_share(3, 1)
        part = events.filter(F.pmod("key", F.lit(3)) == batch_id)
        corpus.append_corpus(part, table, batch_id, F.col("ms"))
    return _corpus_seen(table)


@query
def s9_tombstones(spark, sf_dir):
    """Retentions between batches; some carried out by compaction, one across its border, one left open.

    A batch that was folded is repeated at the end and changes nothing.
    """
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    events = _event_rows(spark, sf_dir)

    def append(batch_id: int) -> None:
        corpus.append_corpus(events.filter(F.pmod("key", F.lit(5)) == batch_id), table, batch_id, F.col("ms"))

    append(0)
    append(1)
    table.forget_share(3, 1)
    append(2)
    table.forget_share(4, 2)
    table.compact(1)
    append(3)
    table.forget_share(2, 1)
    table.compact(3)
    append(4)
    append(0)
    table.forget_share(5, 3)
    return _corpus_seen(table)


@query
def s9_emptied_corpus(spark, sf_dir):
    """Everything so far is forgotten and folded, and forgotten again; then a batch follows."""
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    events = _event_rows(spark, sf_dir)
    corpus.append_corpus(events.filter("key % 2 = 0"), table, 0, F.col("ms"))
    table.forget_share(1, 0)
    table.compact(0)
    table.forget_share(1, 0)
    before = _corpus_seen(table)
    corpus.append_corpus(events.filter("key % 2 = 1"), table, 1, F.col("ms"))
    return before.unionByName(_corpus_seen(table))


@query
def s4_compaction(spark, sf_dir):
    """Fifty batches, folded twice on the way, one batch repeated after it was folded.

    `folders` counts the batch folders that are left.
    """
    path = workspace(spark, "compacted")
    table = corpus.BatchTable(spark, path, schemas.CORPUS)
    events = _event_rows(spark, sf_dir).persist()
    for batch_id in range(50):
        corpus.append_corpus(events.filter(F.pmod("key", F.lit(50)) == batch_id), table, batch_id, F.col("ms"))
        if batch_id in (19, 39):
            table.compact()
    corpus.append_corpus(events.filter(F.pmod("key", F.lit(50)) == 30), table, 30, F.col("ms"))
    events.unpersist()
    folders = sum(name.startswith("batch_id=") for name in folder_names(spark, path))
    return _corpus_seen(table).withColumn("folders", F.lit(folders).cast("long"))


@query
def s10_row_counts(spark, sf_dir):
    names = ("documents", "conversations", "events", "labels", "nation")
    return tables.row_counts({n: fixtures.table(spark, sf_dir, n) for n in names})


def _landed(spark, posts: DataFrame, path: str) -> None:
    """Posts as message files."""
    records = statuses_to_records(fixtures.statuses_of(posts))
    to_messages(records, F.col("source_id")).write.mode("append").option("compression", "zstd").parquet(path)


@query
def s1_stream_source(spark, sf_dir):
    """Message files read as a stream and parsed."""
    landing, out = workspace(spark, "landing"), workspace(spark, "parsed")
    _landed(spark, fixtures.posts(spark, sf_dir), landing)
    posts = good_posts(parse_messages(read_messages(spark, "parquet", landing)))
    writer = (
        posts.select("key", "language", "sec", "country", "follower_group", F.array_join("tags", " ").alias("tags"))
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-checkpoint")
    )
    control.finish(control.start(writer, once=True))
    return tables.scan(spark, out)


@query
def s2_stream_sink(spark, sf_dir):
    """Documents as a stream of statuses through the ingest job to stored messages."""
    out = workspace(spark, "messages")
    documents = fixtures.stream_table(spark, sf_dir, "documents")
    posts = fixtures.with_country(fixtures.posts_of(documents), fixtures.table(spark, sf_dir, "nation"))
    messages = ingest(fixtures.statuses_of(posts), fixtures.tag_list(spark))
    writer = write_messages(messages, out + "-checkpoint", "parquet", out)
    control.finish(control.start(writer, once=True))
    value = F.col("value")
    return tables.scan(spark, out).select(
        "key",
        F.get_json_object(value, "$.language").alias("language"),
        F.md5(F.get_json_object(value, "$.text")).alias("text_md5"),
    )


# --- streams -----------------------------------------------------------------------------------


@query
def w3_stream_window_counts(spark, sf_dir):
    """Events as a stream into one-second buckets, windows over the bucket table."""
    path = workspace(spark, "buckets")
    events = fixtures.stream_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tag"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec")
    )
    control.finish(control.start(bucket_writer(events, path, path + "-checkpoint"), once=True))
    return windows.sliding_sum(read_buckets(spark, path), "tag")


@query
def w4_stream_feedback(spark, sf_dir):
    """All posts through the stream job, in two deliveries with a restart in between.

    The second delivery needs the first one's buckets to promote the same tags as a batch run.
    """
    root = workspace(spark, "stream")
    model_root = fixtures.model_root(spark, sf_dir)
    posts = fixtures.posts(spark, sf_dir)
    middle = posts.agg(F.avg("sec")).first()[0]
    for part in (F.col("sec") <= middle, F.col("sec") > middle):
        _landed(spark, posts.filter(part), f"{root}/landing")
        job = Pipeline(root, fixtures.tag_list(spark), TopicModel(model_root))
        messages = read_messages(spark, "parquet", f"{root}/landing")
        control.finish(control.start(job.writer(messages), once=True))
    return tables.scan(spark, f"{root}/assigned").select("key", "match_kind", "topic", "label")


@query
def w4_out_of_order(spark, sf_dir):
    """As `w4_stream_feedback`, with a copy of every tenth post dated far ahead before all others.

    The copies go to quarantine; were they let in, they would move the window state past all posts.
    """
    root = workspace(spark, "stream")
    model_root = fixtures.model_root(spark, sf_dir)
    posts = fixtures.posts(spark, sf_dir)
    ahead = posts.filter("post_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 900 YEAR"))
    for part in (ahead, posts):
        _landed(spark, part, f"{root}/landing")
        job = Pipeline(root, fixtures.tag_list(spark), TopicModel(model_root))
        messages = read_messages(spark, "parquet", f"{root}/landing")
        control.finish(control.start(job.writer(messages), once=True))
    return tables.scan(spark, f"{root}/assigned").select("key", "match_kind", "topic", "label")


@query
def w4_wrong_dates(spark, sf_dir):
    """As `w4_stream_feedback`, with copies dated wrongly before, between and after the live posts.

    Copies of every tenth post are dated a day and a year ahead of all posts. Copies of the posts
    without seed tags are dated four minutes ahead, so inside the windows of live posts. None of them
    may change what becomes of the live posts.
    """
    root = workspace(spark, "stream")
    model_root = fixtures.model_root(spark, sf_dir)
    posts = fixtures.posts(spark, sf_dir)
    first, last = posts.agg(F.min("sec"), F.max("sec")).first()
    span = last - first + 1
    seeded = F.exists("tags", lambda t: t.isin(*fixtures.SEEDS))

    def wrong(part: int, seconds: int, which) -> DataFrame:
        later = F.timestamp_seconds(F.col("sec") + seconds)
        return posts.filter(which).withColumns({"ts": later, "post_id": -1 - (F.col("post_id") * 9 + part)})

    def wrongs(part: int) -> DataFrame:
        tenth = F.pmod("post_id", F.lit(30)) == 10 * part
        minutes = wrong(part, 240, ~seeded & (F.pmod("post_id", F.lit(3)) == part))
        day, year = (wrong(part + 3 * k, span + 86_400 * days, tenth) for k, days in ((1, 1), (2, 365)))
        return minutes.unionByName(day).unionByName(year)

    middle = (first + last) // 2
    live = [posts.filter(F.col("sec") <= middle), posts.filter(F.col("sec") > middle)]
    for part in (wrongs(0), live[0], wrongs(1), live[1], wrongs(2)):
        _landed(spark, part, f"{root}/landing")
        job = Pipeline(root, fixtures.tag_list(spark), TopicModel(model_root))
        messages = read_messages(spark, "parquet", f"{root}/landing")
        control.finish(control.start(job.writer(messages), once=True))
    rows = tables.scan(spark, f"{root}/assigned").filter(F.col("key").cast("long") >= 0)
    return rows.select("key", "match_kind", "topic", "label")


@query
def a7_stream_view(spark, sf_dir):
    """The minute view as a stream over what the stream job assigned.

    A last post an hour later closes all minutes before it; its own minute stays open.
    """
    root, out = workspace(spark, "stream"), workspace(spark, "view")
    model_root = fixtures.model_root(spark, sf_dir)
    posts = fixtures.posts(spark, sf_dir)
    last = posts.orderBy(F.desc("sec")).limit(1)
    closing = last.withColumns({
        "ts": F.col("ts") + F.expr("INTERVAL 1 HOUR"), "post_id": F.lit(-1).cast("long"),
        "hashtags": F.array(F.lit(fixtures.SEEDS[0])),
    })
    for part in (posts, closing):
        _landed(spark, part, f"{root}/landing")
        job = Pipeline(root, fixtures.tag_list(spark), TopicModel(model_root))
        messages = read_messages(spark, "parquet", f"{root}/landing")
        control.finish(control.start(job.writer(messages), once=True))
    rows = minute_view(read_assigned(spark, f"{root}/assigned"))
    stream = view_writer(rows, lambda df, batch_id: batches.write_batch(df, out, batch_id), f"{out}-checkpoint")
    control.finish(control.start(stream, once=True))
    view_columns = ("region", "follower_group", "topic", "count")
    return tables.scan(spark, out).select(F.unix_seconds("ts").alias("ts"), *view_columns)


@query
def f8_stream_funnel(spark, sf_dir):
    """Counters of the stream job over all posts in two deliveries, the second job started anew."""
    root = workspace(spark, "stream")
    model_root = fixtures.model_root(spark, sf_dir)
    posts = fixtures.posts(spark, sf_dir)
    middle = posts.agg(F.avg("sec")).first()[0]
    funnel = FunnelTotals()
    for part in (F.col("sec") <= middle, F.col("sec") > middle):
        _landed(spark, posts.filter(part), f"{root}/landing")
        job = Pipeline(root, fixtures.tag_list(spark), TopicModel(model_root), report=funnel)
        messages = read_messages(spark, "parquet", f"{root}/landing")
        control.finish(control.start(job.writer(messages), once=True))
    schema = ", ".join(f"{name} long" for name in funnel.total)
    return spark.createDataFrame([tuple(funnel.total.values())], schema)


def _late_view(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Assigned posts, of which a seventh came too late, and the view that the stream emitted.

    Posts one and two hours after all others close their minutes before the late ones are delivered.
    """
    root, out = workspace(spark, "stream"), workspace(spark, "view")
    marked = promotion.mark_accepted(fixtures.split_posts(spark, sf_dir), key="post_id")
    carried = ("ts", "country", "follower_group", "match_kind")
    rows = _assigned(spark, sf_dir, promotion.accepted(marked), *carried)
    key = F.col("post_id").cast("string").alias("key")
    stored = rows.select(F.col("post_id").alias("row"), key, *carried, "topic", "label").persist()
    late = F.pmod("row", F.lit(7)) == 3
    last = stored.agg(F.max("ts")).first()[0]
    ahead = F.explode(F.sequence(F.lit(1), F.lit(2))).alias("hours")
    closing = stored.limit(1).select("*", ahead).withColumns({
        "row": -F.col("hours").cast("long"), "ts": F.lit(last) + F.make_dt_interval(hours=F.col("hours")),
    }).drop("hours")
    for batch_id, part in enumerate((stored.filter(~late).unionByName(closing), stored.filter(late))):
        batches.write_batch(part, f"{root}/assigned", batch_id)
        emitted = minute_view(read_assigned(spark, f"{root}/assigned"))
        stream = view_writer(emitted, lambda df, number: batches.write_batch(df, out, number), f"{out}-checkpoint")
        control.finish(control.start(stream, once=True))
    stored.unpersist()
    posts = F.col("ts") <= F.lit(last) + F.expr("INTERVAL 1 MINUTE")
    return tables.scan(spark, f"{root}/assigned").filter(posts), tables.scan(spark, out).filter(posts)


@query
def a7_late_rows(spark, sf_dir):
    """Per closed minute: accepted posts, those the stream counted, those that came too late."""
    return late_counts(*_late_view(spark, sf_dir)).withColumn("ts", F.unix_seconds("ts"))


@query
def a7_late_corrections(spark, sf_dir):
    """What the stream emitted with the corrections for late posts added: the batch view again."""
    assigned, shown = _late_view(spark, sf_dir)
    columns = ("ts", "region", "follower_group", "topic")
    both = shown.drop("batch_id").unionByName(late_corrections(assigned, shown))
    mended = both.groupBy(*columns).agg(F.sum("count").alias("count"))
    return mended.withColumn("ts", F.unix_seconds("ts"))


# --- projections -------------------------------------------------------------------------------


@query
def p1_parse_messages(spark, sf_dir):
    """JSON messages, mixed with plain text for posts without a country."""
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    messages = records.select(
        F.col("source_id").cast("string").alias("key"),
        F.when(F.col("place").isNull(), F.col("text")).otherwise(record_json()).alias("value"),
    )
    parsed = parse_messages(messages)
    return parsed.select(
        "key",
        "bad",
        F.col("record.language").alias("language"),
        F.size("record.hashtagList").cast("long").alias("tags"),
        F.col("record.followerGroup").alias("follower_group"),
        F.col("record.creationDate").alias("created"),
    ).withColumn("tags", F.when(~F.col("bad"), F.col("tags")))


@query
def p1_bad_dates(spark, sf_dir):
    """Dates that fit no pattern, dates far ahead and missing dates among good ones."""
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    number = F.col("source_id") % 5
    date = (
        F.when(number == 1, "yesterday")
        .when(number == 2, "2999-01-01T00:00:00Z")
        .when(number == 3, F.lit(None))
        .otherwise(F.col("creationDate"))
    )
    messages = records.withColumn("creationDate", date).select(
        F.col("source_id").cast("string").alias("key"), record_json().alias("value")
    )
    parsed = parse_messages(messages, F.lit("2900-01-01 00:00:00").cast("timestamp"))
    return parsed.select("key", "reason", "bad")


@query
def p1_good_posts(spark, sf_dir):
    """Messages all the way to typed posts."""
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    messages = records.select(F.col("source_id").cast("string").alias("key"), record_json().alias("value"))
    return good_posts(parse_messages(messages)).select(
        "key", "language", "sec", "country", "follower_group", F.array_join("tags", " ").alias("tags")
    )


@query
def p2_record_json(spark, sf_dir):
    """Record fields read back out of the JSON text."""
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    value = records.select("source_id", record_json().alias("value"))
    return value.select(
        F.col("source_id").alias("post_id"),
        F.md5(F.get_json_object("value", "$.text")).alias("text_md5"),
        F.get_json_object("value", "$.language").alias("language"),
        F.get_json_object("value", "$.followerGroup").alias("follower_group"),
        F.get_json_object("value", "$.place.fullName").alias("full_name"),
        F.get_json_object("value", "$.topic").alias("topic"),
    )


@query
def p3_status_record(spark, sf_dir):
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    return records.select(
        F.col("source_id").alias("post_id"),
        F.array_join("hashtagList", " ").alias("hashtags"),
        F.col("creationDate").alias("created"),
        "language",
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
        F.col("place.countryCode").alias("country_code"),
        F.col("followerGroup").alias("follower_group"),
    )


@query
def p4_follower_group(spark, sf_dir):
    return fixtures.posts(spark, sf_dir).select("post_id", "followers", "follower_group")


@query
def p5_polygon_corners(spark, sf_dir):
    """Bounding boxes to one row per corner; posts without a place give none."""
    rings = fixtures.statuses(spark, sf_dir).select(
        F.col("id").alias("post_id"), geo_polygon(F.col("place.bounding_box")).alias("rings")
    )
    corners = rings.select("post_id", F.explode("rings").alias("ring")).select(
        "post_id", F.posexplode("ring").alias("corner", "at")
    )
    return corners.select(
        "post_id",
        F.col("corner").cast("long").alias("corner"),
        F.col("at.latitude").alias("latitude"),
        F.col("at.longitude").alias("longitude"),
    )


@query
def p6_country(spark, sf_dir):
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    return records.select(F.col("source_id").alias("post_id"), country(F.col("place")).alias("country"))


@query
def p7_message_key(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", message_key(F.col("text")).alias("key"))


@query
def p8_column_drop(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").drop("text", "n_chars")


@query
def p9_pair_sides(spark, sf_dir):
    """Pairs counted by their seed side and by their other side."""
    split = fixtures.split_posts(spark, sf_dir)
    sides = {"seed": pairs.seed_tag_buckets(split), "other": pairs.other_tag_buckets(split)}
    counted = [
        side.groupBy("tag").agg(F.sum("n").alias("n")).select(F.lit(name).alias("side"), "tag", "n")
        for name, side in sides.items()
    ]
    return counted[0].unionByName(counted[1])


# --- filters -----------------------------------------------------------------------------------


@query
def f1_seed_membership(spark, sf_dir):
    split = fixtures.split_posts(spark, sf_dir)
    return split.select(
        "post_id",
        F.size("seed_tags").cast("long").alias("seed_tags"),
        F.size("other_tags").cast("long").alias("other_tags"),
    )


@query
def f2_promoted_membership(spark, sf_dir):
    """Tags of each post that are on the list promoted over the whole table."""
    split = fixtures.split_posts(spark, sf_dir)
    hot = tags.TagList.of(promotion.promoted(promotion.overall_shares(split)).select("tag"))
    listed = tags.split_tags(fixtures.posts(spark, sf_dir), hot, "post_id")
    return listed.select("post_id", F.size("seed_tags").cast("long").alias("promoted_tags"))


@query
def f3_with_tags(spark, sf_dir):
    posts = fixtures.posts(spark, sf_dir).filter(tags.has_tags(F.col("tags")))
    return posts.select("post_id", F.size("tags").cast("long").alias("tags"))


@query
def f4_seed_accept(spark, sf_dir):
    accepted = tags.with_seed_tag(fixtures.split_posts(spark, sf_dir))
    return accepted.select("post_id", "language", "follower_group")


@query
def f5_promoted_accept(spark, sf_dir):
    marked = promotion.mark_accepted(fixtures.split_posts(spark, sf_dir), key="post_id")
    return marked.filter("match_kind = 'promoted'").select("post_id", "sec")


@query
def f6_tracked_posts(spark, sf_dir):
    settings = replace(DEFAULTS, tracked_seeds=3)
    kept = tags.tracked(fixtures.posts(spark, sf_dir), fixtures.tag_list(spark), settings)
    return kept.select("post_id", "language")


def _windowed_shares(spark, sf_dir) -> DataFrame:
    split = fixtures.split_posts(spark, sf_dir)
    return promotion.windowed_shares(pairs.other_tag_buckets(split), pairs.total_buckets(split))


@query
def f7_share_threshold(spark, sf_dir):
    return promotion.promoted(_windowed_shares(spark, sf_dir)).select("tag", "sec", "share")


@query
def f8_funnel(spark, sf_dir):
    marked = promotion.mark_accepted(fixtures.split_posts(spark, sf_dir), key="post_id")
    return marked.agg(*promotion.funnel_columns())


@query
def f9_ingest_counts(spark, sf_dir):
    return fixtures.posts(spark, sf_dir).agg(*promotion.ingest_columns())


# --- joins -------------------------------------------------------------------------------------


@query
def j1_tag_pairs(spark, sf_dir):
    return pairs.pair_counts(fixtures.split_posts(spark, sf_dir))


@query
def j1_post_pairs(spark, sf_dir):
    return pairs.pair_counts(fixtures.split_posts(spark, sf_dir), "post_id")


def _scores(spark, sf_dir, mode: str = scoring.SUM, *carry: str) -> DataFrame:
    posts = fixtures.posts(spark, sf_dir).withColumn("words", words.clean_words(F.col("text")))
    slots = scoring.word_slots(fixtures.stored_model(spark, sf_dir).word_topics, mode)
    return scoring.topic_scores(posts, scoring.slots_lookup(slots), *carry, key="post_id")


@query
def j2_known_words(spark, sf_dir):
    """Words of each post found in the weight table; the others are skipped."""
    return _scores(spark, sf_dir).select("post_id", "known_words")


def _assigned(spark, sf_dir, posts: DataFrame, *carry: str) -> DataFrame:
    model = fixtures.stored_model(spark, sf_dir)
    return scoring.assign_topics(
        posts.withColumn("words", words.clean_words(F.col("text"))),
        scoring.slots_lookup(scoring.word_slots(model.word_topics)),
        lookup(model.topics, DEFAULTS.topics),
        *carry,
        key="post_id",
    )


@query
def j3_topic_labels(spark, sf_dir):
    return _assigned(spark, sf_dir, fixtures.posts(spark, sf_dir))


@query
def j4_window_totals(spark, sf_dir):
    return _windowed_shares(spark, sf_dir).select("tag", "sec", "n", "pair_total")


@query
def j5_accepted_union(spark, sf_dir):
    marked = promotion.mark_accepted(fixtures.split_posts(spark, sf_dir), key="post_id")
    return promotion.accepted(marked).select("post_id", "match_kind")


# --- aggregations ------------------------------------------------------------------------------


@query
def a1_seed_window_counts(spark, sf_dir):
    return windows.sliding_sum(pairs.seed_tag_buckets(fixtures.split_posts(spark, sf_dir)), "tag")


@query
def a2_tag_window_counts(spark, sf_dir):
    return windows.sliding_sum(pairs.other_tag_buckets(fixtures.split_posts(spark, sf_dir)), "tag")


@query
def a2_event_window_counts(spark, sf_dir):
    """The same window over the event table, with the event type as tag."""
    events = fixtures.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tag"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("sec")
    )
    return windows.sliding_sum(windows.second_buckets(events, "tag"), "tag")


@query
def a3_window_total(spark, sf_dir):
    return windows.sliding_sum(pairs.total_buckets(fixtures.split_posts(spark, sf_dir)))


@query
def a4_window_shares(spark, sf_dir):
    return _windowed_shares(spark, sf_dir).select("tag", "sec", "share")


@query
def a4_overall_shares(spark, sf_dir):
    return promotion.overall_shares(fixtures.split_posts(spark, sf_dir))


def _last_shares(spark, sf_dir) -> DataFrame:
    split = fixtures.split_posts(spark, sf_dir)
    last = fixtures.posts(spark, sf_dir).agg(F.max("sec")).first()[0]
    return promotion.shares_at(pairs.other_tag_buckets(split), pairs.total_buckets(split), last)


@query
def a5_promoted_now(spark, sf_dir):
    """The promoted list in the window that ends with the last post."""
    return promotion.promoted(_last_shares(spark, sf_dir)).select("tag", "n", "share")


@query
def a6_topic_counts(spark, sf_dir):
    """Seed-accepted posts by country, follower group and language."""
    accepted = tags.with_seed_tag(fixtures.split_posts(spark, sf_dir))
    return view.topic_counts(accepted, "language")


@query
def a7_topic_view(spark, sf_dir):
    """Accepted posts, cleaned, scored and counted per minute."""
    split = fixtures.split_posts(spark, sf_dir)
    marked = promotion.mark_accepted(split, key="post_id")
    assigned = _assigned(
        spark, sf_dir, promotion.accepted(marked), "ts", "country", "follower_group"
    )
    return view.topic_view(assigned).withColumn("ts", F.unix_seconds("ts"))


@query
def a8_topic_scores(spark, sf_dir):
    scores = _scores(spark, sf_dir).select("post_id", F.posexplode("scores").alias("topic", "score"))
    return scores.withColumn("topic", F.col("topic").cast("int"))


@query
def a9_best_topic(spark, sf_dir):
    return _scores(spark, sf_dir).select("post_id", scoring.best_topic().alias("topic"))


@query
def a9_best_topic_positional(spark, sf_dir):
    mode = scoring.POSITIONAL
    return _scores(spark, sf_dir, mode).select("post_id", scoring.best_topic(mode).alias("topic"))


@query
def a10_top_words(spark, sf_dir):
    return topics.top_words(fixtures.word_topics(spark, sf_dir))


@query
def a11_weights_by_word(spark, sf_dir):
    entries = topics.weights_by_word(fixtures.word_topics(spark, sf_dir))
    text = F.array_join(
        F.transform("entries", lambda e: F.concat(e["topic"].cast("string"), F.lit(":"), e["weight"].cast("long").cast("string"))),
        " ",
    )
    return entries.select("word", text.alias("entries"))


@query
def a12_top_shares(spark, sf_dir):
    return promotion.top_shares(_last_shares(spark, sf_dir)).select("tag", "share")


@query
def a13_follower_terciles(spark, sf_dir):
    return view.follower_terciles(fixtures.posts(spark, sf_dir))


@query
def a14_location_counts(spark, sf_dir):
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    return view.counts_by(records, view.location_text(F.col("location")), "location")


@query
def a14_place_counts(spark, sf_dir):
    records = statuses_to_records(fixtures.statuses(spark, sf_dir))
    return view.counts_by(records, F.col("place.fullName"), "place")


# --- text and topics ---------------------------------------------------------------------------


def _count(posts: DataFrame, column, name: str) -> DataFrame:
    return posts.select(F.explode(column).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@query
def t1_tokens(spark, sf_dir):
    return _count(fixtures.posts(spark, sf_dir), words.tokenize(F.col("text")), "token")


@query
def t2_stripped_tokens(spark, sf_dir):
    """Per-token stripping, as the separate step."""
    tokens = words.strip_tokens(words.tokenize(F.col("text")))
    return _count(fixtures.posts(spark, sf_dir), tokens, "word")


@query
def t3_nonempty_words(spark, sf_dir):
    """Words per post after stripping in one pass."""
    posts = fixtures.posts(spark, sf_dir)
    return posts.select("post_id", F.size(words.plain_words(F.col("text"))).cast("long").alias("words"))


@query
def t4_stop_words(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "conversations")
    plain = rows.select("conv_id", "turn", words.plain_words(F.col("text")).alias("plain"))
    kept = F.size(words.remove_stop_words(F.col("plain"))).cast("long")
    return plain.select(
        "conv_id", "turn", kept.alias("kept"), (F.size("plain") - kept).alias("removed")
    )


@query
def t5_clean_words(spark, sf_dir):
    return _count(fixtures.posts(spark, sf_dir), words.clean_words(F.col("text")), "word")


@query
def t5_conversation_words(spark, sf_dir):
    path = f"{sf_dir}/conversations.parquet"
    rows = tables.scan_spread(spark, path, "conv_id", "conv_id", "text")
    return _count(rows, words.clean_words(F.col("text")), "word")


@query
def t6_sentences(spark, sf_dir):
    corpus = fixtures.corpus(spark, sf_dir)
    text = words.sentence(F.col("words"))
    return corpus.select("post_id", F.md5(text).alias("md5"), F.length(text).cast("long").alias("length"))


@query
def t7_vocabulary(spark, sf_dir):
    return topics.vocabulary(fixtures.corpus(spark, sf_dir))


@query
def t8_topic_fit(spark, sf_dir):
    """Words of each fitted topic's label: how many, how many different, how many in the vocabulary."""
    terms, model = fixtures.fitted_terms(spark, sf_dir), fixtures.fitted_topics(spark, sf_dir)
    described = topics.describe_topics(model, terms, DEFAULTS.words_per_topic)
    labelled = topics.topic_labels(described).select("topic", F.explode(F.split("label", ", ")).alias("word"))
    known = topics.vocabulary(fixtures.corpus(spark, sf_dir)).select("word", F.lit(1).alias("known"))
    return labelled.join(known, "word", "left").groupBy("topic").agg(
        F.count("word").alias("words"), F.count_distinct("word").alias("different"), F.count("known").alias("known")
    )


@query
def t9_topic_mass(spark, sf_dir):
    """Terms and weight total of each fitted topic."""
    terms, model = fixtures.fitted_terms(spark, sf_dir), fixtures.fitted_topics(spark, sf_dir)
    described = topics.describe_topics(model, terms)
    return described.groupBy("topic").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.sum("weight"), 6).alias("mass")
    )


@query
def t10_topic_labels(spark, sf_dir):
    return topics.topic_labels(fixtures.word_topics(spark, sf_dir))


@query
def t11_idf(spark, sf_dir):
    idf = topics.inverse_document_frequency(fixtures.corpus(spark, sf_dir))
    return idf.withColumn("idf", F.round("idf", 9))


@query
def t12_split(spark, sf_dir):
    train, validation = topics.train_validation(fixtures.corpus(spark, sf_dir), "post_id")
    return train.select("post_id", F.lit("train").alias("part")).unionByName(
        validation.select("post_id", F.lit("validation").alias("part"))
    )


@query
def t12_evaluation(spark, sf_dir):
    """The validation part under a model of the training part.

    Perplexity is the likelihood per known token, so both give the number of these tokens back.
    """
    vectors = fixtures.term_vectors(spark, sf_dir)
    train, validation = topics.train_validation(vectors, "post_id")
    found = topics.evaluate(topics.fit_topics(train, "post_id"), validation)
    tokens = F.round(-F.col("log_likelihood") / F.col("log_perplexity")).cast("long")
    return found.select(tokens.alias("tokens"), (F.col("log_likelihood") < 0).alias("below_zero"))


@query
def t13_topic_mixture(spark, sf_dir):
    """Topics and total share of each document's mixture; zero without any known term."""
    vectors = fixtures.term_vectors(spark, sf_dir)
    mixed = topics.topic_mixture(fixtures.fitted_topics(spark, sf_dir), vectors, "post_id")
    return mixed.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("topics"), F.round(F.sum("share"), 6).alias("total")
    )


@query
def t14_weights_json(spark, sf_dir):
    """Weights to JSON text and back."""
    entries = topics.weights_by_word(fixtures.word_topics(spark, sf_dir))
    stored = entries.select("word", encode_weights(F.col("entries")).alias("record"))
    back = stored.select("word", "record", F.explode(decode_weights(F.col("record"))).alias("e"))
    return back.select("word", F.col("e.topic").alias("topic"), F.col("e.weight").alias("weight"))


@query
def t15_conflicting_labels(spark, sf_dir):
    """Sources as topic numbers and languages as labels: most sources have several."""
    rows = fixtures.table(spark, sf_dir, "documents")
    return topics.conflicting_labels(rows.select(F.col("source").alias("topic"), F.col("lang").alias("label")))


@query
def t15_repeated_weights(spark, sf_dir):
    """Roles as words and turns as topics, over all conversations."""
    rows = fixtures.table(spark, sf_dir, "conversations")
    return topics.repeated_weights(rows.select(F.col("role").alias("word"), F.col("turn").alias("topic")))
