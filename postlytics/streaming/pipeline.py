"""Messages to accepted, cleaned and scored posts.

The promoted tags are state of the whole stream that filters the very batch they come from,
which no keyed stateful operator can express. So each micro-batch runs the batch operators over
its own rows and the buckets of the last window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from postlytics.functions.text import clean_words
from postlytics.operators.lookups import lookup
from postlytics.operators.pairs import other_tag_buckets, total_buckets
from postlytics.operators.promotion import accepted, mark_accepted, merge_buckets
from postlytics.operators.records import bad_messages, good_posts, parse_messages
from postlytics.operators.scoring import SUM, assign_topics, slots_lookup, word_slots
from postlytics.operators.tags import TagList, split_tags
from postlytics.operators.topics import conflicting_labels, require_none, require_single_weights
from postlytics.session import delete_path
from postlytics.settings import DEFAULTS, Settings
from postlytics.sources import models
from postlytics.sources.batches import write_batch
from postlytics.sources.corpus import append_corpus, corpus_table, spread_write_time
from postlytics.streaming.buckets import WindowState
from postlytics.streaming.progress import FunnelTotals, Report, observe_funnel

# what scoring keeps of a post besides its row number
CARRIED = ("key", "ts", "country", "follower_group", "match_kind")


@dataclass
class TopicModel:
    """The announced model, looked up once per micro-batch and kept while its version stays."""

    root: str
    scoring: str = SUM
    settings: Settings = DEFAULTS
    version: int | None = None
    slots: DataFrame | None = None
    topics: DataFrame | None = None

    def refresh(self, spark: SparkSession) -> bool:
        """True when there is a model."""
        latest = models.current_version(spark, self.root)
        if latest != self.version:
            model = models.load(spark, self.root, latest)
            require_none(conflicting_labels(model.topics), "topics with several labels")
            require_single_weights(model.word_topics)
            for old in (self.slots, self.topics):
                if old is not None:
                    old.unpersist()
            self.slots = slots_lookup(word_slots(model.word_topics, self.scoring, self.settings), self.settings)
            self.topics = lookup(model.topics, self.settings.inline_list_limit)
            self.version = latest
        return self.version is not None


# bytes of rows that a task gathers before it writes them to a scratch table
_KEPT_BLOCK = 16 << 20
# messages of a batch that occur more than once, by their hashes, that may be broadcast
_BROADCAST_REPEATED = 1_000_000


def repeated_messages(messages: DataFrame) -> DataFrame:
    """(alike): hashes of key and value that more than one message has; only hashes are shuffled."""
    hashes = messages.groupBy(F.xxhash64("key", "value").alias("alike")).agg(F.count(F.lit(1)).alias("n"))
    return hashes.filter("n > 1").select("alike")


def with_row_ids(messages: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Adds `row`, which depends on key and value and on how many equal messages came before.

    With the hashes of `repeated_messages`, which are broadcast, all other messages stay where they
    are as the first of their kind. Without, all messages are shuffled and sorted to be numbered.
    """
    alike = Window.partitionBy("key", F.xxhash64("value")).orderBy("value")
    nth = F.row_number().over(alike)
    row = F.xxhash64("key", "value", "copy").alias("row")
    if repeated is None:
        return messages.withColumn("copy", nth).select(*messages.columns, row)
    listed = F.broadcast(repeated.withColumn("several", F.lit(True)))
    marked = messages.withColumn("alike", F.xxhash64("key", "value")).join(listed, "alike", "left")
    once = marked.filter("several IS NULL").withColumn("copy", F.lit(1))
    return once.unionByName(marked.filter("several").withColumn("copy", nth)).select(*messages.columns, row)


def clock_columns() -> list[Column]:
    """Two clocks over distinct seconds that have posts: of all that is known, and of the batch alone.

    Both are middles, so dates that are wrong move them only where they fill more seconds than the
    right ones. The smaller is taken: a batch of wrong dates alone does not move what is known, and
    where only wrong dates are known, the first batch of right ones holds the clock back.
    """
    middle = lambda sec: F.percentile_approx(sec, 0.5, 1000)
    return [middle(F.col("sec")), middle(F.when(F.col("fresh"), F.col("sec")))]


@dataclass
class Pipeline:
    """Tables below `root`: quarantine, tag_state, total_state, corpus, assigned.

    Messages are told apart by a hash of key, value and copy number, so equal messages all count.
    Equal messages may trade places, so a repeated batch gives the same rows however its files are
    split. Every write replaces what an earlier try of its batch left. `report` gets the funnel
    counters of each batch that has posts, once its tables are written.

    Rows with texts that a batch reads several times are kept as files below `scratch` while it runs.
    Cached and spilled, a hundred blocks of 4 MB of them are held by each task that writes or reads them.
    """

    root: str
    seeds: TagList
    model: TopicModel
    settings: Settings = field(default=DEFAULTS)
    report: Report = field(default_factory=FunnelTotals)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def writer(self, messages: DataFrame) -> DataStreamWriter:
        return messages.writeStream.foreachBatch(self.process).option(
            "checkpointLocation", self.path("checkpoint")
        )

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written below `scratch` and read back."""
        path = self.path(f"scratch/{name}")
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        writer.option("parquet.block.size", _KEPT_BLOCK).parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def process(self, messages: DataFrame, batch_id: int) -> None:
        latest = F.current_timestamp() + F.make_dt_interval(secs=F.lit(self.settings.future_seconds))
        parsed = self.keep(parse_messages(messages.select("key", "value"), latest), "parsed")
        repeated = repeated_messages(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(bad_messages(parsed), self.path("quarantine"), batch_id)
            few = repeated.limit(_BROADCAST_REPEATED + 1).count() <= _BROADCAST_REPEATED
            posts = good_posts(with_row_ids(parsed, repeated if few else None), "row")
            if not posts.isEmpty():
                self._accept_and_score(posts, batch_id)
        finally:
            repeated.unpersist()
            delete_path(messages.sparkSession, self.path("scratch"))

    def _accept_and_score(self, posts: DataFrame, batch_id: int) -> None:
        spark, settings = posts.sparkSession, self.settings
        split = split_tags(posts, self.seeds, "row")
        tag_state = WindowState(spark, self.path("tag_state"), "tag", "sec")
        total_state = WindowState(spark, self.path("total_state"), "sec")
        held: list[DataFrame] = []

        def hold(table: DataFrame) -> DataFrame:
            held.append(table.persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]

        try:
            now, before = other_tag_buckets(split, probes=True), tag_state.before(batch_id)
            tag_buckets = hold(merge_buckets(now, before, "tag", "sec"))
            now, before = total_buckets(split, probes=True), total_state.before(batch_id)
            fresh = now.withColumn("fresh", F.lit(True)).unionByName(before.withColumn("fresh", F.lit(False)))
            totals = hold(fresh.groupBy("sec").agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh")))
            middle, own, seconds = totals.agg(*clock_columns(), F.count("sec")).first()
            marked = mark_accepted(split, tag_buckets, totals.drop("fresh"), settings, key="row", seconds=seconds)
            # a later batch may hold posts this late, each with a full window before it
            clock = min((sec for sec in (middle, own) if sec is not None), default=0)
            horizon = clock - settings.window_seconds - settings.watermark_seconds
            tag_state.save(tag_buckets, batch_id, horizon)
            total_state.save(totals, batch_id, horizon)
            words = clean_words(F.col("text")).alias("words")
            counted, funnel = observe_funnel(marked)
            kept = self.keep(accepted(counted).select("row", *CARRIED, words), "accepted")
            append_corpus(kept, corpus_table(spark, self.root), batch_id, spread_write_time(F.current_timestamp(), "row"))
            write_batch(self._assign(kept), self.path("assigned"), batch_id)
        finally:
            for table in held:
                table.unpersist()
        tag_state.forget(batch_id)
        total_state.forget(batch_id)
        self.report(batch_id, funnel.get)

    def _assign(self, kept: DataFrame) -> DataFrame:
        if not self.model.refresh(kept.sparkSession):
            return kept.select(
                "row", *CARRIED, F.lit(None).cast("int").alias("topic"), F.lit(None).cast("string").alias("label")
            )
        return assign_topics(
            kept, self.model.slots, self.model.topics, *CARRIED,
            scoring=self.model.scoring, settings=self.settings, key="row",
        )
