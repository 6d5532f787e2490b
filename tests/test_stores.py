import random

import pytest
from pyspark.sql import functions as F

from postlytics.plans import training
from postlytics.session import workspace
from postlytics.settings import Settings
from postlytics.sources import corpus, models, relational, tables


def corpus_rows(spark, keys):
    return spark.createDataFrame([(str(k), ["w"]) for k in keys], "key string, words array<string>")


def test_repeated_batch_replaces_itself(spark):
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    assert table.read().count() == 0 and table.last_batch() == -1
    for batch_id, keys in ((0, [1, 2]), (1, [3]), (1, [3]), (2, [])):
        corpus.append_corpus(corpus_rows(spark, keys), table, batch_id, F.lit(5))
    rows = table.read().select("key", "batch_id", "ingested_ms").collect()
    assert sorted((r.key, r.batch_id, r.ingested_ms) for r in rows) == [("1", 0, 5), ("2", 0, 5), ("3", 1, 5)]


@pytest.mark.parametrize("divisor", [2, 3, 4])
def test_retention(spark, divisor):
    df = spark.createDataFrame([(i,) for i in range(12)], "ingested_ms long")
    for remainder in range(divisor):
        kept = [r[0] for r in corpus.retain(df, divisor, remainder).collect()]
        assert kept == [i for i in range(12) if i % divisor != remainder]


def test_retention_arguments(spark):
    df = spark.createDataFrame([(1,)], "ingested_ms long")
    with pytest.raises(ValueError):
        corpus.retain(df, 3, 3)
    draws = {corpus.draw_retention(seed) for seed in range(200)}
    assert draws == {(d, r) for d in (2, 3, 4) for r in range(d)}
    assert corpus.draw_retention(7) == corpus.draw_retention(7)


def weights(spark, *rows):
    return spark.createDataFrame(list(rows), "word string, topic int, weight double")


def test_model_versions(spark):
    root = workspace(spark, "model")
    assert models.load(spark, root) is None
    first = models.publish(weights(spark, ("a", 0, 1.0)), root)
    reader = models.load(spark, root)
    second = models.publish(weights(spark, ("b", 0, 1.0), ("c", 0, 0.5)), root)
    assert (first, second) == (1, 2)
    assert [r.word for r in reader.word_topics.collect()] == ["a"]
    now = models.load(spark, root)
    assert [r.label for r in now.topics.collect()] == ["b, c"]


def test_unannounced_version_is_not_seen(spark):
    root = workspace(spark, "model")
    models.publish(weights(spark, ("a", 0, 1.0)), root)
    weights(spark, ("x", 0, 1.0)).write.parquet(f"{root}/version=2/word_topics")
    assert [r.word for r in models.load(spark, root).word_topics.collect()] == ["a"]
    assert models.publish(weights(spark, ("b", 0, 1.0)), root) == 2
    assert [r.word for r in models.load(spark, root).word_topics.collect()] == ["b"]


def test_publish_guards_weights(spark):
    with pytest.raises(ValueError):
        models.publish(weights(spark, ("a", 0, 1.0), ("a", 0, 2.0)), workspace(spark, "model"))


def trained(spark, root, seed):
    """A corpus of 40 posts in one batch, all written within a second, after one training run."""
    docs = spark.createDataFrame(
        [(str(i), [f"{'ab'[i % 2]}{j}" for j in range(8)] + ["x"]) for i in range(40)], "key string, words array<string>"
    )
    table = corpus.corpus_table(spark, root)
    now = F.timestamp_millis(F.lit(1_704_067_200_000))
    corpus.append_corpus(docs, table, 0, corpus.spread_write_time(now))
    before = {r.key: r.ingested_ms for r in table.read().collect()}
    assert training.train_and_shrink(spark, root, f"{root}/model", seed, Settings(topics=2, max_iter=2)) == 1
    return table, before


def test_train_and_shrink(spark):
    root = workspace(spark, "stream")
    table, before = trained(spark, root, 3)
    model = models.load(spark, f"{root}/model")
    assert (model.word_topics.count(), model.topics.count()) == (2 * 17, 2)
    divisor, remainder = corpus.draw_retention(3)
    kept = {r.key for r in table.read().collect()}
    assert kept == {key for key, ms in before.items() if ms % divisor != remainder}
    assert 0 < len(kept) < 40


@pytest.mark.parametrize("draw", [(d, r) for d in corpus.RETENTION_DIVISORS for r in range(d)])
def test_no_draw_empties_a_batch(spark, draw):
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    now = F.timestamp_millis(F.lit(1_704_067_200_000))
    corpus.append_corpus(corpus_rows(spark, range(200)), table, 0, corpus.spread_write_time(now))
    table.forget_share(*draw)
    assert 0.2 < 1 - table.read().count() / 200 < 0.8


def test_train_needs_words(spark):
    with pytest.raises(ValueError):
        training.train(corpus_rows(spark, [1]), workspace(spark, "model"))


def test_view_rows(spark):
    path = workspace(spark, "view")
    view = spark.createDataFrame(
        [(60, "Germany", "Medium", "a, b", 12355)], "s long, region string, follower_group string, topic string, count long"
    ).select(F.timestamp_seconds("s").alias("ts"), "region", "follower_group", "topic", "count")
    relational.append_view(view, fmt="parquet", path=path)
    relational.append_view(view, fmt="parquet", path=path)
    stored = spark.read.parquet(path)
    assert stored.columns == ["timeStamp", "region", "followerGroup", "topic", "count"]
    assert stored.schema["count"].dataType.simpleString() == "int"
    assert stored.count() == 2


def test_relational_sink_needs_an_address(spark):
    view = spark.sql("SELECT current_timestamp() AS ts, 'r' AS region, 'g' AS follower_group, 't' AS topic, 1L AS count")
    with pytest.raises(Exception, match="(?i)url"):
        relational.append_view(view)


def test_row_counts(spark):
    got = {r.collection: r.documents for r in tables.row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert got == {"a": 3, "b": 0}


def test_spread_keeps_all_rows(spark):
    path = workspace(spark, "table")
    spark.range(500).withColumnRenamed("id", "k").coalesce(1).write.parquet(path)
    assert sorted(r.k for r in tables.scan_spread(spark, path, "k", "k").collect()) == list(range(500))


def event_rows(spark, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "key long")
    return rows.select("key", F.array(F.lit("w")).alias("words"), F.col("key").alias("ms"))


def test_tombstones_and_compaction_equal_plain_rows(spark):
    """Random appends, repeats, retentions and compactions against a dictionary."""
    draw = random.Random(12)
    table, plain, last = corpus.corpus_table(spark, workspace(spark, "stream")), {}, -1
    batch = lambda number: list(range(number * 10, number * 10 + 10))
    for _ in range(12):
        action = draw.choice(["append", "append", "repeat", "forget", "compact", "compact early"])
        if action == "append" or last < 0:
            last += 1
            plain.update(dict.fromkeys(batch(last), last))
            corpus.append_corpus(event_rows(spark, batch(last)), table, last, F.col("ms"))
        elif action == "repeat":
            again = draw.randrange(last + 1)
            corpus.append_corpus(event_rows(spark, batch(again)), table, again, F.col("ms"))
        elif action == "forget":
            divisor, remainder = corpus.draw_retention(draw.randrange(99))
            plain = {k: b for k, b in plain.items() if k % divisor != remainder}
            table.forget_share(divisor, remainder)
        else:
            table.compact(None if action == "compact" else draw.randrange(last + 1))
        assert {int(r.key): r.batch_id for r in table.read().collect()} == plain
    assert table.live().version > 2


def test_a_reader_of_the_version_before_still_reads(spark):
    table = corpus.corpus_table(spark, workspace(spark, "stream"))
    for number in range(4):
        corpus.append_corpus(event_rows(spark, [number]), table, number, F.col("ms"))
    table.compact(1)
    before = table.read()
    table.compact(2)
    assert sorted(int(r.key) for r in before.collect()) == [0, 1, 2, 3]
    assert sorted(int(r.key) for r in table.read().collect()) == [0, 1, 2, 3]


def test_an_emptied_corpus_can_be_read_and_trained_on_again(spark):
    root = workspace(spark, "stream")
    table, _ = trained(spark, root, 5)
    table.forget_share(1, 0)
    table.compact(0)
    assert table.read().count() == 0
    with pytest.raises(ValueError, match="no word"):
        training.train_and_shrink(spark, root, f"{root}/model", 1)
    corpus.append_corpus(corpus_rows(spark, ["new"]), table, 1, F.lit(7))
    assert [r.key for r in table.read().collect()] == ["new"]
