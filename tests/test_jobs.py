"""The four jobs on files, from landed statuses to the minute view."""

import time

import pytest
from pyspark.sql import functions as F

from postlytics import jobs
from postlytics.plans import fixtures
from postlytics.session import workspace
from postlytics.sources import models
from postlytics.sources.corpus import corpus_table
from tests.conftest import SF_DIR


def test_from_statuses_to_view(spark, tmp_path):
    root = workspace(spark, "jobs")
    seeds = tmp_path / "seeds.txt"
    seeds.write_text("#".join(fixtures.SEEDS))
    fixtures.statuses(spark, SF_DIR).write.json(f"{root}/statuses")
    files = ["--format", "parquet", "--once"]
    jobs.main(["ingest", "--statuses", f"{root}/statuses", "--seeds", str(seeds), "--out", f"{root}/messages", "--checkpoint", f"{root}/c1", *files], spark)
    stream = ["stream", "--root", root, "--seeds", str(seeds), "--model", f"{root}/model", "--messages", f"{root}/messages", *files]
    jobs.main(stream, spark)
    before = corpus_table(spark, root).read().count()
    assert before == spark.read.parquet(f"{root}/assigned").count() > 0
    jobs.main(["train", "--root", root, "--model", f"{root}/model", "--seed", "3"], spark)
    assert models.current_version(spark, f"{root}/model") == 1
    assert 0 < corpus_table(spark, root).read().count() < before
    jobs.main(["view", "--root", root, "--out", f"{root}/view", "--checkpoint", f"{root}/c2", "--once"], spark)
    assert spark.read.parquet(f"{root}/view").agg(F.sum("count")).first()[0] > 0


def test_a_job_ends_after_its_minutes(spark, tmp_path):
    root = workspace(spark, "jobs")
    (tmp_path / "seeds.txt").write_text("a")
    (tmp_path / "statuses").mkdir()
    began = time.monotonic()
    jobs.main(
        ["ingest", "--statuses", str(tmp_path / "statuses"), "--seeds", str(tmp_path / "seeds.txt"), "--out", f"{root}/m",
         "--checkpoint", f"{root}/c", "--format", "parquet", "--minutes", "0.05"], spark,
    )
    assert time.monotonic() - began < 60
    assert not spark.streams.active


@pytest.mark.parametrize("arguments", [[], ["train"], ["stream", "--root", "x"]])
def test_missing_arguments_are_refused(arguments):
    with pytest.raises(SystemExit):
        jobs.main(arguments)
