"""A batch-keyed table that lives long: appends, retention by tombstones, compaction.

Below `path`, every batch writes its own folder `batch_id=N`, replacing what an earlier try left.
`path-live` announces versions (version, upto, marks): the folder `path-base-<version>` holds all
batches up to `upto` in few files, with the first `marks` tombstones carried out. Readers take the
newest announced version, the batch folders after `upto`, and leave out the rows of the tombstones
that are not carried out yet. So nothing that a reader may have listed is ever rewritten, a batch
that is repeated after it was folded changes nothing, and the number of folders stays bounded by
the batches between two compactions.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics import schemas
from postlytics.session import delete_path, folder_names, path_exists
from postlytics.sources.batches import write_batch

_VERSIONS = "version long, upto long, marks long"
_MARKS = "mark long, upto long, divisor long, remainder long"

# The divisor of a retention run is drawn from these.
RETENTION_DIVISORS = (2, 3, 4)


def draw_retention(seed: int) -> tuple[int, int]:
    """A (divisor, remainder) pair for `retain`, repeatable by its seed."""
    draw = random.Random(seed)
    divisor = draw.choice(RETENTION_DIVISORS)
    return divisor, draw.randrange(divisor)


def dropped(divisor: int | Column, remainder: int | Column, written_ms: str = "ingested_ms") -> Column:
    """Whether a row's write time has the remainder; a row without one stays."""
    at = F.col(written_ms)
    return F.coalesce(F.pmod(at, F.lit(divisor)) == F.lit(remainder), F.lit(False))


def _checked(divisor: int, remainder: int) -> None:
    if divisor < 1 or not 0 <= remainder < divisor:
        raise ValueError("need divisor >= 1 and 0 <= remainder < divisor")


def retain(corpus: DataFrame, divisor: int, remainder: int) -> DataFrame:
    """Corpus without the rows whose write time has this remainder."""
    _checked(divisor, remainder)
    return corpus.filter(~dropped(divisor, remainder))


@dataclass(frozen=True)
class Live:
    """What readers see: the base of this version and the batches after `upto`."""

    version: int = 0
    upto: int = -1
    marks: int = 0


@dataclass
class BatchTable:
    """`schema` has a `batch_id`; `written_ms` names the write time that tombstones speak of."""

    spark: SparkSession
    path: str
    schema: T.StructType
    written_ms: str = "ingested_ms"

    def append(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, self.path, batch_id)

    def live(self) -> Live:
        if not path_exists(self.spark, f"{self.path}-live"):
            return Live()
        rows = self.spark.read.schema(_VERSIONS).parquet(f"{self.path}-live").orderBy(F.desc("version")).limit(1)
        return Live(*rows.first())

    def _batches(self, after: int, until: int | None = None) -> DataFrame:
        """Rows of the batch folders of a range; folders outside it are not read."""
        rows = self.spark.createDataFrame([], self.schema)
        if path_exists(self.spark, self.path):
            rows = self.spark.read.schema(self.schema).parquet(self.path).filter(F.col("batch_id") > after)
        return rows if until is None else rows.filter(F.col("batch_id") <= until)

    def _marks(self, done: int) -> list[tuple[int, int, int, int]]:
        """Tombstones that are not carried out, few since compaction carries them out."""
        if not path_exists(self.spark, f"{self.path}-marks"):
            return []
        rows = self.spark.read.schema(_MARKS).parquet(f"{self.path}-marks").filter(F.col("mark") > done)
        return [tuple(row) for row in rows.orderBy("mark").collect()]

    def _without(self, rows: DataFrame, marks: list[tuple[int, int, int, int]]) -> DataFrame:
        for _, upto, divisor, remainder in marks:
            rows = rows.filter(~((F.col("batch_id") <= upto) & dropped(divisor, remainder, self.written_ms)))
        return rows

    def _seen(self, live: Live, until: int | None = None) -> DataFrame:
        rows = self._batches(live.upto, until)
        if live.version and path_exists(self.spark, self._base(live.version)):
            rows = self.spark.read.schema(self.schema).parquet(self._base(live.version)).unionByName(rows)
        return self._without(rows, self._marks(live.marks))

    def _base(self, version: int) -> str:
        return f"{self.path}-base-{version}"

    def read(self) -> DataFrame:
        """All rows that are there; a table that was never written, or that retention emptied, has none."""
        return self._seen(self.live())

    def last_batch(self) -> int:
        """The largest number of a batch folder, folded ones included; -1 before the first."""
        names = folder_names(self.spark, self.path)
        numbers = [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]
        return max([*numbers, self.live().upto])

    def forget_share(self, divisor: int, remainder: int) -> None:
        """Retention: rows of the batches so far whose write time has this remainder are no longer read."""
        _checked(divisor, remainder)
        known = self._marks(0)
        row = (max([0, *(mark for mark, *_ in known)]) + 1, self.last_batch(), divisor, remainder)
        self.spark.createDataFrame([row], _MARKS).coalesce(1).write.mode("append").parquet(f"{self.path}-marks")

    def compact(self, upto: int | None = None, fold: Callable[[DataFrame], DataFrame] | None = None, keep: bool = False) -> Live:
        """Fold the batches up to `upto` (the last but one, as the last may still be repeated) into a new base.

        `fold` may merge rows. The base is announced last. The folders of the batches that the version
        before had folded, and its predecessor's base, are then deleted unless `keep` is set: readers
        that started with the version before still find all they listed.
        """
        old = self.live()
        upto = max(self.last_batch() - 1 if upto is None else upto, old.upto)
        marks = self._marks(old.marks)
        rows = self._seen(old, upto)
        new = Live(old.version + 1, upto, max([old.marks, *(mark for mark, *_ in marks)]))
        carried = [mark for mark in marks if mark[1] > upto]
        if carried:  # a tombstone that speaks of later batches too stays until they are folded
            new = Live(new.version, upto, min(mark for mark, *_ in carried) - 1)
        folded = fold(rows) if fold else rows
        folded.write.mode("overwrite").parquet(self._base(new.version))
        versions = self.spark.createDataFrame([(new.version, new.upto, new.marks)], _VERSIONS)
        versions.coalesce(1).write.mode("append").parquet(f"{self.path}-live")
        if not keep:
            self._delete_before(old)
        return new

    def _delete_before(self, old: Live) -> None:
        for name in folder_names(self.spark, self.path):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= old.upto:
                delete_path(self.spark, f"{self.path}/{name}")
        if old.version > 1:
            delete_path(self.spark, self._base(old.version - 1))


def corpus_table(spark: SparkSession, root: str) -> BatchTable:
    """The corpus below `root` that the stream appends to and training reads."""
    return BatchTable(spark, f"{root}/corpus", schemas.CORPUS)


def spread_write_time(now: Column, key: str = "key", span_ms: int = 1000) -> Column:
    """Write times of the rows of a batch, in milliseconds.

    All rows of a batch are written at once; a hash of the key spreads them over the batch's second,
    so that retention by a remainder takes a share of the rows, not all or none of a batch.
    """
    return F.unix_millis(now) + F.pmod(F.xxhash64(key), F.lit(span_ms))


def append_corpus(posts: DataFrame, table: BatchTable, batch_id: int, ingested_ms: Column) -> None:
    """Add a batch of cleaned posts (`key`, `words`) with their write time to the corpus."""
    table.append(
        posts.select(F.col("key").cast("string").alias("key"), "words", ingested_ms.cast("long").alias("ingested_ms")),
        batch_id,
    )
