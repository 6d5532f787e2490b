"""Benchmark decontamination by a BM25 index of the test items and block-max WAND.

Terms are word pairs, which tell texts apart far better than words. The index holds the items;
every passage of every training text is a query. Weights are scaled so that an item scores 1 for
a passage that has all its terms, and WAND returns all items of at least a given score, skipping
by upper bounds of terms and of blocks of their lists. A hit is then verified: the question and the
answer part of the item must both be covered by word pairs of the passage.

Items too short for that, of two to five words, are found where all their words follow each other. A
single word has no question and answer, and is never a hit.

Passages overlap by half, and half a passage holds the longest item, so an item that stands in a
text stands whole in one of its passages. The items are cut into shards of a bounded size; each
shard's index is sent to the tasks, and all texts are read once per shard.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics.llm.common import in_slices, saved, small_batches, text_function

# Letters of scripts without blanks between words (Thai to Khmer, kana, bopomofo, Han),
# each of which is a word of its own.
UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W_{UNSPACED}]+|(?=\w)[{UNSPACED}]")


@dataclass(frozen=True)
class Settings:
    k1: float = 1.2
    b: float = 0.75
    # share of an item's full score that a passage must reach
    threshold: float = 0.5
    # share of the words of question and of answer that pairs of the passage must cover
    overlap: float = 0.6
    # words at the front of an item that are its question
    question_share: float = 2 / 3
    # items with fewer words have too few pairs for a score and are found word by word
    min_words: int = 6
    # items with fewer are no evidence: a question and an answer need a word each
    least_words: int = 2
    min_passage: int = 64
    block: int = 32
    # characters of the items in one shard
    shard_chars: int = 4_000_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


Pair = tuple[str, str]


def pair_terms(text: str | None) -> list[str]:
    words = words_of(text)
    return [f"{a} {b}" for a, b in itertools.pairwise(words)]


def weighted_items(items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(number, item_id, text, postings array<struct<term, weight>>) of the items that can be found.

    The weights are BM25 term weights by the statistics of all items, divided by their sum. Items
    that repeat, under one id or several, each count. Rows without text are left out. Items of fewer
    than `min_words` words have no postings and no part in the statistics.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    terms = text_function(pair_terms, T.ArrayType(T.StringType()))
    every = saved(
        rows.filter("text IS NOT NULL")
        .withColumn("number", F.monotonically_increasing_id())
        .withColumn("terms", terms("text")),
        "items",
    )
    long = F.size("terms") + 1 >= settings.min_words
    numbered = every.filter(long)
    stats = numbered.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("terms")).alias("mean")).first()
    n, mean = stats["n"], stats["mean"] or 1.0
    counted = (
        numbered.select("number", F.size("terms").alias("length"), F.explode("terms").alias("term"))
        .groupBy("number", "length", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = settings.k1 * (1 - settings.b + settings.b * F.col("length") / mean)
    weight = idf * F.col("tf") * (settings.k1 + 1) / (F.col("tf") + norm)
    scored = counted.join(frequency, "term").select("number", "term", weight.alias("weight"))
    lists = scored.groupBy("number").agg(
        F.sum("weight").alias("full"), F.collect_list(F.struct("term", "weight")).alias("raw")
    )
    scaled = F.transform("raw", lambda p: F.struct(p["term"].alias("term"), (p["weight"] / F.col("full")).alias("weight")))
    found = lists.join(numbered, "number").select("number", "item_id", "text", F.array_sort(scaled).alias("postings"))
    none = F.array().cast(found.schema["postings"].dataType).alias("postings")
    return found.unionAll(every.filter(~long).select("number", "item_id", "text", none))


class Index:
    """Inverted lists of one shard, with upper bounds per term and per block of a list."""

    def __init__(self, rows: list[tuple[int | None, str, list[tuple[str, float]]]], settings: Settings) -> None:
        self.settings = settings
        self.item_ids = [item_id for item_id, _, _ in rows]
        self.words = [words_of(text) for _, text, _ in rows]
        # short items by their first word
        self.short: dict[str, list[tuple[list[str], int]]] = {}
        for item, words in enumerate(self.words):
            if settings.least_words <= len(words) < settings.min_words:
                self.short.setdefault(words[0], []).append((words, item))
        self.half = max([settings.min_passage, *map(len, self.words)])
        lists: dict[Pair, list[tuple[int, float]]] = {}
        for item, (_, _, postings) in enumerate(rows):
            for term, weight in postings:
                lists.setdefault(tuple(term.split(" ")), []).append((item, weight))
        self.word_ids = {word: i for i, word in enumerate(sorted({w for pair in lists for w in pair}))}
        width = len(self.word_ids)
        coded = sorted((self.word_ids[pair[0]] * width + self.word_ids[pair[1]], pair) for pair in lists)
        self.codes = np.array([code for code, _ in coded], np.int64)
        self.items = [[item for item, _ in lists[pair]] for _, pair in coded]
        self.weights = [[weight for _, weight in lists[pair]] for _, pair in coded]
        size = settings.block
        self.block_best = [[max(w[i : i + size]) for i in range(0, len(w), size)] for w in self.weights]
        self.block_last = [[i[min(at + size, len(i)) - 1] for at in range(0, len(i), size)] for i in self.items]
        self.best = np.array([max(w) for w in self.weights])

    def terms_of(self, words: list[str]) -> np.ndarray:
        """For each word pair the number of its list, or -1."""
        get = self.word_ids.get
        ids = np.fromiter((get(word, -1) for word in words), np.int64, count=len(words))
        found = np.full(max(0, len(ids) - 1), -1, np.int64)
        known = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        if len(known) and len(self.codes):
            codes = ids[known] * len(self.word_ids) + ids[known + 1]
            places = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            hit = self.codes[places] == codes
            found[known[hit]] = places[hit]
        return found

    def passages(self, terms: np.ndarray) -> Iterator[tuple[int, int]]:
        """(from, to) of the passages whose bounds allow a hit at all: WAND would find no pivot."""
        bounds = np.where(terms >= 0, self.best[terms], 0.0) if len(self.best) else np.zeros(len(terms))
        sums = np.concatenate([[0.0], np.cumsum(bounds)])
        starts = np.arange(0, max(1, len(terms) - self.half + 1), self.half)
        ends = np.minimum(starts + 2 * self.half, len(terms))
        possible = sums[ends] - sums[starts] >= self.settings.threshold - 1e-9
        return zip(starts[possible].tolist(), ends[possible].tolist())

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item, score) of all items that reach the threshold for a set of terms, by item."""
        threshold = self.settings.threshold - 1e-9
        cursors = [[self.items[term][0], 0, term] for term in terms]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for place, (item, _, term) in enumerate(cursors):
                bound += self.best[term]
                if bound >= threshold:
                    pivot = place
                    break
            if pivot is None:
                return found
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # the blocks that hold the pivot item, and how far they reach
            bound, reach = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else None
            for _, _, term in cursors[: pivot + 1]:
                block = bisect_left(self.block_last[term], target)
                if block < len(self.block_last[term]):
                    bound += self.block_best[term][block]
                    last = self.block_last[term][block] + 1
                    reach = last if reach is None else min(reach, last)
            if bound < threshold:
                cursors = self._advance(cursors, pivot, max(target + 1, reach))
            elif cursors[0][0] == target:
                score = sum(self.weights[term][at] for _, at, term in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((target, score))
                cursors = self._advance(cursors, pivot, target + 1)
            else:
                cursors = self._advance(cursors, pivot, target)
        return found

    def _advance(self, cursors: list[list[int]], pivot: int, target: int) -> list[list[int]]:
        """Move the cursors up to the pivot to the first item from `target` on."""
        moved = []
        for place, cursor in enumerate(cursors):
            if place <= pivot and cursor[0] < target:
                items = self.items[cursor[2]]
                at = bisect_left(items, target, cursor[1])
                if at == len(items):
                    continue
                cursor = [items[at], at, cursor[2]]
            moved.append(cursor)
        return moved

    def overlaps(self, item: int, pairs: set[Pair]) -> tuple[float, float]:
        """Shares of the question's and of the answer's words that pairs of a passage cover."""
        words = self.words[item]
        covered = bytearray(len(words))
        for at, pair in enumerate(itertools.pairwise(words)):
            if pair in pairs:
                covered[at] = covered[at + 1] = 1
        cut = round(len(words) * self.settings.question_share)
        return sum(covered[:cut]) / cut, sum(covered[cut:]) / (len(words) - cut)

    def short_items(self, words: list[str]) -> Iterator[int]:
        """The short items whose words follow each other in the text."""
        if self.short:
            for at in [at for at, word in enumerate(words) if word in self.short]:
                for own, item in self.short[words[at]]:
                    if words[at : at + len(own)] == own:
                        yield item

    def search(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """item -> (score, question share, answer share) of verified hits, each by its best passage."""
        words = words_of(text)
        terms = self.terms_of(words)
        hits = dict.fromkeys(self.short_items(words), (1.0, 1.0, 1.0))
        for start, end in self.passages(terms):
            own = terms[start:end]
            pairs = None
            for item, score in self.wand(np.unique(own[own >= 0]).tolist()):
                pairs = pairs or set(itertools.pairwise(words[start : end + 1]))
                shares = self.overlaps(item, pairs)
                if min(shares) >= self.settings.overlap:
                    hits[item] = max(hits.get(item, (0.0, 0.0, 0.0)), (min(1.0, score), *shares))
        return hits


HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): items that stand in a text.

    One row per row of `docs` and item found. Null and empty texts, and documents without a hit,
    give none; a null doc_id or item_id is carried.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = [rows.mapInArrow(_searcher(index), HITS) for index in shard_indexes(items, settings)]
    return reduce(DataFrame.unionAll, found)


def shard_indexes(items: DataFrame, settings: Settings = Settings()) -> list[Broadcast]:
    """One index per shard of the items, each of a bounded size; at least one, which may be empty."""
    weighted = saved(weighted_items(items, settings), "weighted-items")
    chars = weighted.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shards = max(1, -(-chars // settings.shard_chars))
    indexes = []
    for shard in range(shards):
        mine = weighted.filter(F.pmod(F.xxhash64("number"), F.lit(shards)) == shard)
        listed = [
            (r["item_id"], r["text"], [(p["term"], p["weight"]) for p in r["postings"]])
            for r in mine.orderBy("number").toLocalIterator()
        ]
        indexes.append(items.sparkSession.sparkContext.broadcast(Index(listed, settings)))
    return indexes


def _searcher(index):
    names = [part.split()[0] for part in HITS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = index.value
        for batch in batches:
            ids = iter(batch["doc_id"].to_pylist())
            rows = [
                (doc_id, shard.item_ids[item], *scores)
                for texts in in_slices(batch["text"])
                for text in texts
                for doc_id in [next(ids)]
                for item, scores in sorted(shard.search(text).items())
            ]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return search


def without_benchmark(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs` in whose text no item stands; each row is judged by its own text.

    Nothing is shuffled. Several shards are searched one after the other, each over what the last
    one left, so that a task holds one index at a time.
    """
    kept = docs
    for number, index in enumerate(shard_indexes(items, settings)):
        if number:
            kept = saved(kept, "without-shard")
        kept = kept.filter(~_stands_in(index)(F.col("text").cast("string")))
    return kept


def _stands_in(index: Broadcast):
    return text_function(lambda text: bool(index.value.search(text)), T.BooleanType())
