"""Phrase collocations: pair counts by direct-address tiles over frequency-ranked ids.

Words that may stand in a phrase (counted often enough) get ids by falling frequency, language by
language. A pair of ids is a cell of a square matrix that is cut into tiles of 256 x 256 cells. As
ids are ranked, few tiles at low ids hold most occurrences: a tile with many is counted by a dense
`bincount` over its cells and stays in memory for the task; the occurrences in all other tiles are
sorted into coordinates with counts (COO). Every task hands on one count per cell, and Spark adds
the counts up by cell, so no tile has to fit one task. Frequent pairs are ranked again and count as
one id each, so phrases of three words are pairs (pair, word), those of four (triple, word).

The ranked lists are broadcast, so their length is bounded (`listed`). Phrases with a word or
beginning beyond a list that is full are counted as they are written, by the same job; a list that
holds all frequent entries leaves nothing to that path, since what is not on it is too rare.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices, most_frequent, saved

# Marks that end a piece, and the smallest count, share and score factor of the contract.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LEAST, INSIDE, SCALE, WORDS = 30, 80, 2_000_000, 4

# Ids on a ranked list, under 2^20: bounds what is sent to the driver and broadcast.
LISTED = 1 << 19
# Words longer than this are not put on the list but counted as they are written.
LONGEST = 64
# Side of a tile, occurrences that make it dense, dense tiles a task keeps, and its buffer of codes.
SIDE, DENSE, KEPT, BUFFER = 256, 16_384, 64, 1 << 21
# Different words, and characters of written-out phrases, that a task counts before it hands counts on.
COUNTED, SPELLED = 1 << 19, 1 << 24

_TABLE = bytes(b + 32 if 65 <= b <= 90 else 46 if b in BREAKS else b for b in range(256))
_BREAK = b"."


def pieces(text: str | None) -> list[bytes]:
    """The words of a text, with a dot wherever a piece ends; words hold no dots."""
    lowered = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    return lowered.replace(_BREAK, b" . ").split()


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) for some texts at a time; texts of a batch are joined by language."""
    langs = batch["lang"].to_pylist()
    at = 0
    for texts in in_slices(batch["text"]):
        joined: dict[str, list[bytes]] = {}
        for lang, text in zip(langs[at : at + len(texts)], texts):
            words = joined.setdefault(lang, [])
            words += pieces(text)
            words.append(_BREAK)
        at += len(texts)
        yield from joined.items()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, a): occurrences of every word, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                found.pop(_BREAK, None)
                words = pa.array(list(found), pa.binary()).cast(pa.string())
                numbers = pa.array(list(found.values()), pa.int64())
                for at in range(0, len(words), 1 << 16):
                    part = words.slice(at, 1 << 16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), part, numbers.slice(at, 1 << 16)], ["lang", "phrase", "a"]
                    )
            counts.clear()

        for batch in batches:
            for lang, words in _by_language(batch):
                counts.setdefault(lang, Counter()).update(words)
            if sum(map(len, counts.values())) > COUNTED:
                yield from flush()
        yield from flush()

    return _texts(docs).mapInArrow(count, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


@dataclass
class Ranked:
    """A ranked list: by language, codes in falling frequency; `whole` when nothing frequent is missing.

    The code of a word is the word, in an Arrow array; that of a longer phrase `id of its beginning << 20 | id of the last word`.
    """

    codes: dict[str, object]
    whole: bool


class _Lookup:
    """Ids of one language."""

    def __init__(self, lists: list[Ranked], lang: str) -> None:
        words = lists[0].codes.get(lang)
        self.words = {} if words is None else {word: i for i, word in enumerate(words.to_pylist())}
        self.words[_BREAK] = -1
        self.longer = []
        for ranked in lists[1:]:
            codes = ranked.codes.get(lang, np.empty(0, np.int64))
            order = np.argsort(codes)
            self.longer.append((codes[order], order))

    def word_ids(self, words: list[bytes]) -> np.ndarray:
        """-1 at the end of a piece, -2 for words that are not listed."""
        get = self.words.get
        return np.fromiter((get(word, -2) for word in words), np.int64, len(words))

    def phrase_ids(self, level: int, codes: np.ndarray) -> np.ndarray:
        known, order = self.longer[level]
        if not len(known):
            return np.full(len(codes), -2)
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        return np.where(known[at] == codes, order[at], -2)


class Tiles:
    """Counts of codes `language << 40 | first id << 20 | second id`, in one buffer and few dense tiles."""

    def __init__(self, dense: int = DENSE, kept: int = KEPT, buffer: int = BUFFER) -> None:
        self.enough, self.kept, self.buffer = dense, kept, buffer
        self.codes: list[np.ndarray] = []
        self.size = 0
        self.known = np.empty(0, np.int64)  # numbers of the dense tiles, sorted
        self.cells = np.empty((0, SIDE * SIDE), np.int64)  # their counts, in the same order

    def add(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields (codes, counts) of sparse tiles whenever the buffer is full."""
        self.codes.append(codes)
        self.size += len(codes)
        if self.size >= self.buffer:
            yield self._sparse()

    def last(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self._sparse()
        for tile, cells in zip(self.known, self.cells):
            used = np.flatnonzero(cells)
            corner = (tile >> 24) << 40 | (tile >> 12 & 0xFFF) * SIDE << 20 | (tile & 0xFFF) * SIDE
            yield corner + ((used // SIDE) << 20) + used % SIDE, cells[used]

    def _sparse(self) -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate(self.codes) if self.codes else np.empty(0, np.int64)
        self.codes, self.size = [], 0
        first, second = codes >> 20 & 0xFFFFF, codes & 0xFFFFF
        tiles = (codes >> 40) << 24 | (first // SIDE) << 12 | second // SIDE
        self._open(tiles)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, tiles), len(self.known) - 1)
            inside = self.known[at] == tiles
            cells = at[inside] * SIDE * SIDE + (first[inside] % SIDE) * SIDE + second[inside] % SIDE
            self.cells += np.bincount(cells, minlength=self.cells.size).reshape(self.cells.shape)
            codes = codes[~inside]
        return np.unique(codes, return_counts=True)

    def _open(self, tiles: np.ndarray) -> None:
        """Makes the fullest tiles dense, as far as there is room."""
        numbers, sizes = np.unique(tiles, return_counts=True)
        full = numbers[(sizes >= self.enough) & ~np.isin(numbers, self.known)]
        full = full[np.argsort(-sizes[np.searchsorted(numbers, full)])][: self.kept - len(self.known)]
        if len(full):
            known = np.sort(np.concatenate([self.known, full]))
            cells = np.zeros((len(known), SIDE * SIDE), np.int64)
            cells[np.searchsorted(known, self.known)] = self.cells
            self.known, self.cells = known, cells


def _occurrences(look: _Lookup, lists: list[Ranked], words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all phrases of len(lists) + 1 words, and where phrases start that must be written out."""
    size = len(lists) + 1
    ids = look.word_ids(words)
    n = max(0, len(ids) - size + 1)
    spelled = np.zeros(n, bool)
    if not lists[0].whole:
        inside, new = np.ones(n, bool), np.zeros(n, bool)
        for k in range(size):
            inside &= ids[k : k + n] != -1
            new |= ids[k : k + n] == -2
        spelled |= inside & new
    good = np.ones(n, bool)
    for k in range(size):
        good &= ids[k : k + n] >= 0
    begin = ids
    for level, ranked in enumerate(lists[1:]):
        codes = begin[: len(begin) - 1] << 20 | np.maximum(ids[level + 1 :], 0)
        usable = (begin[: len(begin) - 1] >= 0) & (ids[level + 1 :] >= 0)
        begin = np.full(len(codes), -2)
        begin[usable] = look.phrase_ids(level, codes[usable])
        missing = begin[:n] < 0
        if ranked.whole:
            good &= ~missing
            for k in range(1, size - level - 1):
                good &= begin[k : k + n] >= 0
        else:
            spelled |= good & missing
            good &= ~missing
    starts = np.flatnonzero(good & ~spelled)
    return begin[starts] << 20 | ids[starts + size - 1], np.flatnonzero(spelled)


COUNTS = "lang string, code long, phrase string, a long"


def phrase_counts(docs: DataFrame, lists: list[Ranked]) -> DataFrame:
    """(lang, code, phrase, a) of phrases one word longer than the last list's; code or phrase is null.

    Phrases whose parts show that they are too rare are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lists)

    def coded(langs: list[str], found: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        names = pa.array(langs, pa.string())
        for at in range(0, len(found[0]), 1 << 16):
            codes, counts = (part[at : at + (1 << 16)] for part in found)
            columns = [names.take(pa.array(codes >> 40)), pa.array(codes & ((1 << 40) - 1)), pa.nulls(len(codes), pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "phrase", "a"])

    def written(lang: str, found: Counter) -> Iterator[pa.RecordBatch]:
        phrases = pa.array(list(found), pa.binary()).cast(pa.string())
        counts = pa.array(list(found.values()), pa.int64())
        for at in range(0, len(phrases), 1 << 12):
            part = phrases.slice(at, 1 << 12)
            columns = [pa.array([lang] * len(part), pa.string()), pa.nulls(len(part), pa.int64()), part, counts.slice(at, 1 << 12)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "phrase", "a"])
        found.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, tiles = shared.value, Tiles()
        size, chars = len(lists) + 1, 0
        looks: dict[str, tuple[int, _Lookup]] = {}
        spelled: dict[str, Counter] = {}
        for batch in batches:
            for lang, words in _by_language(batch):
                if lang not in looks:
                    looks[lang], spelled[lang] = (len(looks), _Lookup(lists, lang)), Counter()
                number, look = looks[lang]
                codes, starts = _occurrences(look, lists, words)
                for found in tiles.add(number << 40 | codes):
                    yield from coded(list(looks), found)
                for at in starts.tolist():
                    phrase = b" ".join(words[at : at + size])
                    chars += len(phrase)
                    spelled[lang][phrase] += 1
            if chars > SPELLED:
                for lang, found in spelled.items():
                    yield from written(lang, found)
                chars = 0
        for found in tiles.last():
            yield from coded(list(looks), found)
        for lang, found in spelled.items():
            yield from written(lang, found)

    found = _texts(docs).mapInArrow(count, COUNTS)
    return found.groupBy("lang", "code", "phrase").agg(F.sum("a").alias("a"))


def _ranked(frequent: DataFrame, code: str, listed: int) -> tuple[Ranked, DataFrame]:
    """The most frequent entries, at most `listed` of all languages together, and (lang, id, phrase)."""
    usable = frequent.filter(F.col(code).isNotNull())
    if code == "phrase":
        usable = usable.filter(F.octet_length("phrase") <= LONGEST)
    order = Window.partitionBy("lang").orderBy(F.desc("a"), code)
    numbered = most_frequent(usable, "a", listed).select(
        "lang", (F.row_number().over(order) - 1).cast("long").alias("id"), "phrase", *([code] if code != "phrase" else [])
    )
    entries = saved(numbered, "ranked-list")
    top = entries.select("lang", "id", code).orderBy("lang", "id").toArrow().combine_chunks()
    codes: dict[str, object] = {}
    at = 0
    for lang, size in sorted(entries.groupBy("lang").count().collect(), key=lambda row: row[0].encode()):
        part = top[code].slice(at, size)
        codes[lang] = part.cast(pa.binary()).combine_chunks() if code == "phrase" else part.to_numpy()
        at += size
    return Ranked(codes, at == frequent.count()), entries.select("lang", "id", "phrase")


def frequent_phrases(docs: DataFrame, least: int = LEAST, listed: int = LISTED) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and per number of words, from 1, the frequent (lang, phrase, a)."""
    words = saved(word_counts(docs), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    levels = [saved(words.filter(F.col("a") >= least), "frequent-1")]
    first_list, names = _ranked(levels[0], "phrase", listed)
    lists, begins = [first_list], names
    for size in range(2, WORDS + 1):
        counted = saved(phrase_counts(docs, lists).filter(F.col("a") >= least), f"counts-{size}")
        first = begins.select("lang", F.col("id").alias("first"), F.col("phrase").alias("begin"))
        second = names.select("lang", F.col("id").alias("second"), F.col("phrase").alias("end"))
        coded = counted.filter("code IS NOT NULL").withColumns(
            {"first": F.shiftright("code", 20), "second": F.col("code").bitwiseAND(0xFFFFF)}
        )
        written = coded.join(first, ["lang", "first"]).join(second, ["lang", "second"]).select(
            "lang", "code", F.concat_ws(" ", "begin", "end").alias("phrase"), "a"
        )
        frequent = saved(written.union(counted.filter("code IS NULL").select("lang", "code", "phrase", "a")), f"frequent-{size}")
        levels.append(frequent)
        if size < WORDS:
            next_list, begins = _ranked(frequent, "code", listed)
            lists.append(next_list)
    return totals, [level.select("lang", "phrase", "a") for level in levels]


def _part(first: int, last: int | None) -> F.Column:
    """The words of a phrase from one place to another, counted from 1."""
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, first, (F.size(words) if last is None else F.lit(last)) - first + 1), " ")


def _scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score): every candidate by its lowest-scoring cut, the earliest of equals.

    Products pass 64 bits, so they are decimals.
    """
    cuts = []
    for size in range(2, WORDS + 1):
        for k in range(1, size):
            cut = levels[size - 1].select("lang", "phrase", "a", F.lit(k).alias("k"), _part(1, k).alias("begin"), _part(k + 1, None).alias("end"))
            begin = levels[k - 1].select("lang", F.col("phrase").alias("begin"), F.col("a").alias("l"))
            end = levels[size - k - 1].select("lang", F.col("phrase").alias("end"), F.col("a").alias("r"))
            cuts.append(cut.join(begin, ["lang", "begin"]).join(end, ["lang", "end"]).select("lang", "phrase", "a", "k", "l", "r"))
    every = cuts[0]
    for cut in cuts[1:]:
        every = every.union(cut)
    scored = every.withColumn("score", F.expr(f"(CAST(a AS DECIMAL(20,0)) * {SCALE}) div (CAST(l AS DECIMAL(20,0)) + r)"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _outer(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, outer): the largest count of a longer candidate that the phrase stands in."""
    parts = []
    for size in range(3, WORDS + 1):
        spans = [_part(i + 1, i + inner) for inner in range(2, size) for i in range(size - inner + 1)]
        parts.append(levels[size - 1].select("lang", "a", F.explode(F.array(*spans)).alias("phrase")))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, listed: int = LISTED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language.

    Null texts have no words, a null lang is `und`; every repeated row counts. Phrases are written
    with single blanks between words.
    """
    totals, levels = frequent_phrases(docs, least, listed)
    within = F.col("outer").isNotNull() & (F.col("outer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * INSIDE)
    kept = _scored(levels).join(_outer(levels), ["lang", "phrase"], "left").filter(~within)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
