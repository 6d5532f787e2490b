"""Collocations against plain counting and their SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from postlytics.llm import collocations
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

SCHEMA = "doc_id long, lang string, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(rows, top, least):
    counts = {}
    for lang, text in rows:
        found = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            found.update(words[i : i + n] for n in range(1, 5) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        scored = []
        for p in candidates:
            longer = [
                q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * f[q] >= 80 * f[p]
            ]
            if not longer:
                cuts = [(2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -f[p], " ".join(p).encode(), left, right))
        n = sum(v for p, v in f.items() if len(p) == 1)
        out += [
            (lang, rank, phrase.decode(), -a, left, right, n, -score)
            for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1)
        ]
    return sorted(out)


def random_rows(seed, docs=120):
    draw = random.Random(seed)
    words = ["The", "a", "of", "new", "york", "city", "über", "x\x0by", "日本", "z" * 70, "rare", "ab c", "#1"]
    weights = [9, 8, 8, 5, 5, 5, 3, 2, 2, 4, 1, 2, 3]
    return [
        (
            draw.choice(["en", "de", None, ""]),
            draw.choice([None, ""]) if draw.random() < 0.1 else "".join(
                draw.choices(words, weights)[0] + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(draw.randrange(60))
            ),
        )
        for _ in range(docs)
    ]


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(frame, **options).collect())


@pytest.mark.parametrize("listed", [1 << 19, 40, 6, 0])
def test_equals_plain_counting_with_full_and_short_lists(spark, listed):
    rows = random_rows(listed)
    assert found(spark, rows, top=50, least=4, listed=listed) == plain(rows, 50, 4)


def test_tiles_count_every_code():
    draw = np.random.default_rng(3)
    codes = draw.integers(0, 3, 40_000) << 40 | np.minimum(draw.geometric(0.004, 40_000), 900) << 20 | np.minimum(draw.geometric(0.01, 40_000), 900)
    tiles = collocations.Tiles(dense=500, kept=5, buffer=7_000)
    got = Counter()
    for part in np.array_split(codes, 23):
        for numbers, counts in tiles.add(part):
            got.update(dict(zip(numbers.tolist(), counts.tolist())))
    assert len(tiles.known) == 5
    for numbers, counts in tiles.last():
        got.update(dict(zip(numbers.tolist(), counts.tolist())))
    assert got == Counter(codes.tolist())


def test_scores_are_exact_beyond_64_bits(spark):
    big = 6 * 10**15
    two = spark.createDataFrame([("en", "a b", big + 1)], "lang string, phrase string, a long")
    none = two.filter("a < 0")
    one = spark.createDataFrame([("en", "a", big + 7), ("en", "b", big + 2)], "lang string, phrase string, a long")
    row = collocations._scored([one, two, none, none]).first()
    assert row.score == 2000000 * (big + 1) // (2 * big + 9)


def test_whole_table_equals_plain_counting(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_phrase_collocations"](spark, SF_DIR).collect())
    assert got == plain(rows, 2000, 30)


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, collocations.collocations(odd_docs, least=2).collect())) == plain(rows, 2000, 2)
    assert collocations.collocations(no_docs).count() == 0
