"""Spans against Python's patterns, the battery on random and plain strings, and odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlytics.llm import secrets
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def line(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_base(texts[row.doc_id])
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert row.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        all_spans = row.spans.split(",") if row.spans else []
        assert [s for s in all_spans if not s.startswith("random")] == [s for s in line(base).split(",") if s]


def test_query_base(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    check(QUERIES["op10_secret_scan"](spark, SF_DIR).collect(), texts)


def test_random_mixtures(spark):
    draw = random.Random(4)
    parts = [
        "password", "TOKEN", "api_key", "apikey", "Secret", '"', "'", " ", ":", "=", "abc", "AKIA", "AKIA" + "B" * 16,
        "AKIAAKIA", "0123456789abcdef" * 2, "fe" * 11, "é", "😀", "\n", "ſecret", "toKen", "x/y_z.w-=", "AKI", "token=token=",
    ]
    texts = {i: "".join(draw.choice(parts) for _ in range(draw.randrange(30))) for i in range(600)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(secrets.secret_report(docs).collect(), texts)


def p_values(spark, values, alphabet):
    frame = spark.createDataFrame([([float(alphabet.index(c)) for c in v], float(len(alphabet))) for v in values], "x array<double>, k double")
    return [r.p for r in frame.select(secrets.randomness(F.col("x"), F.col("k")).alias("p")).collect()]


def test_battery_tells_random_from_ordered(spark):
    draw = np.random.default_rng(9)
    hexes = "0123456789abcdef"
    fair = ["".join(draw.choice(list(hexes), 48)) for _ in range(300)]
    p = np.array(p_values(spark, fair, hexes))
    assert ((p >= 0) & (p <= 1)).all()
    assert (p < 0.05).mean() < 0.1 and (p < 0.001).mean() < 0.02
    plain = ["a1" * 24, "0" * 47 + "a", "0123456789abcdef" * 3, "aaaaaaaaaaaa111111111111" * 2]
    assert max(p_values(spark, plain, hexes)) < 1e-3


def test_random_strings_are_found_and_plain_ones_dismissed(spark):
    draw = np.random.default_rng(10)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
    keys = ["".join(draw.choice(letters, 40)) for _ in range(80)]
    plain = [f"Section{'a' * (20 + i % 5)}1B" for i in range(60)] + ["internationalization" * 2, "1234567890" * 3]
    docs = spark.createDataFrame(list(enumerate(f"see {t} here" for t in keys + plain)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in secrets.secret_report(docs).collect()}
    found = [i for i in range(len(keys)) if rows[i] == "random:4:44"]
    assert len(found) >= 0.9 * len(keys)
    assert all("random" not in rows[len(keys) + i] for i in range(len(plain)))


def test_procedure_equals_plain_one(spark):
    draw = random.Random(2)
    runs = [(i, draw.randrange(3), draw.choice([0, 3, 30, 100, 240])) for i in range(200)]
    frame = spark.createDataFrame(runs + runs[:50], "code long, class int, bin int")
    battery = secrets.Battery()
    want = {}
    for cls in range(3):
        bins = sorted((b for _, c, b in runs if c == cls), reverse=True)
        for rank, b in enumerate(bins, 1):
            if 10 ** (-b / battery.bins_per_decade) <= battery.false_share * bins.count(b) / len(bins) or (
                10 ** (-b / battery.bins_per_decade) <= battery.false_share * sum(x >= b for x in bins) / len(bins)
            ):
                want[cls] = min(want.get(cls, b), b)
    assert secrets.dismissal_bounds(frame, battery) == want


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("a token = \"abcdef0123\" b", "a [SECRET]\" b"),
        ("é password:abcdef😀", "é [SECRET]😀"),
        ("token=" + "0123456789abcdef" * 2 + " x", "[SECRET] x"),
        ("nothing", "nothing"),
        ("", ""),
        (None, None),
    ],
)
def test_redaction(spark, text, clean):
    docs = spark.createDataFrame([(1, text, 99, "s")], "doc_id long, text string, n_chars int, spans string")
    row = secrets.redacted(docs).first()
    assert (row.text, row.spans) == (clean, "s")
    assert row.n_chars == (None if clean is None else len(clean))


def test_odd_rows(odd_docs, no_docs):
    rows = secrets.secret_report(odd_docs).collect()
    assert len(rows) == 8 and all(r.spans == "" for r in rows)
    assert secrets.secret_report(no_docs).count() == 0
    assert secrets.redacted(no_docs).count() == 0
    assert secrets.redacted(odd_docs).schema == odd_docs.schema


@pytest.mark.parametrize("prefix", ["//example/path/services/hooks/", "aws-secret-access-key-", "user_session_token_", "com/my-app/"])
def test_tokens_behind_names_and_paths_are_found(spark, prefix):
    draw = np.random.default_rng(11)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    keys = [prefix + "".join(draw.choice(letters, 32)) for _ in range(60)]
    plain = [f"Section{'a' * (20 + i % 5)}1B" for i in range(60)] + ["com/my-app/internationalization/Page1"]
    docs = spark.createDataFrame(list(enumerate(f"see {t} here" for t in keys + plain)), "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in secrets.secret_report(docs).collect()}
    found = [i for i in range(len(keys)) if rows[i] == f"random:4:{4 + len(keys[i])}"]
    assert len(found) >= 0.9 * len(keys)
    assert all("random" not in rows[len(keys) + i] for i in range(len(plain)))
    clean = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert all(clean[i] == "see [SECRET] here" for i in found)


def test_many_matches_and_one_long_run(spark):
    draw = random.Random(12)
    hexes = ["".join(draw.choice("0123456789abcdef") for _ in range(32)) for _ in range(6_400)]
    long_run = "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1 << 16))
    texts = {0: "é".join(hexes), 1: f"a {long_run} b", 2: "token=abcdef " * 5_000 + "😀"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.secret_report(docs).collect()}
    check(list(rows.values()), texts)
    assert rows[0].spans.count("random") == 6_400
    assert rows[1].spans == f"random:2:{2 + len(long_run)}"
    clean = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert clean == {0: "é".join(["[SECRET]"] * 6_400), 1: "a [SECRET] b", 2: "[SECRET] " * 5_000 + "😀"}


def test_overlaps_are_cut_like_one_letter_at_a_time(spark):
    draw = random.Random(13)
    cases = []
    for number in range(200):
        text = "".join(draw.choice("ab😀é\n") for _ in range(draw.randrange(1, 5_000)))
        starts = sorted(draw.randrange(len(text)) for _ in range(draw.randrange(1, 12)))
        spans = sorted((s, min(len(text), s + draw.randrange(1, 400))) for s in starts)
        cases.append((number, text, spans))
    frame = spark.createDataFrame(cases, "n long, text string, spans array<struct<start:int,end:int>>")
    got = {r.n: r.clean for r in frame.select("n", secrets._without(F.col("text"), F.col("spans"), "#").alias("clean")).collect()}
    for number, text, spans in cases:
        out, at = [], 0
        for start, end in spans:
            if start >= at:
                out += [text[at:start], "#"]
            at = max(at, end)
        assert got[number] == "".join(out) + text[at:]
