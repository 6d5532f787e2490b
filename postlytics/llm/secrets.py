"""Secret scans: known shapes, and strings that pass a battery of randomness tests.

Base spans come from three patterns. The method looks at every unbroken run of code characters,
infers its encoding from the characters it holds, and tests whether its symbols could be drawn
uniformly at random: chi-squared over the alphabet, Wald-Wolfowitz runs of high and low symbols,
and lag-one serial correlation. The smallest p-value, times three, is the run's p-value. Parts of a
run between separators are tested like runs, each by its own encoding, as names and paths in front
of a token would hide it. Strings that are not random are dismissed by the Benjamini-Hochberg
procedure over all distinct strings of their length class, which bounds the share of random ones
among those dismissed; a run is a span when it or one of its parts is not dismissed.

All of it is DataFrame code. Positions are running sums of the lengths of matches and of the gaps
between them, so work is near linear in the matches of a text. P-values are counted in bins, so the procedure reads a few hundred rows per length class; its
result is one number per class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import saved, whole_text

# Kinds in their order, with the pattern of a match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# these match whole runs, so the lower bound on their length finds the same spans
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6

RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
MIN_RUN = 20
# What may join a token to other words. Each set is tried alone too, as the two others
# belong to the code of the token itself.
SEPARATORS = ("[/_+-]", "[/+]", "[_-]")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings by the pattern that a run must match, most special first; each needs
# letters and digits, as words and numbers alone are no code.
ENCODINGS = (
    (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + LOWER[:6]),
    (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + UPPER[:6]),
    (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", DIGITS + LOWER),
    (r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", DIGITS + UPPER),
    (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
    (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
)

# Coefficients of a rational approximation of the normal tail.
ERFC = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


@dataclass(frozen=True)
class Battery:
    # share of random strings among the dismissed runs of a length class
    false_share: float = 0.05
    # lower bounds of the length classes
    classes: tuple[int, ...] = (20, 24, 32, 48, 64, 128)
    # p-values are counted in bins of this many to a power of ten, down to the smallest
    bins_per_decade: int = 20
    decades: int = 12


SPOT = "struct<start:int,end:int,value:string>"
SPAN = "struct<start:int,rank:int,end:int>"


def _named(value: Column, use) -> Column:
    """`use` of a value that is evaluated once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(items: Column, combine) -> Column:
    """Each item combined with all before it, by `combine(earlier, item)`, which keeps the type.

    Rounds of doubling reach: as many passes as the length has bits, none copies what it has found.
    """
    reaches = F.array(*[F.lit(1 << bit) for bit in range(31)])
    return F.aggregate(
        reaches,
        items,
        lambda done, reach: F.when(
            F.size(done) > reach,
            F.transform(done, lambda item, i: F.when(i >= reach, combine(F.get(done, i - reach), item)).otherwise(item)),
        ).otherwise(done),
    )


def occurrences(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, value>>: leftmost matches in code points, with one of their groups."""
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), group).alias("value"),
    )
    matches = F.filter(pieces, lambda p: p["size"].isNotNull())
    ended = _running(
        F.transform(matches, lambda p: F.struct(p["size"], (p["gap"] + p["size"]).alias("end"), p["value"])),
        lambda earlier, p: F.struct(p["size"], (earlier["end"] + p["end"]).alias("end"), p["value"]),
    )
    found = F.transform(
        ended, lambda p: F.struct((p["end"] - p["size"]).alias("start"), p["end"], p["value"]).cast(SPOT)
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPOT}>"))


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, end>> of the three patterns; rank is the kind's place in KINDS."""
    named = (
        F.filter(occurrences(text, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= MIN_VALUE),
        occurrences(text, ACCESS),
        occurrences(text, HEX),
    )
    return F.array_sort(F.concat(*[_spans(found, rank) for rank, found in enumerate(named)]))


def _spans(found: Column, rank: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")).cast(SPAN),
    )


def tested_runs(text: Column, battery: Battery = Battery()) -> Column:
    """array<struct<start, end, code, class, bin>>: runs and their parts that have an encoding.

    Places are those of the whole run; code, class and bin of the p-value are the tested string's.
    """
    strings = F.flatten(F.transform(
        occurrences(text, RUN),
        lambda m: F.transform(
            F.array_distinct(F.concat(F.array(m["value"]), _parts(m["value"]))),
            lambda v: F.struct(m["start"].alias("start"), m["end"].alias("end"), v.alias("value"), _alphabet(v).alias("alphabet")),
        ),
    ))
    coded = F.filter(strings, lambda m: m["alphabet"].isNotNull())
    valued = F.transform(
        coded,
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.xxhash64(m["value"]).alias("code"),
            F.char_length(m["value"]).alias("length"),
            F.char_length(m["alphabet"]).cast("double").alias("k"),
            F.transform(F.split(F.rtrim(m["value"], F.lit("=")), ""), lambda c: (F.call_function("locate", c, m["alphabet"]) - 1).cast("double")).alias("x"),
        ),
    )
    return F.transform(
        valued,
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["code"].alias("code"),
            _length_class(m["length"], battery).alias("class"),
            _bin(randomness(m["x"], m["k"]), battery).alias("bin"),
        ),
    )


def _parts(value: Column) -> Column:
    """Parts between separators that are as long as a run must be."""
    parts = F.concat(*[F.split(value, separators, -1) for separators in SEPARATORS])
    return F.filter(parts, lambda p: F.char_length(F.rtrim(p, F.lit("="))) >= MIN_RUN)


def _alphabet(value: Column) -> Column:
    found = F.lit(None).cast("string")
    for pattern, alphabet in reversed(ENCODINGS):
        found = F.when(value.rlike(pattern), F.lit(alphabet)).otherwise(found)
    return found


def _length_class(length: Column, battery: Battery) -> Column:
    found = F.lit(0)
    for number, bound in enumerate(battery.classes):
        found = F.when(length >= bound, F.lit(number)).otherwise(found)
    return found


def _two_sided(z: Column) -> Column:
    """Probability that a normal variable is as far from zero."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = F.lit(0.0)
    for coefficient in reversed(ERFC):
        poly = (poly + coefficient) * t
    return poly * F.exp(-x * x)


def _upper_tail(z: Column) -> Column:
    half = _two_sided(z) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _squares(values: Column) -> Column:
    """Sum of the squared counts of equal values: of sorted ones, each adds what its turn adds to a square."""
    return F.aggregate(
        F.sort_array(values),
        F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("turn"), F.lit(0.0).alias("sum")),
        lambda state, v: F.struct(
            v.alias("last"),
            F.when(v == state["last"], state["turn"] + 2).otherwise(1.0).alias("turn"),
            (state["sum"] + F.when(v == state["last"], state["turn"] + 2).otherwise(1.0)).alias("sum"),
        ),
        lambda state: state["sum"],
    )


def randomness(x: Column, k: Column) -> Column:
    """p-value of symbols `x` (numbers below `k`) under uniform, independent draws."""
    n = F.size(x).cast("double")
    # chi-squared over the alphabet, by the cube-root approximation of its tail
    squares = _squares(x)
    chi = squares * k / n - n
    spread = 2 / (9 * (k - 1))
    uniform = _upper_tail((F.pow(chi / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))
    # runs of symbols in the upper and lower half of the alphabet
    high = F.transform(x, lambda v: (2 * v >= k).cast("double"))
    n1 = _total(high)
    n2 = n - n1
    steps = F.arrays_zip(
        F.slice(high, 1, F.size(high) - 1).alias("a"), F.slice(high, 2, F.size(high) - 1).alias("b")
    )
    runs = 1 + _total(F.transform(steps, lambda s: F.abs(s["a"] - s["b"])))
    mean = 2 * n1 * n2 / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = F.when(variance > 0, _two_sided((runs - mean) / F.sqrt(variance))).otherwise(F.lit(0.0))
    # correlation of each symbol with the next
    serial_p = _named(_total(x) / n, lambda middle: _serial(x, n, middle))
    return F.least(F.lit(1.0), 3 * F.least(uniform, runs_p, serial_p))


def _serial(x: Column, n: Column, middle: Column) -> Column:
    around = F.transform(x, lambda v: v - middle)
    pairs = F.arrays_zip(
        F.slice(around, 1, F.size(x) - 1).alias("a"), F.slice(around, 2, F.size(x) - 1).alias("b")
    )
    power = _total(F.transform(around, lambda v: v * v))
    lag = _total(F.transform(pairs, lambda s: s["a"] * s["b"])) / power
    return F.when(power > 0, _two_sided((lag + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))


def _bin(p: Column, battery: Battery) -> Column:
    """Number of the bin; bin b holds p-values up to 10 ** (-b / bins_per_decade)."""
    last = battery.decades * battery.bins_per_decade
    depth = F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * battery.bins_per_decade)
    return F.least(F.lit(last), F.greatest(F.lit(0), depth)).cast("int")


def dismissal_bounds(runs: DataFrame, battery: Battery = Battery()) -> dict[int, int]:
    """class -> smallest dismissed bin, by Benjamini-Hochberg over distinct runs (code, class, bin).

    One number per length class reaches the driver; classes without dismissals are missing.
    """
    counts = runs.select("code", "class", "bin").distinct().groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n"))
    per_class = Window.partitionBy("class")
    ranked = counts.select(
        "class", "bin",
        F.sum("n").over(per_class).alias("m"),
        F.sum("n").over(per_class.orderBy(F.desc("bin"))).alias("rank"),
    )
    edge = F.pow(F.lit(10.0), -F.col("bin") / battery.bins_per_decade)
    dismissed = ranked.filter(edge <= battery.false_share * F.col("rank") / F.col("m"))
    return {row["class"]: row["bin"] for row in dismissed.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def random_spans(runs: Column, bounds: dict[int, int]) -> Column:
    """Spans of the runs that are not dismissed, or have a part that is not; each once."""

    def dismissed(run: Column) -> Column:
        found = F.lit(False)
        for number, bound in sorted(bounds.items()):
            found = found | ((run["class"] == number) & (run["bin"] >= bound))
        return found

    # strings of one run follow each other
    left = _spans(F.filter(runs, lambda run: ~dismissed(run)), KINDS.index("random"))
    return _named(left, lambda spans: F.filter(spans, lambda s, i: (i == 0) | (F.get(spans, i - 1)["start"] != s["start"])))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ","
    )


def _scanned(docs: DataFrame, battery: Battery) -> DataFrame:
    rows = docs.select("doc_id", whole_text().alias("whole"))
    return rows.select(
        "doc_id", base_spans(F.col("whole")).alias("base"), tested_runs(F.col("whole"), battery).alias("runs")
    )


def _has_rank(rank: int):
    return lambda span: span["rank"] == rank


def secret_report(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row; null texts are empty.

    Repeated rows each give a row and count once in the procedure, as do all copies of a run.
    """
    scanned = saved(_scanned(docs, battery), "secrets")
    bounds = dismissal_bounds(scanned.select(F.explode("runs").alias("run")).select("run.*"), battery)
    spans = F.array_sort(F.concat("base", random_spans(F.col("runs"), bounds)))
    counts = [
        F.size(F.filter("base", _has_rank(rank))).cast("long").alias(f"n_{kind}")
        for rank, kind in enumerate(KINDS[:3])
    ]
    return scanned.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(spans).alias("spans")
    )


# Code points of a block: what a cut reads beside its own text.
BLOCK_BITS = 10


def _between(blocks: Column, start: Column, end: Column) -> Column:
    """The text of two places from the blocks that it touches."""
    size = 1 << BLOCK_BITS

    def part(number: Column) -> Column:
        first = F.greatest(start - number * size, F.lit(0))
        return F.substring(F.get(blocks, number), first + 1, F.least(end - number * size, F.lit(size)) - first)

    touched = F.sequence(F.shiftright(start, BLOCK_BITS), F.shiftright(end - 1, BLOCK_BITS))
    return F.when(start < end, F.array_join(F.transform(touched, part), "")).otherwise("")


def _without(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark for every group of overlapping spans, which are sorted and not empty."""
    reached = _running(
        F.transform(spans, lambda s: F.struct(s["start"], s["end"])),
        lambda earlier, s: F.struct(s["start"], F.greatest(earlier["end"], s["end"]).alias("end")),
    )
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))

    def joined_pieces(reached: Column, blocks: Column) -> Column:
        between = F.transform(
            reached,
            lambda s, i: F.struct(F.coalesce(F.get(reached, i - 1)["end"], F.lit(0)).alias("start"), s["start"].alias("end")),
        )
        kept = F.filter(between, lambda p: p["start"] <= p["end"])
        tail = F.struct(F.element_at(reached, -1)["end"].alias("start"), F.char_length(text).alias("end"))
        pieces = F.concat(kept, F.array(tail))
        return F.array_join(F.transform(pieces, lambda p: _between(blocks, p["start"], p["end"])), mark)

    return _named(reached, lambda reached: _named(blocks, lambda blocks: joined_pieces(reached, blocks)))


def redacted(docs: DataFrame, mark: str = "[SECRET]", battery: Battery = Battery()) -> DataFrame:
    """All rows with every span of the text replaced by a mark; the columns are those of `docs`.

    Overlapping spans give one mark, n_chars is counted anew where it is present, null texts stay.
    Texts are scanned once; rows are saved with what was found, as the bounds need all of it.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    found = docs.select(
        row.alias("row"), base_spans(whole_text()).alias("base"), tested_runs(whole_text(), battery).alias("runs")
    )
    scanned = saved(found, "redacted")
    bounds = dismissal_bounds(scanned.select(F.explode("runs").alias("run")).select("run.*"), battery)
    text = F.col("row.text").cast("string")
    spanned = scanned.select(
        "row", text.alias("text"), F.array_sort(F.concat("base", random_spans(F.col("runs"), bounds))).alias("spans")
    )
    cut = _without(F.col("text"), F.col("spans"), mark)
    changed = spanned.select("row", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias("clean"))
    values = {"text": F.col("clean"), "n_chars": F.char_length("clean")}
    return changed.select(*[
        values.get(field.name, F.col(f"row.`{field.name}`")).cast(field.dataType).alias(field.name)
        for field in docs.schema
    ])
