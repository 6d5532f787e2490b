"""Line-first quality rules.

Every line is judged by its own punctuation, by the marks of navigation bars and by boilerplate
phrases, failing lines are removed, and a text that loses too many of its words is rejected. Each
text is judged alone in one pass over its words, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlytics.llm.common import text_function

# The symbols that the base counts name.
SYMBOLS = "#*$%&|<>"

SENTENCE_MARK = re.compile(r"[.,;:!?…。、！？；：؟।]")
PRESSED_MARK = re.compile(r"[#*$%&|<>~^_={}\\]|!!+|\?\?+")
SEPARATOR = re.compile(r"[|»«›‹>•·/\\~:-]+")
BOILERPLATE = re.compile(
    r"all rights reserved|copyright|©|\(c\) \d{4}|privacy policy|terms of (?:use|service)|cookie"
    r"|javascript|subscribe|newsletter|sign (?:in|up)|log ?in\b|click here|read more|share (?:this|on)"
    r"|powered by|back to top|skip to content",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    # a text must keep this share of its words
    min_kept_percent: int = 50
    # a line may have this share of its characters in pressed marks such as *** or !!
    max_mark_percent: int = 12
    # separators that make a navigation line: so many, and one for so many words
    min_separators: int = 3
    words_per_separator: int = 5
    # phrases of boilerplate count in lines up to this length
    boilerplate_words: int = 25


VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("kept_words", T.LongType()),
    T.StructField("cleaned", T.StringType()),
    T.StructField("failures", T.MapType(T.StringType(), T.LongType())),
])


def repeated_words(words: list) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered[i : i + 3] = b"\x01\x01\x01"
    return sum(covered)


def line_failure(line: str, n_words: int, rules: Rules) -> str | None:
    """The rule that a line with words fails, if any."""
    if n_words <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    bars = sum(bool(SEPARATOR.fullmatch(word)) for word in line.split())
    if bars >= rules.min_separators and bars * rules.words_per_separator >= n_words:
        return "navigation"
    marks = sum(map(len, PRESSED_MARK.findall(line)))
    if marks * 100 > rules.max_mark_percent * len(line) or not SENTENCE_MARK.search(line):
        return "punctuation"
    return None


def judge(text: str | None, rules: Rules) -> dict:
    """Counts, verdict and cleaned text of one document; a null text has no words and stays null."""
    whole = text or ""
    words = whole.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    kept_lines, failures = [], Counter()
    duplicates = kept_words = 0
    for line in whole.split("\n"):
        n_words = len(line.encode("utf-8", "surrogatepass").split())
        if n_words == 0:
            kept_lines.append(line)
            continue
        if line in seen:
            duplicates += 1
            failure = "repeated"
        else:
            seen.add(line)
            failure = line_failure(line, n_words, rules)
        if failure:
            failures[failure] += 1
        else:
            kept_lines.append(line)
            kept_words += n_words
    repeats = repeated_words(words)
    failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
    return {
        "n_words": len(words),
        "word_chars": len(whole) - sum(map(whole.count, "\x20\x09\x0a\x0b\x0c\x0d")),
        "n_symbols": sum(map(whole.count, SYMBOLS)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": not failed and 100 * kept_words >= rules.min_kept_percent * len(words),
        "kept_words": kept_words,
        "cleaned": None if text is None else "\n".join(kept_lines),
        "failures": dict(failures),
    }


def verdict(text: str, rules: Rules = Rules()) -> Column:
    """The verdict struct of a text column."""
    return text_function(lambda value: judge(value, rules), VERDICT, once=True)(F.col(text).cast("string"))


def quality_report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict per row; repeated rows each give one, a null text has no words."""
    judged = docs.select("doc_id", verdict("text", rules).alias("judged"))
    names = [f.name for f in VERDICT if f.name not in ("cleaned", "failures")]
    return judged.select("doc_id", *[F.col(f"judged.{name}").alias(name) for name in names])


def cleaned_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with failing lines removed; the columns stay those of `docs`.

    Where `docs` has n_chars it is counted anew. Other columns, whatever their names, are carried.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    judged = docs.select(row.alias("row"), verdict("text", rules).alias("judged")).filter("judged.kept")
    changed = {"text": F.col("judged.cleaned"), "n_chars": F.char_length("judged.cleaned")}
    return judged.select(*[
        changed.get(field.name, F.col(f"row.`{field.name}`")).cast(field.dataType).alias(field.name)
        for field in docs.schema
    ])
