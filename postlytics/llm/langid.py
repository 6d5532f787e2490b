"""Language identification by a convolutional network over bytes, trained here with numpy.

A text is cut into windows of a fixed number of bytes that cover all of it. Bytes are embedded,
filters of several widths run over them, each filter's largest answer in the window is kept, and a
softmax layer gives the language. A text's languages are scored by the mean of its windows' log
probabilities, weighted by their letters.

The network is trained on the driver on a bounded sample: for every language the documents with the
smallest hashes, and a few windows of each. It is small (a proven size, below a megabyte) and goes
to the tasks with the function. Filters are applied as table look-ups, since a filter's answer to a
byte in one of its places has only as many values as there are bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices, small_batches

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
BLANK = 256  # fills windows that the text ends in


@dataclass(frozen=True)
class Settings:
    window: int = 192
    embedding: int = 12
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    # the bound of the training sample: documents per language, windows per document
    rows_per_language: int = 600
    windows_per_row: int = 5
    epochs: int = 6
    batch: int = 64
    rate: float = 0.004
    seed: int = 11


def windows_of(text: bytes, size: int) -> np.ndarray:
    """All of a text as rows of `size` bytes; the last one is filled with blanks."""
    count = max(1, -(-len(text) // size))
    rows = np.full(count * size, BLANK, np.int16)
    rows[: len(text)] = np.frombuffer(text, np.uint8)
    return rows.reshape(count, size)


class Network:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: list[str], settings: Settings) -> None:
        draw = np.random.default_rng(settings.seed)
        self.languages, self.settings = languages, settings
        d, n = settings.embedding, settings.filters
        self.weights = {"embed": draw.normal(0, 0.5, (BLANK + 1, d)).astype(np.float32)}
        for width in settings.widths:
            scale = np.sqrt(2 / (width * d))
            self.weights[f"filter{width}"] = draw.normal(0, scale, (width * d, n)).astype(np.float32)
            self.weights[f"shift{width}"] = np.zeros(n, np.float32)
        total = n * len(settings.widths)
        self.weights["out"] = draw.normal(0, np.sqrt(1 / total), (total, len(languages))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(languages), np.float32)
        self.tables: dict[int, list[np.ndarray]] = {}

    def _unfolded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """(window, place, width * embedding) views of the embedded bytes."""
        embedded = self.weights["embed"][rows]
        places = rows.shape[1] - width + 1
        return np.concatenate([embedded[:, j : j + places] for j in range(width)], axis=2)

    def gradients(self, rows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, d = self.weights, self.settings.embedding
        kept, pooled = {}, []
        for width in self.settings.widths:
            views = self._unfolded(rows, width)
            answers = views @ w[f"filter{width}"]
            best = answers.argmax(axis=1)
            top = np.take_along_axis(answers, best[:, None, :], 1)[:, 0] + w[f"shift{width}"]
            kept[width] = (views, best, top > 0)
            pooled.append(np.maximum(top, 0))
        hidden = np.concatenate(pooled, axis=1)
        error = np.exp(self._log_softmax(hidden @ w["out"] + w["bias"]))
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)
        grads = {"out": hidden.T @ error, "bias": error.sum(0), "embed": np.zeros_like(w["embed"])}
        back = error @ w["out"].T
        for k, width in enumerate(self.settings.widths):
            views, best, active = kept[width]
            n = self.settings.filters
            flow = back[:, k * n : (k + 1) * n] * active
            chosen = np.take_along_axis(views, best[:, :, None], 1)  # (window, filter, width * d)
            grads[f"filter{width}"] = np.einsum("bn,bnx->xn", flow, chosen)
            grads[f"shift{width}"] = flow.sum(0)
            to_bytes = flow[:, :, None] * w[f"filter{width}"].T[None]
            for j in range(width):
                taken = np.take_along_axis(rows, best + j, 1)
                np.add.at(grads["embed"], taken, to_bytes[:, :, j * d : (j + 1) * d])
        return grads

    @staticmethod
    def _log_softmax(scores: np.ndarray) -> np.ndarray:
        scores = scores - scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))

    def fit(self, rows: np.ndarray, labels: np.ndarray) -> None:
        """Adam over shuffled batches; some windows are cut short, as short texts are."""
        s = self.settings
        draw = np.random.default_rng(s.seed)
        first = {name: np.zeros_like(value) for name, value in self.weights.items()}
        second = {name: np.zeros_like(value) for name, value in self.weights.items()}
        step, steps = 0, s.epochs * -(-len(rows) // s.batch)
        for _ in range(s.epochs):
            order = draw.permutation(len(rows))
            for at in range(0, len(rows), s.batch):
                chosen = order[at : at + s.batch]
                batch = rows[chosen].copy()
                cut = np.where(draw.random(len(chosen)) < 0.4, draw.integers(8, s.window, len(chosen)), s.window)
                batch[np.arange(s.window)[None, :] >= cut[:, None]] = BLANK
                step += 1
                rate = s.rate * (1 - (step - 1) / steps)
                for name, grad in self.gradients(batch, labels[chosen]).items():
                    first[name] += 0.1 * (grad - first[name])
                    second[name] += 0.001 * (grad * grad - second[name])
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] -= (rate * change).astype(np.float32)
        self.tabulate()

    def tabulate(self) -> None:
        """A filter's answers to each byte in each of its places."""
        d = self.settings.embedding
        self.tables = {
            width: [
                (self.weights["embed"] @ self.weights[f"filter{width}"][j * d : (j + 1) * d]).astype(np.float32)
                for j in range(width)
            ]
            for width in self.settings.widths
        }

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """One row per window."""
        pooled = []
        for width, tables in self.tables.items():
            places = rows.shape[1] - width + 1
            answers = tables[0][rows[:, :places]]
            for j in range(1, width):
                answers += tables[j][rows[:, j : j + places]]
            pooled.append(np.maximum(answers.max(axis=1) + self.weights[f"shift{width}"], 0))
        return self._log_softmax(np.concatenate(pooled, axis=1) @ self.weights["out"] + self.weights["bias"])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, probability) of whole texts; `und` and 0 for those without a letter."""
        result: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        asked = [i for i, text in enumerate(texts) if text and LETTER.search(text)]
        if not self.languages:
            return result
        size, most = self.settings.window, 256
        held: list[np.ndarray] = []
        owners: list[int] = []
        sums = np.zeros((len(texts), len(self.languages)))
        weight = np.zeros(len(texts))

        def flush() -> None:
            if held:
                rows = np.concatenate(held)
                # bytes that may be letters; a window of digits or marks says nothing
                letters = ((rows | 32) >= 97) & ((rows | 32) <= 122) | (rows >= 128) & (rows < BLANK)
                share = letters.sum(axis=1) + 1e-3
                np.add.at(sums, owners, self.log_probabilities(rows) * share[:, None])
                np.add.at(weight, owners, share)
                held.clear()
                owners.clear()

        for i in asked:
            rows = windows_of(texts[i].encode("utf-8", "surrogatepass"), size)
            for at in range(0, len(rows), most):
                held.append(rows[at : at + most])
                owners.extend([i] * len(held[-1]))
                if len(owners) >= most:
                    flush()
        flush()
        for i in asked:
            odds = np.exp(self._log_softmax((sums[i] / weight[i])[None])[0])
            best = int(odds.argmax())
            result[i] = (self.languages[best], float(min(1.0, odds[best])))
        return result


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo four; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 4


HELD_OUT = 2
# parts that a language's rows are dealt to while its sample is drawn
SALTS = 64


def training_windows(labelled: DataFrame, settings: Settings) -> DataFrame:
    """(lang, window): a few windows of the sampled rows of (doc_id, text, lang).

    The hash that a language's sample ends at is one number per language, so the texts are filtered
    where they are read, without a join. Of rows with the same doc_id and lang one is taken.
    """
    hashed = labelled.withColumn("draw", F.xxhash64("doc_id", F.lit(settings.seed)))
    # the smallest hashes of each language: first of each of its salted parts, then of what is left
    ids = hashed.select("doc_id", "lang", "draw").distinct()
    for part in (F.pmod("draw", F.lit(SALTS)), F.lit(0)):
        smallest = Window.partitionBy("lang", part).orderBy("draw", "doc_id")
        ids = ids.withColumn("rank", F.row_number().over(smallest)).filter(F.col("rank") <= settings.rows_per_language)
    ends = ids.groupBy("lang").agg(F.max("draw").alias("end")).collect()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = iter(batch["lang"].to_pylist())
            ids = iter(batch["doc_id"].to_pylist())
            for texts in in_slices(batch["text"]):
                out_lang, out_rows = [], []
                for text in texts:
                    lang, draw = next(langs), np.random.default_rng(abs(next(ids)) + settings.seed)
                    content = text.encode("utf-8", "surrogatepass")
                    for _ in range(settings.windows_per_row):
                        at = int(draw.integers(0, max(1, len(content) - settings.window // 2)))
                        out_lang.append(lang)
                        out_rows.append(content[at : at + settings.window])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_lang, pa.string()), pa.array(out_rows, pa.binary())], ["lang", "window"]
                )

    inside = F.lit(False)
    for row in ends:
        inside = inside | ((F.col("lang") == row["lang"]) & (F.col("draw") <= row["end"]))
    sampled = hashed.filter(inside).dropDuplicates(["doc_id", "lang"]).select("doc_id", "text", "lang")
    return sampled.mapInArrow(cut, "lang string, window binary")


def train(docs: DataFrame, settings: Settings = Settings()) -> Network:
    """A network from the rows of `docs` outside the held-out fold whose lang is known.

    Only text and lang are learned from; doc_id picks the rows. Without such rows the network knows
    no language and predicts `und`.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    labelled = rows.filter((fold(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull())
    labelled = labelled.filter(F.col("text").rlike(r"\p{L}"))
    sample = sorted((r["lang"], bytes(r["window"])) for r in training_windows(labelled, settings).collect())
    languages = sorted({lang for lang, _ in sample})
    network = Network(languages, settings)
    if languages:
        windows = np.concatenate([windows_of(content, settings.window) for _, content in sample])
        place = {lang: i for i, lang in enumerate(languages)}
        labels = np.array([place[lang] for lang, _ in sample])
        network.fit(windows, labels)
    return network


def predicted(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of `docs`, from the text alone.

    A null or empty text, and one without a letter, is `und` with score 0; a row without doc_id is
    not held out. Repeated rows each give a row.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(text: pa.Array) -> pa.Array:
        found = [pair for values in in_slices(text) for pair in shared.value.predict(values)]
        langs, scores = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    rows = docs.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        predict(F.col("text").cast("string")).alias("found"),
    )
    return rows.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
