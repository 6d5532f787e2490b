"""A gated recurrent language model in numpy, trained where the texts are.

Tokens are lower-cased words and one end per text. The frequent words of the training texts are
sorted into classes of equal share of the square roots of their counts; the output is factored into
the class, by one softmax, and the word within its class, by another. The last class stands for all
other words, which share it by their counts. The hidden state of a text passes from window to window,
so the log-likelihood of a text is that of the whole; gradients stop at the window (truncated
backpropagation).

Training runs in rounds over disjoint shares of the training texts: every task reads its texts whole,
a window of many lanes at a time, takes one step a window on all of its tokens, and hands its
weights on; Spark averages them by tokens, with
whole numbers, so the mean does not depend on the order of tasks. Weights are a few hundred thousand
numbers, whatever the input. The biases start at the counts, so the first model is
the base, the smoothed counts of single words.

All counts cover all training texts. The most frequent words are broadcast with their counts, at most
`LISTED` of them; other words of a text are looked up by a join.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import most_frequent, saved

# The share of texts held out, the smoothing of counts, and the token behind a text
# (a blank, which no word is).
FOLDS, HELD_OUT, SMOOTH, END = 5, 1, 0.5, b" "

# Words with an output of their own, classes of them, input rows that other words share.
SHORT_LIST, CLASSES, BUCKETS = 2048, 32, 64
HIDDEN, EMBEDDED = 24, 16
# Words broadcast with their counts, none longer than LONGEST bytes.
LISTED, LONGEST = 1 << 19, 64
# Training: rounds, step size, first squares, largest gradient.
ROUNDS, RATE, FIRST, CLIP = 3, 0.1, 1e-7, 1.0
# Tokens of a window; lanes: one for so many tokens of a pool, so many at most; tokens of a pool.
WINDOW, LANE_TOKENS, LANES, POOL = 8192, 512, 512, 1 << 21
# Words that a task counts before it hands counts on; bytes of texts that are split and looked up at once.
COUNTED, PORTION = 1 << 21, 1 << 21
# Weights are averaged as whole multiples of this, and these as multiples of a power of two and a rest.
UNIT, HALF = 2.0**-24, 20

Weights = dict[str, np.ndarray]


def portions(batches: Iterator[pa.RecordBatch], most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have `most` bytes or more, by no more than a text and `most`."""
    held, size = [], 0
    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(), dtype=np.int64), 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            end = max(int(np.searchsorted(ends, before + most, "right")), at + 1)
            held.append(batch.slice(at, end - at))
            size, at = size + int(ends[end - 1]) - before, end
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the lower-cased words of all texts one after the other, how many each text has); a null text has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    filled = pc.greater(pc.binary_length(words), 0)  # blanks at either end of a text leave an empty word there
    of = pc.list_parent_indices(lists).filter(filled).to_numpy()
    return words.filter(filled), np.bincount(of, minlength=len(texts))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is held out of training; one without doc_id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c): occurrences in all training texts, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, ends = [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            words, numbers = pc.value_counts(pa.chunked_array(parts, pa.string())).flatten()
            for at in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([words.slice(at, 1 << 16), numbers.slice(at, 1 << 16)], ["token", "c"])
            parts.clear()

        for rows in portions(batches):
            words, numbers = words_of(rows["text"])
            parts.append(words.cast(pa.string()))
            held, ends = held + len(words), ends + len(numbers)
            if held > COUNTED:
                yield from flush()
                held = 0
        yield from flush()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END.decode()]), pa.array([ends], pa.int64())], ["token", "c"])

    texts = docs.filter(~held_out()).select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Listed words by falling count, the end first; `total` and `kinds` are of all training tokens."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    kinds: int
    whole: bool

    def __post_init__(self) -> None:
        self.short = min(SHORT_LIST, len(self.words))
        share = np.sqrt(self.counts[: self.short].astype(np.float64) + SMOOTH)
        of_word = (np.cumsum(share) - share) / share.sum() * CLASSES
        self.starts = np.unique(of_word.astype(np.int64), return_index=True)[1]
        self.ends = np.append(self.starts[1:], self.short)
        sizes = self.ends - self.starts
        rest = len(self.starts)
        self.of_class = np.append(np.repeat(np.arange(rest), sizes), rest).astype(np.int64)
        hashes = np.fromiter(map(zlib.crc32, self.words[self.short :]), np.int64, len(self.words) - self.short)
        # the input row of every listed word, worked out once and not in each task
        self.rows = np.concatenate([np.arange(self.short), self.short + hashes % BUCKETS]).astype(np.int32)
        self.rest_norm = np.log10(
            self.total - int(self.counts[: self.short].sum()) + SMOOTH * (self.kinds - int((self.counts[: self.short] > 0).sum()) + 1)
        )

    @cached_property
    def encoder(self) -> Encoder:
        """Made once a Python worker, which keeps a broadcast vocabulary from task to task."""
        return Encoder(self)

    def first_weights(self) -> Weights:
        draw = np.random.default_rng(1)
        wide = lambda *shape: (draw.standard_normal(shape) * shape[0] ** -0.5).astype(np.float32)
        counts = self.counts[: self.short].astype(np.float64) + SMOOTH
        classes = np.append(np.add.reduceat(counts, self.starts), 10.0**self.rest_norm)
        return {
            "embed": wide(self.short + BUCKETS + 1, EMBEDDED), "input": wide(EMBEDDED, 3 * HIDDEN),
            "state": wide(HIDDEN, 3 * HIDDEN), "gates": np.zeros(3 * HIDDEN, np.float32),
            "class": np.zeros((HIDDEN, len(classes)), np.float32), "class_bias": np.log(classes / classes.sum()).astype(np.float32),
            "word": np.zeros((self.short, HIDDEN), np.float32), "word_bias": np.log(counts).astype(np.float32),
        }


def read_vocabulary(counts: DataFrame, listed: int = LISTED) -> Vocabulary:
    end = END.decode()
    total, kinds, ends = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count("c"), F.coalesce(F.sum(F.when(F.col("token") == end, F.col("c"))), F.lit(0))
    ).first()
    usable = counts.filter((F.col("token") != end) & (F.octet_length("token") <= LONGEST))
    top = most_frequent(usable, "c", listed).orderBy(F.desc("c"), "token").toArrow()
    words = [END, *(word.encode() for word in top["token"].to_pylist())]
    numbers = np.concatenate([[ends], top["c"].to_numpy()]).astype(np.int64)
    return Vocabulary(words, numbers, total, kinds, len(words) - (ends == 0) == kinds)


@dataclass
class Encoded:
    """Texts as tokens, one text after the other; `words` and `listed` are without the ends of texts."""

    starts: np.ndarray
    ids: np.ndarray
    inputs: np.ndarray
    targets: np.ndarray
    words: pa.Array
    counts: np.ndarray
    listed: np.ndarray

    def texts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(input rows, targets) of each text."""
        return zip(np.split(self.inputs, self.starts[1:]), np.split(self.targets, self.starts[1:]))

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        """Sums by text of a number for each token; no text is without tokens."""
        return np.add.reduceat(numbers, self.starts)

    def unlisted(self) -> pa.Array:
        """A list by text of its words that are not listed."""
        others = np.append(0, np.cumsum(~self.listed))[np.append(0, np.cumsum(self.counts))]
        words = self.words.filter(pa.array(~self.listed)).cast(pa.string())
        return pa.ListArray.from_arrays(pa.array(others, pa.int32()), words)


class Encoder:
    """Texts as ids: listed words by their place, others -1; and input rows and targets of the model."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.short, self.rows = vocabulary.short, vocabulary.rows
        self.start = self.short + BUCKETS
        self.frequent = pa.array(vocabulary.words[: self.short], pa.binary())
        self.ids = {word: i for i, word in enumerate(vocabulary.words)}

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, input rows) of words: those of the short list in one pass, of others each different one once."""
        words = words.cast(pa.binary())
        ids = pc.fill_null(pc.index_in(words, value_set=self.frequent), -1).to_numpy().astype(np.int64)
        rows, others = ids.astype(np.int32), np.flatnonzero(ids < 0)
        if len(others):
            rare = words.filter(pa.array(ids < 0)).dictionary_encode()
            codes, kinds = rare.indices.to_numpy(), len(rare.dictionary)
            # no word holds a blank; a list of all is slower to get from Arrow than one text
            names = pc.binary_join(pa.ListArray.from_arrays([0, kinds], rare.dictionary), b" ")[0].as_py().split()
            known = np.fromiter(map(self.ids.get, names, repeat(-1)), np.int64, kinds)
            taken, unknown = self.rows[known], np.flatnonzero(known < 0)
            hashes = np.fromiter(map(zlib.crc32, map(names.__getitem__, unknown.tolist())), np.int64, len(unknown))
            taken[unknown] = self.short + hashes % BUCKETS
            ids[others], rows[others] = known[codes], taken[codes]
        return ids, rows

    def targets(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, np.minimum(ids, self.short), self.short).astype(np.int32)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, input rows, targets): the input of a token is the one before it, of the first the start."""
        ids, rows = self.look_up(pa.array(words, pa.binary()))
        return ids, np.append(np.int32(self.start), rows)[:-1], self.targets(ids)

    def encode_texts(self, texts: pa.Array) -> Encoded:
        """The same of a column of texts."""
        words, counts = words_of(texts)
        found, rows = self.look_up(words)
        ends = np.cumsum(counts + 1)
        starts = ends - counts - 1
        inside = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        inside[ends - 1] = False
        place = np.flatnonzero(inside)
        ids, inputs = np.zeros(len(inside), np.int64), np.empty(len(inside), np.int32)  # the end is the first listed word
        ids[place], inputs[place + 1], inputs[starts] = found, rows, self.start
        return Encoded(starts, ids, inputs, self.targets(ids), words, counts, found >= 0)


class Lanes:
    """Texts dealt to lanes, longest first to the shortest lane; a lane is one text after the other.

    Lanes are sorted by length, so those with tokens left are always the first ones.
    """

    def __init__(self, texts: list[tuple[np.ndarray, np.ndarray]], lanes: int | None = None) -> None:
        if lanes is None:
            lanes = min(LANES, sum(len(text[0]) for text in texts) // LANE_TOKENS + 1)
        heap = [(0, lane) for lane in range(min(lanes, len(texts)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for text in sorted(range(len(texts)), key=lambda i: (-len(texts[i][0]), i)):
            length, lane = heap[0]
            dealt[lane].append(text)
            heapq.heapreplace(heap, (length + len(texts[text][0]), lane))
        dealt.sort(key=lambda own: -sum(len(texts[i][0]) for i in own))
        self.lengths = np.array([sum(len(texts[i][0]) for i in own) for own in dealt], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        every = [i for own in dealt for i in own]
        joined = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int32)
        self.inputs = joined([texts[i][0] for i in every])
        self.targets = joined([texts[i][1] for i in every])
        self.texts = np.repeat(np.array(every, np.int32), [len(texts[i][0]) for i in every])

    def windows(self, start: int, tokens: int = WINDOW) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(lanes, inputs, targets, texts, first, valid) by step and lane; `first` marks first tokens.

        The fewer lanes are left, the more steps a window has. A lane that has ended repeats its last
        token where it is not valid.
        """
        at = 0
        while lanes := int((self.lengths > at).sum()):
            width = min(max(tokens // lanes, 1), int(self.lengths[0]) - at)
            step, lengths = np.arange(at, at + width)[:, None], self.lengths[:lanes]
            place = self.starts[:lanes] + np.minimum(step, lengths - 1)
            inputs, valid = self.inputs[place], step < lengths
            yield lanes, inputs, self.targets[place], self.texts[place], inputs == start, valid
            at += width


class Network:
    """Forward and backward passes over windows.

    Inside, lanes come last: numbers of one kind lie side by side for all lanes, which numpy works on
    several times as fast as on rows of a few numbers each.
    """

    def __init__(self, weights: Weights, vocabulary: Vocabulary) -> None:
        self.w, self.v = weights, vocabulary
        self.size = weights["state"].shape[0]
        self.rooms: dict[str, np.ndarray] = {}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """Memory kept from window to window; new pages for every window cost more than the work in them."""
        length = math.prod(shape)
        if name not in self.rooms or len(self.rooms[name]) < length:
            self.rooms[name] = np.empty(length, self.w["state"].dtype)
        return self.rooms[name][:length].reshape(shape)

    def input_table(self) -> np.ndarray:
        """What every input row adds to the powers of the gates."""
        return (self.w["embed"] @ self.w["input"] + self.w["gates"]) * self.signs()

    def signs(self) -> np.ndarray:
        """Factors of the gates' sums: sigmoid(x) is 1 / (1 + exp(-x)) and tanh(x) is 2 / (1 + exp(-2x)) - 1.

        An exponential takes numpy half as long as a tanh; the factors are powers of two, so nothing is rounded.
        """
        return np.repeat(np.array([-1, -1, -2], self.w["state"].dtype), self.size)

    def forward(self, state: np.ndarray, inputs: np.ndarray, first: np.ndarray, table: np.ndarray | None = None):
        """States (steps, lanes, hidden) from the state before; without `table` also what a gradient needs.

        That is, by step: the state before, both gates, the new part and -2 times its recurrent term, each by hidden
        unit and lane.
        """
        w, size = self.w, self.size
        rows = self.input_table() if table is None else table
        recur = w["state"].T * self.signs()[:, None]
        steps, lanes = inputs.shape
        states = self.room("states", steps, size, lanes)
        kept = None if table is not None else self.room("kept", steps, 5, size, lanes)
        state = state.T.copy()
        with np.errstate(over="ignore"):  # of an infinite power the gate is zero
            self._steps(rows, recur, state, inputs, first, states, kept)
        # by hidden unit, then step and lane: so rows of states are columns that lie side by side
        return states.transpose(1, 0, 2).copy().transpose(1, 2, 0), kept

    def _steps(self, rows, recur, state, inputs, first, states, kept) -> None:
        """Fills `states` and, unless it is None, `kept`."""
        size, (steps, lanes) = self.size, inputs.shape
        starts = first.any(axis=1)
        taken, recurrent = self.room("taken", lanes, 3 * size), self.room("recurrent", 3 * size, lanes)
        gates, masked = self.room("step", 3, size, lanes), self.room("masked", size, lanes)
        for t in range(steps):
            before = np.multiply(state, ~first[t], out=masked) if starts[t] else state
            np.matmul(recur, before, out=recurrent)
            np.take(rows, inputs[t], axis=0, out=taken, mode="clip")
            if kept is not None:
                gates = kept[t, 1:4]
                kept[t, 0], kept[t, 4] = before, recurrent[2 * size :]
            np.copyto(gates, taken.T.reshape(3, size, lanes))
            both, (update, reset, new) = gates[:2], gates
            both += recurrent[: 2 * size].reshape(2, size, lanes)
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            recurrent[2 * size :] *= reset
            new += recurrent[2 * size :]
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            state = states[t]
            np.subtract(before, new, out=state)
            state *= update
            state += new

    def likelihood(self, states: np.ndarray, targets: np.ndarray, valid: np.ndarray, gradient: Weights | None = None):
        """Natural log-probabilities of the valid targets (the rest class as a whole) of rows of states.

        With `gradient`, output gradients of their negative sum are added to it, and those of all rows of states returned.
        """
        w, v = self.w, self.v
        classes = v.of_class[targets].astype(np.int16)
        order = np.argsort(np.where(valid, classes, np.int16(len(v.starts) + 1)), kind="stable")[: np.count_nonzero(valid)]
        # columns of a class follow each other; a last row of ones takes the biases
        size, many = self.size, len(order)
        columns = self.room("chosen", size + 1, many)
        np.take(states.T, order, axis=1, mode="clip", out=columns[:size])
        columns[size] = 1
        targets = targets[order]
        classes, wanted = classes[order].astype(np.int64), gradient is not None
        at = np.arange(many)
        of_class, of_word = np.vstack([w["class"], w["class_bias"]]).T, np.column_stack([w["word"], w["word_bias"]])
        logits = np.matmul(of_class, columns, out=self.room("classes", len(of_class), many))
        found, powers = _softmax(logits, classes, at, wanted)
        if wanted:
            summed = columns @ powers.T
            gradient["class"] += summed[:size]
            gradient["class_bias"] += summed[size]
            back = self.room("back", size, many + 1)
            back[:, many] = 0  # what a row that is not valid gets
            np.matmul(w["class"], powers, out=back[:, :many])
        bounds = np.searchsorted(classes, np.arange(len(v.starts) + 1))
        for c, (start, end) in enumerate(zip(v.starts, v.ends)):
            own = slice(bounds[c], bounds[c + 1])
            if end - start == 1 or own.start == own.stop:
                continue
            chosen, inside = columns[:, own], targets[own] - start
            more, powers = _softmax(of_word[start:end] @ chosen, inside, at[: own.stop - own.start], wanted)
            found[own] += more
            if wanted:
                summed = powers @ chosen.T
                gradient["word"][start:end] += summed[:, :size]
                gradient["word_bias"][start:end] += summed[:, size]
                back[:, own] += w["word"][start:end].T @ powers
        log, spread = np.zeros(len(valid), found.dtype), None
        log[order] = found
        if wanted:
            place = np.full(len(valid), many)
            place[order] = at
            spread = np.take(back, place, axis=1, mode="clip", out=self.room("spread", size, len(valid))).T
        return log[valid], spread

    def gradient(self, state, inputs, targets, first, valid) -> tuple[float, Weights, np.ndarray]:
        """(negative log-likelihood, its gradient, last state) of a window; the first state is given."""
        w, size = self.w, self.size
        grad = {name: np.zeros_like(value) for name, value in w.items()}
        states, kept = self.forward(state, inputs, first)
        found, spread = self.likelihood(states.reshape(-1, size), targets.ravel(), valid.ravel(), grad)
        steps, lanes = inputs.shape
        above = self.room("above", steps, size, lanes)
        above[:] = spread.T.reshape(size, steps, lanes).transpose(1, 0, 2)
        before, update, reset, new, recurrent = kept.swapaxes(0, 1)
        by_new = self.room("by_new", steps, size, lanes)
        np.multiply(new, new, out=by_new)
        np.subtract(1, by_new, out=by_new)
        # what a step's gradient is multiplied by, in the loop the product: the recurrent term, both gates, the new part
        gates = self.room("gates", steps, 4, size, lanes)
        np.subtract(1, update, out=gates[:, 1])
        by_new *= gates[:, 1]
        gates[:, 1] *= update
        np.subtract(before, new, out=gates[:, 3])
        gates[:, 1] *= gates[:, 3]
        np.multiply(by_new, reset, out=gates[:, 0])
        np.subtract(1, reset, out=gates[:, 2])
        gates[:, 2] *= gates[:, 0]
        gates[:, 2] *= recurrent
        gates[:, 2] *= -0.5
        # the states see the recurrent term and both gates, in this order, the inputs both gates and the new part
        by_state, by_input = gates[:, :3].reshape(steps, 3 * size, lanes), gates[:, 1:].reshape(steps, 3 * size, lanes)
        back_state = np.concatenate([w["state"][:, 2 * size :], w["state"][:, : 2 * size]], axis=1)
        carried, starts = np.zeros_like(above[0]), first.any(axis=1)
        through = np.empty_like(carried)
        for t in range(steps - 1, -1, -1):
            above[t] += carried
            gates[t, :3] *= above[t]
            np.matmul(back_state, by_state[t], out=carried)
            carried += np.multiply(above[t], update[t], out=through)
            if starts[t]:
                carried *= ~first[t]
        np.multiply(above, by_new, out=gates[:, 3])
        states_grad = (before @ by_state.transpose(0, 2, 1)).sum(axis=0)
        grad["state"] += np.concatenate([states_grad[:, size:], states_grad[:, :size]], axis=1)
        grad["gates"] += by_input.sum(axis=0).sum(axis=1)
        embedded = np.take(w["embed"], inputs, axis=0, mode="clip", out=self.room("embedded", steps, lanes, w["embed"].shape[1]))
        grad["input"] += (embedded.transpose(0, 2, 1) @ by_input.transpose(0, 2, 1)).sum(axis=0)
        by_embedded = np.matmul(w["input"], by_input, out=self.room("by_embedded", steps, len(w["input"]), lanes))
        places = inputs.ravel()
        for unit in range(by_embedded.shape[1]):
            grad["embed"][:, unit] += np.bincount(places, by_embedded[:, unit].ravel(), len(grad["embed"]))
        return -float(found.sum()), grad, states[-1]


def _softmax(logits: np.ndarray, chosen: np.ndarray, at: np.ndarray, wanted: bool):
    """Log-probabilities of the chosen outputs and, if wanted, the gradient of their negative sum; outputs by rows."""
    logits -= logits.max(axis=0)
    flat, place = logits.reshape(-1), chosen * logits.shape[1] + at
    found = flat[place]
    np.exp(logits, out=logits)
    sums = logits.sum(axis=0)
    found -= np.log(sums)
    if wanted:
        logits /= sums
        flat[place] -= 1
    return found, logits


def train_on(weights: Weights, vocabulary: Vocabulary, texts: Iterator[list[bytes]]) -> tuple[Weights, int]:
    """(weights after the texts, tokens learnt from) for texts as lists of words."""
    return train_on_encoded(weights, vocabulary, (vocabulary.encoder.encode(words)[1:] for words in texts))


def train_on_encoded(weights: Weights, vocabulary: Vocabulary, texts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[Weights, int]:
    """(weights after the texts, tokens learnt from), by steps of Adagrad; every token is in one step."""
    weights = {name: value.copy() for name, value in weights.items()}
    squares = {name: np.full_like(value, FIRST) for name, value in weights.items()}
    network, start, read = Network(weights, vocabulary), vocabulary.short + BUCKETS, 0
    for pool in _pools(texts, POOL):
        state = None
        for number, (lanes, inputs, targets, _, first, valid) in enumerate(Lanes(pool).windows(start)):
            state = np.zeros((lanes, HIDDEN), np.float32) if number == 0 else state[:lanes]
            read += int(valid.sum())
            _, grad, state = network.gradient(state, inputs, targets, first, valid)
            size = np.sqrt(sum(float(np.vdot(g, g)) for g in grad.values())) / valid.sum()
            scale = min(1.0, CLIP / max(size, 1e-9)) / valid.sum()
            for name, g in grad.items():
                g *= scale
                squares[name] += g * g
                g *= RATE
                g /= np.sqrt(squares[name])
                weights[name] -= g
    return weights, read


def _pools(texts: Iterator[tuple], most: int) -> Iterator[list[tuple]]:
    """Texts gathered until they hold `most` tokens."""
    pool, held = [], 0
    for text in texts:
        pool.append(text)
        held += len(text[0])
        if held >= most:
            yield pool
            pool, held = [], 0
    if pool:
        yield pool


def _packed(weights: Weights) -> np.ndarray:
    return np.concatenate([value.ravel() for value in weights.values()])


def _unpacked(flat: np.ndarray, like: Weights) -> Weights:
    ends = np.cumsum([value.size for value in like.values()])
    parts = np.split(flat.astype(np.float32), ends[:-1])
    return {name: part.reshape(value.shape) for (name, value), part in zip(like.items(), parts)}


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights after `rounds` shares of the training texts; all of these texts are read, each once."""
    context = docs.sparkSession.sparkContext
    # words beyond the short list are one class to the model
    short = Vocabulary(vocabulary.words[: vocabulary.short], vocabulary.counts[: vocabulary.short], vocabulary.total, vocabulary.kinds, False)
    shared = context.broadcast(short)
    weights = vocabulary.first_weights()
    chosen = docs.filter(~held_out()).select(
        F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(rounds)).alias("share"),
    )
    for number in range(rounds):
        before = context.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], before=before) -> Iterator[pa.RecordBatch]:
            encoder = shared.value.encoder
            texts = (text for rows in portions(batches) for text in encoder.encode_texts(rows["text"]).texts())
            after, read = train_on_encoded(before.value, shared.value, texts)
            if read:
                whole = np.rint(_packed(after).astype(np.float64) / UNIT).astype(np.int64)
                # in two parts, so that products and their sums fit into 64 bits
                high, low, places = (whole >> HALF) * read, (whole & ((1 << HALF) - 1)) * read, np.arange(len(whole))
                for at in range(0, len(whole), 1 << 14):
                    columns = [c[at : at + (1 << 14)] for c in (places, high, low, np.full(len(whole), read))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["place", "high", "low", "read"])

        found = chosen.filter(F.col("share") == number).select("text").mapInArrow(learn, "place long, high long, low long, read long")
        summed = found.groupBy("place").agg(F.sum("high"), F.sum("low"), F.sum("read")).toArrow()
        if summed.num_rows:
            place, high, low, read = (column.to_numpy() for column in summed.columns)
            means = np.empty(len(place))
            means[place] = (high * 2.0**HALF + low) / read
            weights = _unpacked(means * UNIT, weights)
        before.unpersist()
    return weights


LOCAL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, unlisted array<string>"


def log10_likelihoods(network: Network, texts: list[tuple[np.ndarray, np.ndarray]], lanes: int | None = None, window: int = WINDOW) -> np.ndarray:
    """Per text (inputs, targets) its log10-probability, other words counted as one."""
    v, table = network.v, network.input_table()
    out, state = np.zeros(len(texts)), None
    for number, (lanes_left, inputs, targets, of, first, valid) in enumerate(Lanes(texts, lanes).windows(v.short + BUCKETS, window)):
        state = np.zeros((lanes_left, network.size), network.w["state"].dtype) if number == 0 else state[:lanes_left]
        states, _ = network.forward(state, inputs, first, table)
        state, flat = states[-1], valid.ravel()
        found, _ = network.likelihood(states.reshape(-1, network.size), targets.ravel(), flat)
        out += np.bincount(of.ravel()[flat], found.astype(np.float64), len(texts))
    return out / np.log(10)


def score_texts(docs: DataFrame, vocabulary: Vocabulary, weights: Weights) -> DataFrame:
    """One row per document; words that are not listed are scored as unseen and given back."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        encoder, network = vocabulary.encoder, Network(weights, vocabulary)
        logs = np.log10(np.append(vocabulary.counts, 0) + SMOOTH)
        known = np.append(vocabulary.counts > 0, False)
        norm = np.log10(vocabulary.total + SMOOTH * (vocabulary.kinds + 1))

        def encoded() -> Iterator[tuple]:
            for rows in portions(batches):
                found = encoder.encode_texts(rows["text"])
                ids, scores = found.ids, logs[found.ids]
                other = np.where(found.targets == encoder.short, scores - vocabulary.rest_norm, 0)
                numbers = [found.counts + 1, found.sums(known[ids].astype(np.int64)), found.sums(scores - norm), found.sums(other)]
                yield found.inputs, found.texts(), [rows[name] for name in ("row", "doc_id", "held_out")], numbers, found.unlisted()

        for pool in _pools(encoded(), POOL):
            model = log10_likelihoods(network, [text for part in pool for text in part[1]])
            for _, _, heads, (*numbers, other), unlisted in pool:
                own, model = model[: len(other)], model[len(other) :]
                columns = [*heads, *map(pa.array, (*numbers, other + own)), unlisted]
                yield pa.RecordBatch.from_arrays(columns, LOCAL.replace(",", "").split()[::2])

    chosen = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        held_out().alias("held_out"), F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(score, LOCAL)


def language_scores(docs: DataFrame, listed: int = LISTED) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of `docs`.

    A null or empty text is its end alone. Repeated rows each give a row and count each time; a row
    without doc_id is trained on. Without training texts every token has the probability one in the base.
    """
    counts = saved(token_counts(docs), "token-counts")
    vocabulary = read_vocabulary(counts, listed)
    scored = saved(score_texts(docs, vocabulary, train(docs, vocabulary)), "scored-texts")
    result = scored.drop("unlisted")
    if not vocabulary.whole:
        words = scored.select("row", F.explode("unlisted").alias("token"))
        more = words.join(counts, "token").groupBy("row").agg(
            F.count("c").alias("more"), F.sum(F.log10(F.col("c") + SMOOTH) - F.log10(F.lit(SMOOTH))).alias("gain")
        )
        result = result.join(more, "row", "left")
        gain = F.coalesce("gain", F.lit(0.0))
        result = result.withColumns(
            {"n_known": F.col("n_known") + F.coalesce("more", F.lit(0)), "base": F.col("base") + gain, "score": F.col("score") + gain}
        )
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
