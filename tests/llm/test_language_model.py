"""The language model against plain counts, a token-by-token reading, numeric gradients and held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlytics.llm import language_model as lm
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR


def plain_tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def plain(rows):
    held = [doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1 for doc, _ in rows]
    counts = Counter(t for (_, text), out in zip(rows, held) if not out for t in plain_tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    result = []
    for (doc, text), out in zip(rows, held):
        words = plain_tokens(text)
        base = math.fsum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in words)
        result.append((doc, out, len(words), sum(counts[t] > 0 for t in words), total, base))
    return result


def order(row):
    return (row[0] is None, row[0] or 0, row[2], row[3])


def assert_base(got, rows):
    want = sorted(plain(rows), key=order)
    got = sorted((tuple(r) for r in got), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


def small_vocabulary(words=90):
    counts = np.array([7] + [max(1, 400 // (i + 1)) for i in range(words)])
    return lm.Vocabulary([lm.END, *(b"w%d" % i for i in range(words))], counts, int(counts.sum()) + 30, words + 11, False)


def some_weights(vocabulary, seed=2, kind=np.float64):
    draw = np.random.default_rng(seed)
    return {name: (value + draw.standard_normal(value.shape) * 0.3).astype(kind) for name, value in vocabulary.first_weights().items()}


def plain_likelihood(weights, vocabulary, words):
    """One token at a time, and whether all probabilities of a step add up to one."""
    size = weights["state"].shape[0]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    state, row, total = np.zeros(size), vocabulary.short + lm.BUCKETS, 0.0
    for word in words:
        x = weights["embed"][row] @ weights["input"] + weights["gates"]
        r = state @ weights["state"]
        update, reset = sigmoid(x[:size] + r[:size]), sigmoid(x[size : 2 * size] + r[size : 2 * size])
        new = np.tanh(x[2 * size :] + reset * r[2 * size :])
        state = update * state + (1 - update) * new
        p_class = np.exp(state @ weights["class"] + weights["class_bias"])
        p_class /= p_class.sum()
        every = []
        for c, (start, end) in enumerate(zip(vocabulary.starts, vocabulary.ends)):
            inside = np.exp(weights["word"][start:end] @ state + weights["word_bias"][start:end])
            every.extend(p_class[c] * inside / inside.sum())
        every.append(p_class[-1])
        assert math.isclose(sum(every), 1)
        known = vocabulary.words.index(word) if word in vocabulary.words else vocabulary.short
        total += math.log10(every[min(known, vocabulary.short)])
        row = known if known < vocabulary.short else vocabulary.short + zlib.crc32(word) % lm.BUCKETS
    return total


def random_texts(seed, texts, longest):
    draw = np.random.default_rng(seed)
    return [[*(b"w%d" % i for i in draw.integers(0, 100, draw.integers(0, longest))), lm.END] for _ in range(texts)]


@pytest.mark.parametrize("lanes,window", [(1, 4), (5, 35), (64, 2048)])
def test_windows_give_the_likelihood_of_whole_texts(lanes, window):
    vocabulary = small_vocabulary()
    weights, encoder = some_weights(vocabulary), lm.Encoder(vocabulary)
    texts = random_texts(4, 25, 60)
    got = lm.log10_likelihoods(lm.Network(weights, vocabulary), [encoder.encode(t)[1:] for t in texts], lanes, window)
    assert np.allclose(got, [plain_likelihood(weights, vocabulary, t) for t in texts])


def test_gradient_equals_differences():
    vocabulary = small_vocabulary(20)
    weights, encoder = some_weights(vocabulary), lm.Encoder(vocabulary)
    network = lm.Network(weights, vocabulary)
    lanes = lm.Lanes([encoder.encode(t)[1:] for t in random_texts(5, 8, 9)], 3)
    count, inputs, targets, _, first, valid = next(lanes.windows(vocabulary.short + lm.BUCKETS, 33))
    state = np.random.default_rng(6).standard_normal((count, lm.HIDDEN))
    _, grad, _ = network.gradient(state, inputs, targets, first, valid)
    draw = np.random.default_rng(7)
    for name, value in weights.items():
        for at in draw.choice(value.size, min(12, value.size), replace=False):
            place = np.unravel_index(at, value.shape)
            kept, loss = value[place], []
            for shift in (1e-5, -1e-5):
                value[place] = kept + shift
                loss.append(network.gradient(state, inputs, targets, first, valid)[0])
            value[place] = kept
            assert math.isclose((loss[0] - loss[1]) / 2e-5, grad[name][place], rel_tol=1e-4, abs_tol=1e-6), name


def test_training_learns_an_order():
    vocabulary = small_vocabulary()
    texts = [[*(b"w%d" % (i % 7) for i in range(k, k + 40)), lm.END] for k in range(200)]
    encoder = lm.Encoder(vocabulary)
    encoded = [encoder.encode(t)[1:] for t in texts[:20]]
    before = lm.log10_likelihoods(lm.Network(vocabulary.first_weights(), vocabulary), encoded).sum()
    weights, read = lm.train_on(vocabulary.first_weights(), vocabulary, iter(texts * 5))
    assert read == 200 * 41 * 5
    assert lm.log10_likelihoods(lm.Network(weights, vocabulary), encoded).sum() > 0.6 * before


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op13_language_model"](spark, SF_DIR).collect()


def test_first_model_is_the_base():
    vocabulary = small_vocabulary()
    network, encoder = lm.Network(vocabulary.first_weights(), vocabulary), lm.Encoder(vocabulary)
    texts = random_texts(8, 10, 50)
    got = lm.log10_likelihoods(network, [encoder.encode(t)[1:] for t in texts])
    norm = vocabulary.total + lm.SMOOTH * (vocabulary.kinds + 1)
    counts = dict(zip(vocabulary.words, vocabulary.counts.tolist()))
    rest = norm - sum(count + lm.SMOOTH for count in counts.values())
    want = [sum(math.log10((counts[w] + lm.SMOOTH if w in counts else rest) / norm) for w in t) for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_base_of_whole_table(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert_base(scored, [tuple(r) for r in docs])


def test_model_beats_single_words_on_held_out_texts(spark):
    rows = QUERIES["op13_language_model"](spark, SF_DIR.replace("sf0.001", "sf0.01")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.995 * sum(r.base_score for r in held)
    assert sum(r.score > r.base_score for r in held) > 0.7 * len(held)
    assert all(r.score < 0 for r in rows)


def test_words_beyond_the_list_are_joined(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    short = lm.language_scores(docs, listed=3000)
    rows = short.collect()
    assert_base(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    # the same model but for the order of equally frequent words, so nearly the same scores
    assert math.isclose(sum(r.score for r in rows), sum(r.score for r in scored), rel_tol=0.02)


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = lm.language_scores(odd_docs).collect()
    assert_base(got, rows)
    assert all(math.isfinite(r.score) for r in got)
    assert lm.language_scores(no_docs).count() == 0
    held = odd_docs.filter(lm.held_out())
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in lm.language_scores(held).collect())


def test_every_training_token_is_in_a_step(monkeypatch):
    vocabulary = small_vocabulary()
    draw = np.random.default_rng(3)
    texts = [[b"w%d" % i for i in draw.integers(0, 90, n)] + [lm.END] for n in (1, 9000, *draw.integers(5, 900, 600))]
    learnt, plain_gradient = Counter(), lm.Network.gradient

    def gradient(self, state, inputs, targets, first, valid):
        learnt.update(targets[valid].tolist())
        return plain_gradient(self, state, inputs, targets, first, valid)

    monkeypatch.setattr(lm.Network, "gradient", gradient)
    _, read = lm.train_on(vocabulary.first_weights(), vocabulary, iter(texts))
    encoder = lm.Encoder(vocabulary)
    assert learnt == Counter(i for words in texts for i in encoder.encode(words)[2].tolist())
    assert read == sum(map(len, texts))


def test_windows_share_memory_but_not_their_states():
    vocabulary, draw = lm.Vocabulary([lm.END, b"a", b"b"], np.array([5, 9, 4]), 18, 3, True), np.random.default_rng(4)
    network = lm.Network(vocabulary.first_weights(), vocabulary)
    state, first = np.zeros((1, lm.HIDDEN), np.float32), np.zeros((6, 1), bool)
    states, kept = network.forward(state, draw.integers(0, 3, (6, 1)), first)
    before = states.copy()
    _, again = network.forward(states[-1], draw.integers(0, 3, (6, 1)), first)
    assert np.shares_memory(kept, again) and (states == before).all()


def test_rows_that_are_not_valid_have_no_gradient():
    vocabulary, draw = small_vocabulary(), np.random.default_rng(5)
    weights = some_weights(vocabulary)
    network, valid = lm.Network(weights, vocabulary), np.arange(40) % 5 > 0
    states = np.tanh(draw.standard_normal((40, lm.HIDDEN)))
    targets = draw.integers(0, vocabulary.short + 1, 40)
    whole, part = ({name: np.zeros_like(w) for name, w in weights.items()} for _ in range(2))
    found, back = network.likelihood(states, targets, valid, whole)
    alone, expected = lm.Network(weights, vocabulary).likelihood(states[valid], targets[valid], np.ones(32, bool), part)
    assert np.allclose(found, alone) and np.allclose(back[valid], expected) and not back[~valid].any()
    assert all(np.allclose(whole[name], part[name]) for name in weights)


def test_large_gate_sums_are_within_range():
    vocabulary = small_vocabulary()
    weights = {name: w.astype(np.float32) for name, w in some_weights(vocabulary).items()}
    weights["gates"][:] = np.repeat([200, -200, 200, -200], len(weights["gates"]) // 4)
    network, inputs = lm.Network(weights, vocabulary), np.zeros((3, 2), np.int32)
    with np.errstate(all="raise", under="ignore"):
        states, _ = network.forward(np.full((2, lm.HIDDEN), 0.5, np.float32), inputs, np.zeros((3, 2), bool))
    assert np.isfinite(states).all() and np.abs(states).max() <= 1


def test_a_vocabulary_makes_its_encoder_once():
    vocabulary = small_vocabulary()
    assert vocabulary.encoder is vocabulary.encoder


def test_a_word_is_looked_up_once():
    class Counting(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    vocabulary = small_vocabulary()
    vocabulary.short, encoder = 20, lm.Encoder(vocabulary)
    encoder.ids = Counting(encoder.ids)
    words = [b"w%d" % (i % 150) for i in range(6000)]
    ids, _, _ = encoder.encode([*words, lm.END])
    assert ids.tolist() == [*(vocabulary.words.index(w) if w in vocabulary.words else -1 for w in words), 0]
    assert encoder.ids.asked <= 150


def test_a_column_of_texts_is_encoded_as_its_words():
    texts = ["", None, " ", "W1 w2\tw2\x0bX\x0cw90 \x85", "\x1cw3 \xc0\xc9 \xe9W4", " w5", "w6 \r\n", "new " * 40, "\x00 w7"]
    vocabulary = small_vocabulary()
    encoder, batch = lm.Encoder(vocabulary), pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for most in (1, 9, 1000):
        parts = [encoder.encode_texts(rows["text"]) for rows in lm.portions(iter([batch, batch.slice(0, 0), batch]), most)]
        assert sum(len(part.counts) for part in parts) == 2 * len(texts)
        ids, words = ([x for part in parts for x in column(part)] for column in (lambda p: p.ids.tolist(), lambda p: p.unlisted().to_pylist()))
        pairs = [(i.tolist(), t.tolist()) for part in parts for i, t in part.texts()]
        for text, others, (inputs, targets) in zip(texts * 2, words, pairs, strict=True):
            plain = [lm.END if word is None else word.encode() for word in plain_tokens(text)]
            expected = [vocabulary.words.index(w) if w in vocabulary.words else -1 for w in plain]
            assert ids[: len(plain)] == expected and others == [w.decode() for w, i in zip(plain, expected) if i < 0]
            want, ids = encoder.encode(plain), ids[len(plain) :]
            assert (inputs, targets) == (want[1].tolist(), want[2].tolist())
        assert not ids


def test_weights_are_averaged_by_tokens(spark):
    rows = [(5 * i, " ".join(f"w{(i * k) % 90}" for k in range(20 + i))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").filter(~lm.held_out()).repartition(3, "doc_id").localCheckpoint()
    parts = docs.select("text", F.spark_partition_id().alias("part")).collect()
    vocabulary = small_vocabulary()
    got, learnt = lm.train(docs, vocabulary, 1), []
    for part in {r.part for r in parts}:
        words = ([*r.text.encode().split(), lm.END] for r in parts if r.part == part)
        learnt.append(lm.train_on(vocabulary.first_weights(), vocabulary, words))
    read = sum(n for _, n in learnt)
    assert len(learnt) > 1
    for name, value in got.items():
        assert np.allclose(value, sum(w[name].astype(np.float64) * n for w, n in learnt) / read, atol=2e-6), name
