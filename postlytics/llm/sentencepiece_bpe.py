"""SentencePiece encoding and decoding of a BPE model, by backtracking over longest matches.

Encoding looks at a text from left to right. An Aho-Corasick automaton over all pieces gives the
longest piece that starts at every position. The next token is the longest one that may follow
the last token; a token may follow when undoing the merges of both shows that no merge across
their border would have come first. When no token fits, the last one is taken back and its end
is marked in a bit field as failed, so no position is tried twice and the work is linear.

The model file is read once on the driver (a proven size: a few hundred kilobytes) and its pieces
travel to the tasks with the function; each Python worker builds the tables once.
"""

from __future__ import annotations

import codecs
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices, small_batches, worker_table

# Fixed values of the model format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

# Segments kept by a worker with their ids, and pairs of tokens; a table is emptied when it is full.
CACHED_SEGMENTS = 500_000
CACHED_PAIRS = 200_000
CACHED_LENGTH = 64


@dataclass(frozen=True)
class Model:
    """Pieces as (text, score, kind) in id order, and the two settings that matter here."""

    pieces: tuple[tuple[str, float, int], ...]
    dummy_prefix: bool

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.pieces, self.dummy_prefix)).encode()).hexdigest()


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message: ints, bytes, or 4-byte floats."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
        elif wire == 2:
            size = varint()
            yield number, data[at : at + size]
            at += size
        elif wire == 5:
            yield number, struct.unpack("<f", data[at : at + 4])[0]
            at += 4
        else:
            yield number, data[at : at + 8]
            at += 8


def read_model(path: str) -> Model:
    """A BPE model file whose normalizer keeps texts as they are; others are refused."""
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    trainer = dict(_fields(next((v for n, v in fields if n == 2), b"")))
    normalizer = dict(_fields(next((v for n, v in fields if n == 3), b"")))
    if trainer.get(3) != 2:
        raise ValueError("not a BPE model")
    if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("only models that leave the text unchanged but for escaped spaces are read")
    pieces = []
    for number, value in fields:
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), float(piece.get(2, 0.0)), int(piece.get(3, NORMAL))))
    if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return Model(tuple(pieces), bool(normalizer.get(3, 1)))


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("postlytics_one_byte", _one_byte)


class _Segments(dict):
    """Ids of segments that were seen; others are encoded when they are asked for.

    The last character, often a comma or full stop, is encoded alone where no piece spans the
    place before it; `pairs` are the neighbours that pieces have.
    """

    def __init__(self, encode, pairs: set[tuple[str, str]]) -> None:
        super().__init__()
        self.encode, self.pairs = encode, pairs

    def __missing__(self, segment: str) -> tuple[int, ...]:
        if 2 < len(segment) <= CACHED_LENGTH and segment[-2] != " " and (segment[-2], segment[-1]) not in self.pairs:
            ids = self[segment[:-1]] + self[segment[-1]]
        else:
            ids = self.encode(segment.replace(" ", SPACE))
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHED_SEGMENTS:
                self.clear()
            self[segment] = ids
        return ids


class Coder:
    """Tables of a model. `rank` orders merges: lower ones come first, equal ones from the left."""

    def __init__(self, model: Model) -> None:
        self.dummy_prefix = model.dummy_prefix
        self.ids = {text: i for i, (text, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        self.unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
        self.bytes = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(model.pieces) if kind == BYTE}
        scores = sorted({score for text, score, kind in model.pieces if kind == NORMAL}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        self.rank = {
            text: order[score] for text, score, kind in model.pieces if kind == NORMAL and len(text) > 1
        }
        self.split = self._splits()
        self.automaton = ahocorasick.Automaton()
        for text in self.split:
            self.automaton.add_word(text, text)
        self.automaton.make_automaton()
        self.shorter = {text: self._longest_prefix(text) for text in self.split}
        self.pairs = {pair for text in self.split for pair in itertools.pairwise(text)}
        self.segments = self._segments()
        self.cache = _Segments(self._ids_of, self.pairs)
        self.follows: dict[tuple[str, str], bool] = {}
        self.surface = [self._surface(text, kind) for text, _, kind in model.pieces]
        self.starts_with_space = {i for i, (text, _, kind) in enumerate(model.pieces) if kind == NORMAL and text.startswith(SPACE)}
        self.silent = {i for i, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}

    @staticmethod
    def _surface(text: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return text.replace(SPACE, " ").encode()

    def _splits(self) -> dict[str, tuple[str, str]]:
        """The last merge of every piece that merging its own characters leads to."""
        splits = {}
        for text in self.rank:
            parts, last = list(text), None
            while len(parts) > 1:
                best = min(
                    (self.rank[a + b], i) for i, (a, b) in enumerate(itertools.pairwise(parts)) if a + b in self.rank
                ) if any(a + b in self.rank for a, b in itertools.pairwise(parts)) else None
                if best is None:
                    break
                i = best[1]
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 1:
                splits[text] = last
        return splits

    def _segments(self) -> re.Pattern | None:
        """A pattern that cuts texts where no piece spans the border; None if spaces end pieces.

        Parts between such borders are encoded alone, with the same result: before a space that
        follows something else, and around characters that no longer piece has. Spaces are not
        yet escaped where it applies.
        """
        if any(a != SPACE and b == SPACE for a, b in self.pairs):
            return None
        alone = "".join(c for c in "\n\t" if not any(c in pair for pair in self.pairs))
        parts = [f" *[^ {alone}]+", " +"] + ([f"[{alone}]"] if alone else [])
        return re.compile("|".join(parts))

    def _longest_prefix(self, text: str) -> str:
        return next((text[:n] for n in range(len(text) - 1, 1, -1) if text[:n] in self.split), text[0])

    def fits(self, left: str, right: str) -> bool:
        """Would merging the joined text end with exactly these two tokens?"""
        if len(self.follows) >= CACHED_PAIRS:
            self.follows.clear()
        known = self.follows[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: str, right: str) -> bool:
        rank, split = self.rank, self.split
        bound = len(rank) + 1
        while True:
            # a merge across the border that comes before the merge undone last
            if rank.get(left + right, bound) < bound:
                return False
            of_left = rank[left] if len(left) > 1 else -1
            of_right = rank[right] if len(right) > 1 else -1
            if of_left > of_right:
                bound, left = of_left, split[left][1]
            elif of_right >= 0:
                bound, right = of_right + 1, split[right][0]
            else:
                return True

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text whose spaces are escaped; characters without a piece stay alone."""
        size, follows, shorter = len(text), self.follows, self.shorter
        longest = list(text)
        for end, token in self.automaton.iter(text):  # by rising ends, so the last one is the longest
            longest[end + 1 - len(token)] = token
        open_end = bytearray(b"\x01") * (size + 1)  # 0: no token may end here any more
        found: list[str] = []
        last, at, token = "", 0, longest[0] if size else ""
        while token:
            end = at + len(token)
            while not open_end[end] or (
                last and not (self.fits(last, token) if (fit := follows.get((last, token))) is None else fit)
            ):
                token = shorter.get(token, "")
                if not token:
                    break
                end = at + len(token)
            if token:
                found.append(token)
                last, at, token = token, end, longest[end] if end < size else ""
            else:  # nothing fits here: the last token is taken back and a shorter one tried
                open_end[at] = 0
                token = found.pop()
                at -= len(token)
                last = found[-1] if found else ""
        return found

    def _ids_of(self, segment: str) -> tuple[int, ...]:
        tokens = self.tokens(segment)
        try:
            return tuple([self.ids[token] for token in tokens])
        except KeyError:
            return tuple(itertools.chain.from_iterable(map(self._ids_of_token, tokens)))

    def _ids_of_token(self, token: str) -> list[int]:
        if token in self.ids:
            return [self.ids[token]]
        return [self.bytes[b] for b in token.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        plain = text.replace(SPACE, " ")  # both are escaped alike
        if self.dummy_prefix:
            plain = " " + plain
        segments = self.segments.findall(plain) if self.segments else [plain]
        return list(itertools.chain.from_iterable(map(self.cache.__getitem__, segments)))

    def decode(self, ids: list[int] | None) -> str:
        if ids is None or not len(ids):
            return ""
        data = b"".join(map(self.surface.__getitem__, ids))
        text = data.decode("utf-8", "postlytics_one_byte")
        if self.dummy_prefix and next((i for i in ids if i not in self.silent), -1) in self.starts_with_space:
            text = text[1:]
        return text


def coder_of(key: str, shared) -> Coder:
    """The tables of a broadcast model, built once per Python worker."""
    return worker_table(key, lambda: Coder(shared.value))


def encoder(model: Model):
    """A column function text -> array<int>; null texts are empty."""
    shared, key = _shared(model), model.key

    @F.arrow_udf("array<int>")
    def encode(text: pa.Array) -> pa.Array:
        coder = coder_of(key, shared)
        offsets, ids = [0], []
        for values in in_slices(text):
            rows = [coder.encode(value) for value in values]
            for row in rows:
                offsets.append(offsets[-1] + len(row))
            ids.append(np.fromiter(itertools.chain.from_iterable(rows), np.int32, count=sum(map(len, rows))))
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))

    return encode


def decoder(model: Model):
    """A column function array<int> -> text; null is the empty text."""
    shared, key = _shared(model), model.key

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        coder = coder_of(key, shared)
        texts: list[str] = []
        for at in range(0, len(ids), 256):
            part = ids.slice(at, 256)
            offsets = part.offsets.to_numpy()
            flat = part.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy().tolist()
            texts += [coder.decode(flat[a:b]) for a, b in itertools.pairwise((offsets - offsets[0]).tolist())]
        return pa.array(texts, pa.string())

    return decode


def _shared(model: Model):
    from pyspark.sql import SparkSession

    return SparkSession.active().sparkContext.broadcast(model)


def encode_texts(docs: DataFrame, model: Model, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and the token ids of the whole text in a new column; an `ids` column is replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn(ids, encoder(model)(F.col(text).cast("string")))


def decode_ids(rows: DataFrame, model: Model, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the text that the ids stand for."""
    return rows.withColumn(text, decoder(model)(F.col(ids)))


def id_digest(ids: Column) -> Column:
    """Hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


def round_trip(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of `docs`.

    Null and empty texts give no ids and an empty decoded text; repeated rows each give a row.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    coded = decode_ids(encode_texts(rows, model), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        id_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
