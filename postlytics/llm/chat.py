"""Chat formatting at token level.

Every turn is encoded on its own, in segments: the role line, the text and the line break after it.
The ids of the control marks are reserved and spliced between the segments, so no text can produce
them. Control strings inside a text are escaped as well, so the formatted text stays readable back.
Turns are then laid out per conversation; the place of each segment is a running sum of lengths,
and the loss mask covers the text segments of the assistant.

The work per turn is done before the shuffle. A conversation is read in order by one task, as a
digest of its whole text needs, but as a stream with a spilling sort, never as a group in memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices

# Control marks of the template and the role that is learned.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """Put a backslash into every `<|`, so that no control string is left; reversible."""
    return CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line, whatever it holds."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


@dataclass(frozen=True)
class Vocabulary:
    """Byte-level ranks; the two ids behind them are reserved for the control marks."""

    ranks: dict[bytes, int]
    pattern: str

    @property
    def start(self) -> int:
        return max(self.ranks.values()) + 1

    @property
    def end(self) -> int:
        return self.start + 1


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


class Tokens:
    """Encoder of text segments and decoder of formatted ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "segments", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={}
        )
        self.start, self.end = vocabulary.start, vocabulary.end
        self.bytes = {rank: token for token, rank in vocabulary.ranks.items()}
        self.bytes |= {self.start: START.encode(), self.end: END.encode()}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_TOKENS: dict[int, Tokens] = {}


def _tokens(shared) -> Tokens:
    """Built once per Python worker; `shared` is a broadcast vocabulary of about a megabyte."""
    vocabulary = shared.value
    key = hash((vocabulary.pattern, len(vocabulary.ranks), next(reversed(vocabulary.ranks.items()))))
    if key not in _TOKENS:
        _TOKENS[key] = Tokens(vocabulary)
    return _TOKENS[key]


TURNS = "conv_id long, turn long, ids array<int>, head int, body int, learned boolean"
LAID_OUT = "conv_id long, start long, ids array<int>, loss_start long, loss_end long"
REPORT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def encode_turns(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(conv_id, turn, ids, head, body, learned): ids of a turn, `body` of them its text from `head` on.

    A null text or role is empty.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared)
        line_break = tokens.encode("\n")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: dict[str, list] = {name: [] for name in ("ids", "head", "body", "learned")}
                for role, text in zip(part["role"].to_pylist(), part["text"].to_pylist()):
                    head = [tokens.start, *tokens.encode(escape_role(role or "") + "\n")]
                    body = tokens.encode(escape(text or ""))
                    out["ids"].append([*head, *body, tokens.end, *line_break])
                    out["head"].append(len(head))
                    out["body"].append(len(body))
                    out["learned"].append(role == LEARNED_ROLE)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["conv_id"],
                        part["turn"],
                        pa.array(out["ids"], pa.list_(pa.int32())),
                        pa.array(out["head"], pa.int32()),
                        pa.array(out["body"], pa.int32()),
                        pa.array(out["learned"], pa.bool_()),
                    ],
                    ["conv_id", "turn", "ids", "head", "body", "learned"],
                )

    chosen = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(encode, TURNS)


def lay_out(turns: DataFrame) -> DataFrame:
    """(conv_id, start, ids, loss_start, loss_end): turns of each conversation in order.

    `start` is the place of the turn's first id in the conversation, by a running sum; the loss
    mask is loss_start to loss_end, empty for turns that are not learned. Turns with equal numbers
    follow each other by their ids.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, carried, seen = None, 0, False
        for batch in batches:
            keys = batch["conv_id"].to_pylist()
            sizes = np.diff(batch["ids"].offsets.to_numpy())
            sums = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            starts = np.empty(len(keys), np.int64)
            base = -carried
            for i, key in enumerate(keys):
                if not seen or key != conversation:
                    conversation, seen, base = key, True, sums[i]
                starts[i] = sums[i] - base
            carried = int(sums[-1] - base)
            loss_start = starts + batch["head"].to_numpy()
            learned = batch["learned"].to_numpy(zero_copy_only=False)
            loss_end = loss_start + np.where(learned, batch["body"].to_numpy(), 0)
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], pa.array(starts), batch["ids"], pa.array(loss_start), pa.array(loss_end)],
                ["conv_id", "start", "ids", "loss_start", "loss_end"],
            )

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(place, LAID_OUT)


class _Reading:
    """Digests of one conversation while its turns pass."""

    def __init__(self, conversation: int | None) -> None:
        self.conversation = conversation
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, ids: list[int], learned: list[int], tokens: Tokens) -> None:
        if ids[0] != tokens.start or tokens.end not in ids:
            raise ValueError("a turn does not begin and end with its marks")
        self.formatted += len(tokens.decode(ids))
        role, _, text = tokens.decode(ids[1 : ids.index(tokens.end)]).partition("\n")
        self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        self.n_turns += 1
        spoken = unescape(tokens.decode(learned))
        self.loss.update(spoken.encode())
        self.loss_chars += len(spoken)

    def row(self) -> dict:
        return {
            "conv_id": self.conversation, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted,
        }


def read_back(laid_out: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per conversation, decoded from ids and masks alone; needs the order of `lay_out`."""
    shared = laid_out.sparkSession.sparkContext.broadcast(vocabulary)
    names = [part.split()[0] for part in REPORT.split(", ")]
    kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared)
        reading = None

        def emit(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([row[name] for row in rows], kind) for name, kind in zip(names, kinds)], names
            )

        for batch in batches:
            done = []
            columns = [batch[name].to_pylist() for name in ("conv_id", "start", "loss_start", "loss_end")]
            all_ids = (ids for values in in_slices(batch["ids"]) for ids in values)
            for key, start, first, last, ids in zip(*columns, all_ids):
                if reading is None or key != reading.conversation:
                    if reading is not None:
                        done.append(reading.row())
                    reading = _Reading(key)
                reading.add(ids, ids[first - start : last - start], tokens)
            if done:
                yield emit(done)
        if reading is not None:
            yield emit([reading.row()])

    return laid_out.mapInArrow(read, REPORT)


def format_report(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Format all conversations and read them back, one row each.

    Repeated rows are turns of their own; rows without conv_id are one conversation with a null id.
    """
    return read_back(lay_out(encode_turns(rows, vocabulary)), vocabulary)
