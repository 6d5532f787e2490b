"""Conversation structure repair: Knuth's lightest derivation of a legal sequence of turns.

A repaired conversation has the role initials `(s?(ua)+)?`. Items of the deduction system say "from
state p, the first i rows of a chunk are edited and the automaton is in state q". Rules keep, rerole
or delete the next row or insert an empty turn before it. A derivation weighs (cost, audit): rules add
to the cost and append to the audit, so no conclusion is lighter than its premise (superior), and a
lighter premise never gives a heavier conclusion (monotone): audits of one item with equal cost hold
equally many letters, so none is the beginning of another. The agenda pops items lightest first; a
popped item is final, and a chunk that ends its conversation stops when its goal is popped.

Long conversations are cut into chunks by a range partitioning, so that one conversation spreads over
tasks. A chunk whose beginning is not known is derived from all four states. Chunk derivations are
hyperedges from (p, q) to the conversation's items; they are put together in order from a few numbers
and letters a chunk, without its texts. Inserts belong to the row behind them, so that audits up to
a chunk's end all end with a row's letter and are ordered by rank alone.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import in_slices, saved

# Costs of the edits, and the automaton of `(s?(ua)+)?` by role initials.
RELABEL, REMOVE, ADD, RAGGED = 2, 3, 2, 1
NOTHING, AFTER_S, AFTER_U, AFTER_A, GOAL = range(5)
STEP = {
    (NOTHING, "s"): AFTER_S, (NOTHING, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
    (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U,
}
WANTED = {NOTHING: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
ACCEPTING = (NOTHING, AFTER_A)
LEGAL = ("su", "ua", "au")

# A chunk ends after so many distinct rows or characters of text.
CHUNK_ROWS, CHUNK_CHARS = 64, 1 << 21

BLANK_FREE = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


class Row(NamedTuple):
    """A turn and its equal copies; `fault` is that of the first, the others are duplicates at least."""

    initial: str
    fault: str
    copies: int


def lightest(rows: list[Row], entries: list[int], closing: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """The lightest (cost, audit) from each entry state to each state behind the rows, or to the goal."""
    agenda = [(0, "", p, 0, p, False) for p in entries]
    final, goals = set(), {}
    while agenda and not (closing and len(goals) == len(entries)):
        cost, audit, p, i, q, inserted = heapq.heappop(agenda)
        if (p, i, q, inserted) in final:
            continue
        final.add((p, i, q, inserted))
        if q == GOAL or (i == len(rows) and not closing):
            goals[p, q] = (cost, audit)
            continue
        if i == len(rows) and q in ACCEPTING:
            heapq.heappush(agenda, (cost, audit, p, i, GOAL, False))
        added = STEP[q, WANTED[q][0]]
        heapq.heappush(agenda, (cost + ADD, audit + "I", p, i, added, True))
        if i == len(rows):
            continue
        initial, fault, copies = rows[i]
        rest, more = REMOVE * (copies - 1), "D" * (copies - 1)
        heapq.heappush(agenda, (cost + REMOVE + rest, audit + "D" + more, p, i + 1, q, False))
        if fault not in ("blank", "duplicate"):
            base = cost + rest + (RAGGED if fault == "truncated" else 0)
            if (q, initial) in STEP:
                heapq.heappush(agenda, (base, audit + "K" + more, p, i + 1, STEP[q, initial], False))
            heapq.heappush(agenda, (base + RELABEL, audit + "R" + more, p, i + 1, added, False))
    return goals


CLOSE = lightest([], [NOTHING, AFTER_S, AFTER_U, AFTER_A], True)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by the CRC of `conv_id:turn`; nulls are read as one space.

    Dropped rows stay, with `present` false, so that no conversation is lost.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    text, role = F.coalesce(F.col("text").cast("string"), blank), F.coalesce(F.col("role").cast("string"), blank)
    hit = F.crc32(key) % 20
    turned = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (hit != 0).alias("present"),
        F.when(hit == 3, 2).otherwise(1).alias("copies"),
    )
    return turned


def judged(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with `copies`, their number, and `fault`.

    Copies are counted before the rows are shuffled. A row is a duplicate when its role and text
    stand at a smaller turn of the conversation; nulls come first. Only roles and texts that
    occur at several turns go into the join that finds this.
    """
    counted = rows.withColumn("digest", F.sha2("text", 256)).groupBy("conv_id", "turn", "role", "digest", "present").agg(
        F.sum("copies").alias("copies"), F.any_value("text").alias("text")
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    keys = rows.filter("present").select("conv_id", "role", F.sha2("text", 256).alias("digest"), place.alias("place"))
    firsts = keys.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    firsts = firsts.filter(~F.col("low").eqNullSafe(F.col("high"))).select(
        F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest"), "low"
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("role") == F.col("of_role")) & (F.col("digest") == F.col("of_digest"))
    fault = (
        F.when(~F.col("text").rlike(BLANK_FREE), "blank")
        .when(F.col("low").isNotNull() & (place > F.col("low")), "duplicate")
        .when(~F.col("text").rlike(ENDED), "truncated")
        .otherwise("")
    )
    return counted.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "digest", "text", "copies", "present", fault.alias("fault")
    )


CHUNKS = (
    "conv_id long, chunk long, opens boolean, closes boolean, ways array<struct<p:int,q:int,cost:long,audit:string>>,"
    " blank long, duplicate long, truncated long, illegal long, first_role string, last_role string,"
    " first_turn long, last_turn long, turns long, rows array<struct<role:string,text:string,copies:long>>"
)
WAYS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())]))
_CHUNK_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), WAYS, *[pa.int64()] * 4, *[pa.string()] * 2, *[pa.int64()] * 3, ROWS]


_CHUNK_NAMES = [
    "conv_id", "chunk", "opens", "closes", "ways", "blank", "duplicate", "truncated", "illegal",
    "first_role", "last_role", "first_turn", "last_turn", "turns", "rows",
]


class _Chunk:
    """Rows of one conversation that follow each other."""

    def __init__(self, conversation: int | None, number: int, opens: bool) -> None:
        self.conversation, self.number, self.opens = conversation, number, opens
        self.rows: list[tuple[str, str, int]] = []
        self.items: list[Row] = []
        self.chars = self.illegal = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.turns: list[int] = []

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str) -> None:
        if self.rows:
            self.illegal += (self.rows[-1][0][:1] + role[:1]) not in LEGAL
        self.illegal += copies - 1
        for kind, number in ((fault, 1), (fault if fault in ("blank", "duplicate") else "duplicate", copies - 1)):
            if kind:
                self.faults[kind] += number
        if turn is not None and self.turns[-1:] != [turn]:
            self.turns.append(turn)
        self.rows.append((role, text, copies))
        self.items.append(Row(role[:1], fault, copies))
        self.chars += len(text)

    def full(self, most: int) -> bool:
        return len(self.rows) >= most or self.chars >= CHUNK_CHARS

    def record(self, closes: bool) -> tuple:
        entries = [NOTHING] if self.opens else [NOTHING, AFTER_S, AFTER_U, AFTER_A]
        ways = [(p, q, cost, audit) for (p, q), (cost, audit) in lightest(self.items, entries, closes).items()]
        ends = (self.rows[0][0], self.rows[-1][0]) if self.rows else (None, None)
        span = (self.turns[0], self.turns[-1], len(self.turns)) if self.turns else (None, None, 0)
        names = ("p", "q", "cost", "audit")
        return (
            self.conversation, self.number, self.opens, closes, [dict(zip(names, way)) for way in ways],
            *self.faults.values(), self.illegal, *ends, *span,
            [dict(zip(("role", "text", "copies"), row)) for row in self.rows],
        )


def _batch(records: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*records) if records else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def derive_chunks(rows: DataFrame, most: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of `judged` rows with their derivations; a long conversation spreads over partitions."""

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, chunk, done = TaskContext.get().partitionId() << 40, 0, None, []
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("conv_id", "turn", "role", "copies", "present", "fault")]
            texts = (text for values in in_slices(batch["text"]) for text in values)
            for conversation, turn, role, copies, present, fault, text in zip(*columns, texts):
                if chunk is None or conversation != chunk.conversation or chunk.full(most):
                    new = chunk is not None and conversation != chunk.conversation
                    if chunk is not None:
                        done.append(chunk.record(closes=new))
                    chunk, number = _Chunk(conversation, base + number, opens=new), number + 1
                if present:
                    chunk.add(turn, role, text, copies, fault)
                if len(done) >= 64:
                    yield _batch(done, _CHUNK_NAMES, _CHUNK_TYPES)
                    done = []
        if chunk is not None:
            done.append(chunk.record(closes=False))
        yield _batch(done, _CHUNK_NAMES, _CHUNK_TYPES)

    order = ("conv_id", "turn", "role", "digest", "present")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(derive, CHUNKS)


PLANS = (
    "conv_id long, chunk long, entry int, steps string, gaps long, blank long, duplicate long, truncated long,"
    " illegal long, cost long, audit string"
)
_PLAN_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]


class _Conversation:
    """Puts the chunks of one conversation together.

    best: by state, (cost, rank of the audit among the states). back: for every chunk, by state the
    state before it and the chunk's own letters.
    """

    def __init__(self, conversation: int | None) -> None:
        self.conversation = conversation
        self.best = {NOTHING: (0, 0)}
        self.numbers: list[int] = []
        self.back: list[dict[int, tuple[int, str]]] = []
        self.counts = [0, 0, 0, 0]
        self.last_role = self.first_turn = self.last_turn = None
        self.turns = 0

    def fold(self, ways: list[tuple[int, int, int, str]]) -> None:
        chosen: dict[int, tuple] = {}
        for p, q, cost, audit in ways:
            if p in self.best:
                way = (self.best[p][0] + cost, self.best[p][1], audit, p)
                chosen[q] = min(chosen.get(q, way), way)
        ranks = {q: rank for rank, q in enumerate(sorted(chosen, key=lambda q: chosen[q][1:3]))}
        self.best = {q: (way[0], ranks[q]) for q, way in chosen.items()}
        self.back.append({q: (p, audit) for q, (_, _, audit, p) in chosen.items()})

    def add(self, row: dict) -> None:
        self.numbers.append(row["chunk"])
        self.fold([(w["p"], w["q"], w["cost"], w["audit"]) for w in row["ways"]])
        for at, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.counts[at] += row[name]
        if row["first_role"] is not None:
            if self.last_role is not None:
                self.counts[3] += (self.last_role[:1] + row["first_role"][:1]) not in LEGAL
            self.last_role = row["last_role"]
        if row["turns"]:
            self.turns += row["turns"] - (self.last_turn == row["first_turn"])
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]

    def records(self) -> Iterator[tuple]:
        tail = ""
        if GOAL not in self.best:
            self.fold([(p, q, cost, audit) for (p, q), (cost, audit) in CLOSE.items()])
            (state, tail), = [self.back.pop()[GOAL]]
            cost = self.best[GOAL][0]
        else:
            state, cost = GOAL, self.best[GOAL][0]
        parts = []
        for number, ways in zip(reversed(self.numbers), reversed(self.back)):
            entry, audit = ways[state]
            parts.append(audit + tail)
            yield (self.conversation, number, entry, audit + tail, *[None] * 7)
            state, tail = entry, ""
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        yield (self.conversation, None, None, None, gaps, *self.counts, cost, "".join(reversed(parts)))


def compose(chunks: DataFrame) -> DataFrame:
    """Per chunk its entry state and letters, and per conversation (null chunk) its counts, cost and audit."""
    names = PLANS.replace(",", "").split()[::2]

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if current is None or row["conv_id"] != current.conversation:
                    if current is not None:
                        done.extend(current.records())
                    current = _Conversation(row["conv_id"])
                current.add(row)
            if len(done) >= 256:
                yield _batch(done, names, _PLAN_TYPES)
                done = []
        if current is not None:
            done.extend(current.records())
        for at in range(0, len(done), 4096):
            yield _batch(done[at : at + 4096], names, _PLAN_TYPES)

    ordered = chunks.drop("rows").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return ordered.mapInArrow(put_together, PLANS)


TURNS = "conv_id long, chunk long, place int, edit string, role string, text string"
_TURN_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]


def _walk(entry: int, steps: str, rows: list[dict]) -> Iterator[tuple[str, str, str]]:
    state, left = entry, (row for row in rows for _ in range(row["copies"]))
    for step in steps:
        row = None if step == "I" else next(left)
        if step != "D":
            role = row["role"] if step == "K" else WANTED[state]
            state = STEP[state, role[:1]]
            yield step, role, row["text"] if row else ""


def edited(chunks: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, chunk, place, edit, role, text): repaired turns, ordered by chunk and place."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                conversation, number, entry, steps, rows = [c.to_pylist()[0] for c in batch.slice(at, 1).columns]
                turns = enumerate(_walk(entry, steps, rows))
                yield _batch([(conversation, number, place, *turn) for place, turn in turns], TURNS.replace(",", "").split()[::2], _TURN_TYPES)

    planned = plans.filter("chunk IS NOT NULL").select("chunk", "entry", "steps")
    return chunks.select("conv_id", "chunk", "rows").join(planned, "chunk").select("conv_id", "chunk", "entry", "steps", "rows").mapInArrow(walk, TURNS)


def repair(rows: DataFrame, most: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(repaired turns, one row of counts, cost and audit per conversation) of (conv_id, turn, role, text).

    Rows go by turn, nulls first, then role and a digest of the text. Repeated rows are duplicates. Null
    texts and roles are one space, so blank and in need of a role; a null conv_id is a conversation.
    `present` false and `copies`, as `damaged` sets them, are optional.
    """
    named = rows
    for name, value in (("present", F.lit(True)), ("copies", F.lit(1))):
        if name not in rows.columns:
            named = named.withColumn(name, value)
    named = named.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), "present", "copies",
    )
    chunks = saved(derive_chunks(judged(named), most), "repair-chunks")
    plans = saved(compose(chunks), "repair-plans")
    return edited(chunks, plans), plans.filter("chunk IS NULL").drop("chunk", "entry", "steps")


DIGESTS = "conv_id long, repaired_sha256 string"


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of `role:text` lines per conversation.

    A digest needs its bytes in order, so one task streams a conversation; it holds one turn.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = None, None, []
        types, names = [pa.int64(), pa.string()], ["conv_id", "repaired_sha256"]
        for batch in batches:
            texts = (text for values in in_slices(batch["text"]) for text in values)
            for conversation, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), texts):
                if state is None or conversation != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = conversation, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield _batch(done, names, types)
            done = []
        if state is not None:
            yield _batch([(current, state.hexdigest())], names, types)

    ordered = turns.select("conv_id", "chunk", "place", "role", "text").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "chunk", "place").mapInArrow(digest, DIGESTS)


def repair_report(rows: DataFrame, most: int = CHUNK_ROWS) -> DataFrame:
    """Damage all conversations, repair them and digest the result, one row each."""
    turns, counts = repair(damaged(rows), most)
    found = digests(turns).withColumnRenamed("conv_id", "of_conv")
    return counts.join(found, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
