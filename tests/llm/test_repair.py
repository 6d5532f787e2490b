"""Conversation repair against plain search and a reading of whole tables in Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from postlytics.llm import repair
from postlytics.llm.queries import QUERIES
from tests.conftest import SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
ENDED = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
FORM = re.compile(r"(s?(ua)+)?\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def plain_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        faults.append(
            "blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen else "" if ENDED.search(text) else "truncated"
        )
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """Least (cost, audit) of every state after each row; at most three inserts at a place."""
    best = {"": (0, "", [])}  # by what the role sequence is worth: '', 's', 'u', 'a'
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def least(options):
        found = {}
        for state, way in options:
            found[state] = min(found.get(state, way), way)
        return found

    def with_inserts(best):
        options = list(best.items())
        for _ in range(3):
            options += [
                (step[state, r], (c + 2, a + "I", out + [(names[r], "")]))
                for state, (c, a, out) in options for r in "ua" if (state, r) in step
            ]
        return least(options)

    for (_, _, role, text), fault in zip(rows, faults):
        options = []
        for state, (c, a, out) in with_inserts(best).items():
            options.append((state, (c + 3, a + "D", out)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (state, role[:1]) in step:
                    options.append((step[state, role[:1]], (c + more, a + "K", out + [(role, text)])))
                options += [
                    (step[state, r], (c + 2 + more, a + "R", out + [(names[r], text)])) for r in "ua" if (state, r) in step
                ]
        best = least(options)
    return min(way for state, way in with_inserts(best).items() if state in ("", "a"))


def plain(rows):
    groups = {conv: [] for conv, *_ in rows}
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    out = {}
    for conv, part in groups.items():
        part.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        faults = plain_faults(part)
        turns = {r[1] for r in part} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(part)]
        cost, audit, repaired = plain_repair(part, faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def report(frame, most=repair.CHUNK_ROWS):
    return {r[0]: tuple(r[1:]) for r in repair.repair_report(frame, most).collect()}


def test_agenda_equals_every_edit_sequence():
    draw = random.Random(1)
    for _ in range(150):
        rows = [(0, 0, draw.choice(["user", "assistant", "system", "x"]), "") for _ in range(draw.randrange(4))]
        faults = [draw.choice(["", "", "truncated", "blank"]) for _ in rows]
        best = None
        for length in range(len(rows), len(rows) + 5):
            for audit in itertools.product("DIKR", repeat=length):
                if sum(e != "I" for e in audit) != len(rows):
                    continue
                for roles in itertools.product("ua", repeat=sum(e in "IR" for e in audit)):
                    chosen, at, made, cost = iter(roles), 0, "", 0
                    for edit in audit:
                        if edit == "I":
                            made, cost = made + next(chosen), cost + 2
                            continue
                        fault, role, at = faults[at], rows[at][2][0], at + 1
                        cost += {"K": 0, "R": 2, "D": 3}[edit] + (fault == "truncated" and edit != "D")
                        cost += 1000 * (fault == "blank" and edit != "D")
                        made += role if edit == "K" else next(chosen) if edit == "R" else ""
                    if FORM.match(made) and cost < 1000:
                        best = min(best or (cost, "".join(audit)), (cost, "".join(audit)))
        items = [repair.Row(row[2][0], fault, 1) for row, fault in zip(rows, faults)]
        assert repair.lightest(items, [repair.NOTHING], True)[repair.NOTHING, repair.GOAL] == best
        assert plain_repair(rows, faults)[:2] == best


def random_rows(draw, conversations, longest):
    texts = ["a.", "b!", "c?", "no end", "", " \t", "same.", "same.", None, "x" * 40]
    return [
        (conv, draw.choice([None, turn, turn, turn, turn + draw.randrange(3)]), draw.choice(["user", "assistant", "system", "tool", "", None]), draw.choice(texts) and f"{draw.choice(texts)}{draw.randrange(5)}{draw.choice(['.', ''])}")
        for conv in [None, *range(conversations)] for turn in range(draw.randrange(1, longest))
    ]


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_repair_equals_plain_reading(spark, chunk):
    rows = random_rows(random.Random(chunk), 60, 14)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert report(frame, chunk) == plain(rows)


def test_long_conversation_spreads_over_tasks(spark):
    draw = random.Random(9)
    rows = [(7, turn, draw.choice(["user", "assistant"]), f"t{turn}" + draw.choice([".", ""])) for turn in range(3000)]
    frame = spark.createDataFrame(rows + [(8, 1, "user", "q.")], SCHEMA)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # the rows are few
    try:
        chunks = repair.derive_chunks(repair.judged(repair.damaged(frame)))
        assert chunks.filter("conv_id = 7").selectExpr("shiftright(chunk, 40) AS task").distinct().count() > 1
    finally:
        spark.conf.set(name, before)
    assert report(frame) == plain(rows + [(8, 1, "user", "q.")])


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()}
    assert got == plain(rows)


def test_copies_long_texts_clashes_and_empty_table(spark):
    rows = [(1, 0, "user", "q." * 50_000)] * 300 + [(1, 1, "assistant", "a."), (2, None, None, None)]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", chunk string, digest int")
    assert report(frame) == plain(rows)
    assert report(frame.filter("conv_id > 5")) == {}


def test_repaired_turns_are_returned(spark):
    rows = [(1, 0, "assistant", "first."), (1, 1, "assistant", "second"), (1, 2, "user", "")]
    turns, counts = repair.repair(spark.createDataFrame(rows, SCHEMA))
    found = [(r.edit, r.role, r.text) for r in turns.orderBy("chunk", "place").collect()]
    assert found == [("R", "user", "first."), ("K", "assistant", "second")]
    assert (counts.first().cost, counts.first().audit) == (6, "RKD")
