"""Conversation structure repair against a search over all edits, and against the contract's columns computed row by row."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidewater.llm import structure_repair as sr
from tidewater.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def exhaustive(rows):
    """(cost, audit) by trying every edit of every row with up to two insertions in each gap. rows: (initial, truncated, must go)."""
    best = None
    options = [[("D", "", 4)] if gone else [("K", i, 3 * cut), ("R", "u", 3 + 3 * cut), ("R", "a", 3 + 3 * cut), ("D", "", 4)] for i, cut, gone in rows]
    gaps = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*options):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            out, audit, cost = "", "", 0
            for k, more in enumerate(ins):
                out, audit, cost = out + more, audit + "I" * len(more), cost + 3 * len(more)
                if k < len(edits):
                    out, audit, cost = out + edits[k][1], audit + edits[k][0], cost + edits[k][2]
            if LEGAL.match(out) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_states(rows):
    """The same by least (cost, audit) per state, row after row."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    now = {0: (0, "")}

    def insert(cells):
        for _ in range(3):
            for (p, c), q in step.items():
                if c != "s" and p in cells:
                    x = (cells[p][0] + 3, cells[p][1] + "I")
                    cells[q] = min(cells.get(q, x), x)
        return cells

    now = insert(now)
    for i, cut, gone in rows:
        new = {}
        for p, (c, a) in now.items():
            moves = [(p, c + 4, a + "D")]
            if not gone:
                moves += [(step[p, i], c + 3 * cut, a + "K")] if (p, i) in step else []
                moves += [(step[p, x], c + 3 + 3 * cut, a + "R") for x in "ua" if (p, x) in step]
            for q, cost, audit in moves:
                new[q] = min(new.get(q, (cost, audit)), (cost, audit))
        now = insert(new)
    return min(now[p] for p in (0, 3) if p in now)


def kind(i, cut, gone):
    return sr.MUST_GO if gone else {"s": 1, "u": 2, "a": 3}.get(i, 0) * 2 + cut


def charted(rows):
    import numpy as np

    kinds = np.array([kind(*r) for r in rows], np.int64)
    fold = sr.Fold()
    for a in range(0, len(rows), sr.BLOCK):
        size = min(sr.BLOCK, len(rows) - a)
        fold.add([sr.unpack(x) for x in sr.block_cells(kinds, np.array([a]), np.array([size]))[0].tolist()])
    cells = fold.cells()
    return sr.least(cells[i] for i in sr.ROOTS)


def some_rows(rng, n):
    return [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.25) for _ in range(n)]


def test_states_are_right():
    rng = random.Random(3)
    for _ in range(60):
        rows = some_rows(rng, rng.randrange(0, 4))
        assert by_states(rows) == exhaustive(rows)


def test_chart_of_blocks_and_long_conversations():
    rng = random.Random(4)
    for _ in range(600):
        rows = some_rows(rng, rng.choice([0, 1, 2, 3, 5, 7, 8, 9, 16, 17, 40]))
        assert charted(rows) == by_states(rows)
    for rows in ([("u", False, False)] * 8, [("a", False, False)] * 8, [("s", True, False)] * 8, [("t", True, True)] * 300, some_rows(rng, 1000)):
        assert charted(rows) == by_states(rows)


def test_packing_of_cells():
    for c in [(0, ""), (38, "I" * 26), (5, "DDKRI"), None]:
        assert sr.unpack(sr.pack(c)) == c


def brute(rows, ordered_by):
    """The contract, row by row. rows: (conv, turn, role, text) after damage, with how often each stands."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, r, x) for c, t, r, x, n in rows if c == conv for _ in range(n)),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1], ordered_by(conv, r[1], r[2])))
        seen, facts, kinds = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                facts[fault] += 1
            kinds.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
        cost, audit = by_states(kinds)
        turns = {t for t, _, _ in mine if t is not None}
        at, last, kept = 0, "", []
        for edit in audit:
            if edit != "I":
                _, role, text = mine[at]
                at += 1
            if edit == "D":
                continue
            made = "assistant" if last == "u" else "user"
            kept.append((role, text) if edit == "K" else (made, text) if edit == "R" else (made, ""))
            last = kept[-1][0][:1]
        assert LEGAL.match("".join(r[:1] for r, _ in kept))
        initials = [r[:1] for _, r, _ in mine]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, facts["blank"], facts["duplicate"], facts["truncated"],
                     sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def damage(rows):
    blank = lambda x: " " if x is None else x
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out.append((conv, turn, "user" if h == 4 else role, text, 0 if h == 0 else 2 if h == 3 else 1))
    return out


def key(conv, role, text):
    name = "" if conv is None else str(conv)
    return hashlib.sha256(f"{'true' if conv is None else 'false'}{name}:{len(role)}:{role}{text}".encode()).digest()


ODD = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (None, None, "assistant", "Yes"), (0, None, "", "x."),
       (1, 0, "user", ""), (1, 1, "assistant", " \n"), (2, 5, "system", "Be.\n "), (2, -5, "user", "a" * 300_000 + "."), (2, 5, "assistant", "ok?"),
       (2, 5, "user", "Ünïcödé!"), (3, 1, "tool", "t."), (4, 1, "user", "Q?"), (4, 2, "assistant", "A."), (4, 3, "user", "Q?"), (4, 9, "assistant", "no end")]


def many(n=120):
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", None]
    rows = [(c, rng.choice([t, t, t, t + 1, None]), rng.choices(roles, [8, 8, 1, 1, 1])[0], rng.choice(["One.", "Two!", "three", None, "x? ", f"{c}.{t}."]))
            for c in range(n) for t in range(rng.randrange(0, 12))]
    return rows + [(999, t, "user" if t % 2 == 0 else "assistant", f"m{t}." if t % 7 else "again.") for t in range(300)]


@pytest.mark.parametrize("rows", [ODD, many(), []])
def test_report(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("times", F.lit(9)).withColumn("key", F.lit("x")).withColumn("seq", F.lit(1))
    got = {r[0]: tuple(r)[1:] for r in sr.repair_report(damaged(df), times="times").collect()}
    assert got == brute(damage(rows), key)


def test_parts_of_a_conversation_meet(spark):
    """A conversation cut into many batches and tasks gives what it gives in one."""
    rows = many(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r[0]: tuple(r)[1:] for r in sr.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    blank = lambda x: " " if x is None else x
    assert got == brute([(c, t, blank(r), blank(x), 1) for c, t, r, x in rows], key)


def test_repaired_rows(spark):
    rows = [(7, 1, "user", "Q?"), (7, 2, "user", "Q?"), (7, 3, "user", "More?"), (7, 4, "assistant", "Yes."), (8, 1, "user", "")]
    got = [tuple(r) for r in sr.repaired_rows(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "position").collect()]
    assert got == [(7, 0, "user", "Q?", "K"), (7, 1, "assistant", "", "I"), (7, 2, "user", "More?", "K"), (7, 3, "assistant", "Yes.", "K")]
