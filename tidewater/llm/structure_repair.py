"""Conversation structure repair by weighted CYK parsing over intervals.

A repaired conversation reads, by the first letters of its roles, as ``(s?(ua)+)?``: nothing, or pairs of user and
assistant behind at most one system row. Edits turn any conversation into one: Keep (0), Rerole to user or assistant
(3), Delete (4; the only edit of a blank or repeated row) and Insert of an empty user or assistant row (3). A truncated
row that stays costs 3 more.

The repair grammar is in Chomsky normal form. Its nonterminals X_pq stand for "these rows, edited, lead the pattern from
state p to state q", the states being nothing, system, user or assistant last:

    S    -> X_00 | X_03
    X_pq -> X_pr X_rq               (26 binary rules)
    X_pq -> row                     (one edit of the row, with the insertions that may stand on either side of it)

The insertion closure - the cheapest insertions that lead from p to q without a row - is folded into the lexical
rules. Cells hold the least (cost, audit), the audit being the edits' initials. Of two audits of the same rows and equal
cost neither begins with the other (the rest would be insertions, which cost), so the least of a concatenation is the
concatenation of the least, and cells may be combined in any order.

1. Rows are reduced to classes (conversation, turn, role, text digest) with counts, map-side first, so a row that is
   repeated a billion times is one class. The least turn of every (conversation, role, text) tells repeated rows.
2. Classes are range-partitioned by their order, so a conversation that holds a third of all rows is spread. Every task
   charts the part of a conversation it holds: all spans of all blocks of at most eight rows, bottom-up by span length and
   over every split, for all blocks at once (a cell is one 64-bit number: cost, audit, length), then spans of blocks, by
   doubling. A part leaves its eleven cells.
3. The parts of a conversation and its rows are sorted together; a task folds the parts into the audit and applies it to
   the rows that follow, as a stream. Spark's sort spills; Python holds one audit and one batch of rows.

What one conversation returns is one row (its audit holds a letter for each row), so its audit must fit a Spark value, and
its digest is computed by one task, in a stream.

Defined results: null values of any column but the turn are one space; rows are taken by turn, null first, within a turn by
role and the SHA-256 digest of conversation, role and text (equal rows are interchangeable); a null conversation id is a
conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, new_stage, ready

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = "DIKR"                    # in ASCII order: a letter's code is its place
SPACE = r"[\x20\x09-\x0D]"

#: Where a row of initial s, u or a leads from each state.
STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The nonterminals X_pq in the order of cells.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
NUMBER = {x: i for i, x in enumerate(PAIRS)}
#: Binary rules (target, left, right), ordered by target.
RULES = sorted((NUMBER[p, q], NUMBER[p, r], NUMBER[r, q]) for p, q in PAIRS for r in range(4) if (p, r) in NUMBER and (r, q) in NUMBER)
ROOTS = (NUMBER[0, 0], NUMBER[0, 3])

Cell = tuple[int, str] | None
Cells = list[Cell]


def least(cells) -> Cell:
    return min((x for x in cells if x), default=None)


def joined(a: Cell, b: Cell) -> Cell:
    return (a[0] + b[0], a[1] + b[1]) if a and b else None


def product(left: Cells, right: Cells) -> Cells:
    """The cells of two adjacent spans, combined by the binary rules."""
    return [least(joined(left[a], right[b]) for _, a, b in rules) for _, rules in groupby(RULES, key=lambda x: x[0])]


def insertions() -> Cells:
    """Insertion closure: the cheapest insertions from state to state."""
    one: Cells = [(0, "") if p == q else None for p, q in PAIRS]
    for way in (STEP["u"], STEP["a"]):
        for p, q in way.items():
            one[NUMBER[p, q]] = (INSERT, "I")
    while (two := product(one, one)) != one:
        one = two
    return one


def lexical(initial: str, truncated: bool, must_go: bool) -> Cells:
    """Cells of one row: an edit between insertions."""
    edits: dict[tuple[int, int], list] = {(p, p): [(DELETE, "D")] for p in range(4)}
    extra = TRUNCATED if truncated else 0
    if not must_go:
        for p, q in STEP.get(initial, {}).items():
            edits.setdefault((p, q), []).append((KEEP + extra, "K"))
        for way in (STEP["u"], STEP["a"]):
            for p, q in way.items():
                edits.setdefault((p, q), []).append((REROLE + extra, "R"))
    row = [least(edits.get(x, [])) for x in PAIRS]
    return product(product(insertions(), row), insertions())


#: Kinds of rows: initial (0 other, 1 s, 2 u, 3 a) * 2 + truncated, and 8: must go.
MUST_GO = 8
KINDS = [lexical(" sua"[k // 2], bool(k % 2), False) for k in range(8)] + [lexical(" ", False, True)]

# ------------------------------------------------------------------------------------------------
# Packed cells: cost in the top 7 bits, 26 letters of 2 bits, length in the lowest 5. A span of eight rows costs at most
# 8 * 4 + 6 and holds at most two insertions in a gap, as a third would return to a state. Impossible: cost 63.
# ------------------------------------------------------------------------------------------------
BLOCK = 8
U = np.uint64
COST_AT, TEXT_BITS, LOW = U(57), 52, U(31)
IMPOSSIBLE = U(63) << COST_AT
TEXT = ((U(1) << U(TEXT_BITS)) - U(1)) << U(5)


def pack(cell: Cell) -> int:
    if cell is None:
        return int(IMPOSSIBLE)
    code = 0
    for x in cell[1]:
        code = code << 2 | LETTERS.index(x)
    return cell[0] << 57 | (code << (TEXT_BITS - 2 * len(cell[1]))) << 5 | len(cell[1])


def unpack(x: int) -> Cell:
    if x >= int(IMPOSSIBLE):
        return None
    code, n = (x >> 5) & ((1 << TEXT_BITS) - 1), x & 31
    return x >> 57, "".join(LETTERS[code >> (TEXT_BITS - 2 - 2 * i) & 3] for i in range(n))


LEAVES = np.array([[pack(c) for c in cells] for cells in KINDS], U)
LEFT, RIGHT = np.array([x[1] for x in RULES]), np.array([x[2] for x in RULES])
FIRST_RULE = np.flatnonzero(np.r_[True, np.diff([x[0] for x in RULES]) > 0])


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Packed cells (..., 11) of two adjacent spans by the binary rules: for every target the least."""
    a, b = left[..., LEFT], right[..., RIGHT]
    n = a & LOW
    text = (a & TEXT) | (((b & TEXT) >> (n + n)) & TEXT)
    out = (((a >> COST_AT) + (b >> COST_AT)) << COST_AT) | text | (n + (b & LOW)) & LOW
    out = np.where((a >= IMPOSSIBLE) | (b >= IMPOSSIBLE), IMPOSSIBLE, out)
    return np.minimum.reduceat(out, FIRST_RULE, axis=-1)


def chart(kinds: np.ndarray) -> np.ndarray:
    """Cells of blocks of equal length, given their rows' kinds (blocks, rows): CYK over all spans and splits."""
    size = kinds.shape[1]
    spans_ = {1: LEAVES[kinds]}                             # by length: (blocks, start, nonterminal)
    for length in range(2, size + 1):
        starts = size - length + 1
        best = None
        for k in range(1, length):
            x = combine(spans_[k][:, :starts], spans_[length - k][:, k:k + starts])
            best = x if best is None else np.minimum(best, x)
        spans_[length] = best
    return spans_[size][:, 0]


def block_cells(kinds: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Packed cells of blocks of rows, (blocks, 11)."""
    out = np.empty((len(begin), len(PAIRS)), U)
    for n in np.unique(size):
        mine = np.flatnonzero(size == n)
        for a in range(0, len(mine), 4096):
            part = mine[a:a + 4096]
            out[part] = chart(kinds[begin[part][:, None] + np.arange(n)])
    return out


class Fold:
    """Cells of consecutive spans, joined by doubling: like a binary counter, so letters are copied a logarithm of times."""

    def __init__(self):
        self.stack: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        size = 1
        while self.stack and self.stack[-1][0] <= size:
            n, left = self.stack.pop()
            cells, size = product(left, cells), size + n
        self.stack.append((size, cells))

    def cells(self) -> Cells:
        out = None
        for _, left in reversed(self.stack):
            out = left if out is None else product(left, out)
        return out if out is not None else insertions()


# ------------------------------------------------------------------------------------------------
# Spark
# ------------------------------------------------------------------------------------------------
def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, times: str | None) -> DataFrame:
    known = lambda c: F.coalesce(F.col(c), F.lit(" "))
    name = F.coalesce(F.col(conv).cast("string"), F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.col(conv).isNull().cast("string"), name, F.lit(":"), F.length(known(role)).cast("string"), F.lit(":"),
                                  known(role), known(text)), 256))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), known(role).alias("role"), known(text).alias("text"),
                       (F.col(times) if times else F.lit(1)).cast("long").alias("times"), key.alias("key"))


FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
PART = ("seq long, first_turn long, last_turn long, turns long, n_blank long, n_duplicate long, n_truncated long, n_illegal long, "
        "first_initial string, last_initial string, packed binary, cells array<struct<cost:long,audit:string>>")
PART_NAMES = [x.rsplit(" ", 1)[0] for x in PART.split(", ")]


def parts(classes: DataFrame) -> DataFrame:
    """One row per conversation and batch of ordered classes: the cells and counts of that part."""
    from pyspark.sql.pandas.types import to_arrow_schema

    conv_type = classes.schema["conv"].dataType.simpleString()
    schema = f"conv {conv_type}, {PART}"
    target = to_arrow_schema(classes.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        new_stage()
        task, k = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pylist(part_rows(b, task + k), schema=target)
                k += 1

    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    return classes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def part_rows(b: pa.RecordBatch, seq: int) -> list[dict]:
    conv, turns, roles = (b.column(i).to_pylist() for i in range(3))
    is_blank, closed, again = (np.array(b.column(b.schema.get_field_index(c)).to_pylist(), bool) for c in ("is_blank", "closed", "again"))
    n = b.column(b.schema.get_field_index("n")).to_numpy(zero_copy_only=False).astype(np.int64)
    initial = [r[:1] for r in roles]
    code = np.array([{"s": 1, "u": 2, "a": 3}.get(x, 0) for x in initial], np.int64)
    fine = ~is_blank & ~again & (n > 0)                     # the first row of the class may stay, all others go
    at = np.cumsum(n) - n
    kinds = np.full(int(n.sum()), MUST_GO, np.int64)
    kinds[at[fine]] = code[fine] * 2 + ~closed[fine]
    edge = np.flatnonzero([True, *(x != y for x, y in zip(conv[1:], conv[:-1], strict=True))])
    upto = np.r_[at, len(kinds)]
    first, last = upto[edge], upto[np.r_[edge[1:], len(conv)]]
    blocks = -(-(last - first) // BLOCK)
    owner = np.repeat(np.arange(len(edge)), blocks)
    begin = first[owner] + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    cells = block_cells(kinds, begin, np.minimum(BLOCK, last[owner] - begin))
    out, done = [], 0
    for i, (a, z) in enumerate(zip(edge.tolist(), [*edge[1:].tolist(), len(conv)], strict=True)):
        live = [j for j in range(a, z) if n[j]]
        known = [turns[j] for j in live if turns[j] is not None]
        illegal = sum(int(n[j]) - 1 for j in live) + sum(initial[x] + initial[y] not in ("su", "ua", "au") for x, y in zip(live, live[1:], strict=False))
        mine = cells[done:done + blocks[i]]
        done += int(blocks[i])
        wide = None
        if len(mine) > 1:
            fold = Fold()
            for row in mine.tolist():
                fold.add([unpack(x) for x in row])
            wide = [{"cost": c[0], "audit": c[1]} if c else None for c in fold.cells()]
        sums = lambda keep, size: int(sum(size[j] for j in live if keep[j]))
        out.append({
            "conv": conv[a], "seq": seq, "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
            "turns": len(set(known)), "n_blank": sums(is_blank, n),
            "n_duplicate": int(sum(0 if is_blank[j] else n[j] if again[j] else n[j] - 1 for j in live)),
            "n_truncated": sum(bool(fine[j] and not closed[j]) for j in live), "n_illegal": illegal,
            "first_initial": initial[live[0]] if live else None, "last_initial": initial[live[-1]] if live else None,
            "packed": mine[0].tobytes() if len(mine) == 1 else None, "cells": wide})
    return out


class Repair:
    """One conversation: its parts, then its rows."""

    def __init__(self, conv):
        self.conv, self.parts = conv, []
        self.audit = None

    def close_parts(self) -> None:
        """Audit, cost and counts from the parts."""
        parts_ = [p for p in self.parts if p["packed"] or p["cells"]]
        if len(parts_) == 1 and parts_[0]["packed"]:
            x = np.frombuffer(parts_[0]["packed"], U)
            self.cost, self.audit = unpack(int(min(x[ROOTS[0]], x[ROOTS[1]])))
        else:
            fold = Fold()
            for p in parts_:
                fold.add([unpack(x) for x in np.frombuffer(p["packed"], U).tolist()] if p["packed"]
                         else [c and (c["cost"], c["audit"]) for c in p["cells"]])
            end = fold.cells()
            self.cost, self.audit = least(end[i] for i in ROOTS)
        turns = [p for p in self.parts if p["turns"]]
        distinct = sum(p["turns"] for p in turns) - sum(x["last_turn"] == y["first_turn"] for x, y in zip(turns, turns[1:], strict=False))
        gaps = turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - distinct if turns else 0
        seam = sum((x["last_initial"] or "") + (y["first_initial"] or "") not in ("su", "ua", "au") for x, y in zip(parts_, parts_[1:], strict=False))
        total = lambda c: sum(p[c] for p in self.parts)
        self.facts = [gaps, total("n_blank"), total("n_duplicate"), total("n_truncated"), total("n_illegal") + seam]
        self.at, self.last = 0, ""

    def inserted(self):
        """Rows inserted before the next row."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self.made(None, "")

    def made(self, role: str | None, text: str, edit: str = "I") -> tuple[str, str, str]:
        role = role or ("assistant" if self.last == "u" else "user")
        self.last = role[0]
        return role, text, edit

    def row(self, role: str, text: str):
        """The repaired rows that a row gives."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self.made(role if edit == "K" else None, text, edit)


def stream(batches):
    """Sorted parts and rows of whole conversations: (conversation, None) when its parts are complete, (conversation, row) for
    every repaired row."""
    now = None
    for b in batches:
        columns = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)}
        for i, (conv, is_row) in enumerate(zip(columns["conv"], columns["is_row"], strict=True)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from finish(now)
                now = Repair(conv)
            if not is_row:
                now.parts.append({c: columns[c][i] for c in PART_NAMES})
                continue
            if now.audit is None:
                now.close_parts()
                yield now, None
            for x in now.row(columns["role"][i], columns["text"][i]):
                yield now, x
    if now is not None:
        yield from finish(now)


def finish(now: Repair):
    if now.audit is None:
        now.close_parts()
        yield now, None
    for x in now.inserted():
        yield now, x


def sorted_parts_and_rows(rows: DataFrame) -> DataFrame:
    live = F.col("times") > 0
    light = rows.select("conv", "turn", "role", "key", "times", blank(F.col("text")).alias("is_blank"),
                        F.col("text").rlike(rf"[.!?]{SPACE}*\z").alias("closed"))
    classes = light.groupBy("conv", "turn", "role", "key").agg(F.sum("times").alias("n"), F.first("is_blank").alias("is_blank"),
                                                              F.first("closed").alias("closed"))
    classes = materialise(classes, "repair-classes")
    # a row is repeated where its conversation holds role and text at an earlier turn; within a turn its class counts it
    firsts = classes.filter("n > 0").groupBy("key").agg(F.min(F.struct("turn")).alias("first"))
    marked = classes.join(firsts, "key", "left").withColumn("again", F.coalesce(~F.col("turn").eqNullSafe(F.col("first.turn")), F.lit(False)))
    marked = materialise(marked.select("conv", "turn", "role", "key", "n", "is_blank", "closed", "again"), "repair-marked")
    cells = parts(marked)
    empty = lambda names, schema: [F.lit(None).cast(schema[c].dataType).alias(c) for c in names]
    top = cells.select("conv", F.lit(False).alias("is_row"), *empty(["turn", "role", "key", "text"], rows.schema), *PART_NAMES)
    each = rows.filter(live).select("conv", "turn", "role", "key", "text", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    low = each.select("conv", F.lit(True).alias("is_row"), "turn", "role", "key", "text", *empty(PART_NAMES, cells.schema))
    order = [F.col("conv").asc_nulls_first(), "is_row", "seq", F.col("turn").asc_nulls_first(), "role", "key"]
    # by a hash of its own: a conversation's rows must meet in one task, in order
    return top.unionByName(low).repartition("conv").sortWithinPartitions(*order).select("conv", "is_row", "role", "text", *PART_NAMES)


def repair_report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  times: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 (the
    repaired rows as ``role:text``, joined by newlines). ``times``: column that says how often a row stands (0: not at all; a
    conversation of such rows alone is reported as empty)."""
    ready(rows.sparkSession)
    rows = prepared(rows, conv, turn, role, text, times)
    source = sorted_parts_and_rows(rows)
    schema = f"conv_id {rows.schema['conv'].dataType.simpleString()}, {FACTS}, cost long, audit string, repaired_sha256 string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        new_stage()
        out, now, digest = [], None, None
        for conv_, x in stream(batches):
            if x is None:
                if now is not None:
                    out.append([now.conv, *now.facts, now.cost, now.audit, digest.hexdigest()])
                    if len(out) == 4096:
                        yield batch(out)
                        out = []
                now, digest, head = conv_, hashlib.sha256(), b""
            else:
                digest.update(head + f"{x[0]}:{x[1]}".encode())
                head = b"\n"
        if now is not None:
            out.append([now.conv, *now.facts, now.cost, now.audit, digest.hexdigest()])
        yield batch(out)

    target = arrow_schema(source, schema)
    batch = lambda out: pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=target)
    return source.mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  times: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit (K, R or I)."""
    ready(rows.sparkSession)
    rows = prepared(rows, conv, turn, role, text, times)
    source = sorted_parts_and_rows(rows)
    schema = f"conv_id {rows.schema['conv'].dataType.simpleString()}, position long, role string, text string, edit string"
    target = arrow_schema(source, schema)

    def run(batches):
        new_stage()
        out, position = [], 0
        for conv_, x in stream(batches):
            if x is None:
                position = 0
                continue
            out.append({"conv_id": conv_.conv, "position": position, "role": x[0], "text": x[1], "edit": x[2]})
            position += 1
            if len(out) == 1024:
                yield pa.RecordBatch.from_pylist(out, schema=target)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=target)

    return source.mapInArrow(run, schema)


def arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)
