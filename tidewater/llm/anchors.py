"""Windows that occur more than once: the frame that both substring operators run in.

A text is a row of elements (bytes, or words as 64-bit hashes); a window is ``length`` consecutive
elements. Every window is assigned to one of its short runs of ``run`` elements, the one of least
hash (leftmost on ties): its anchor. The choice depends on the window's content alone, so equal
windows have equal anchors at equal places, and only about one position in (length - run) / 2 is an
anchor. Consecutive windows of a text with one anchor make up a segment.

1. Documents are dealt by hash into groups of a few MB. Each group sends (anchor, content hash,
   document, start) of its segments, as packed arrays, to the anchor's bucket. Equal segments of a
   group are sent once, so a passage in a third of all documents arrives once per group.
2. A bucket decides what needs no text: segments equal to an earlier one repeat as a whole, and an
   anchor all of whose segments are equal or single repeats nothing else. Segments that share an
   anchor but differ are asked for.
3. The groups send just those segments' elements to their anchor's shard, where a solver finds
   every repeated window exactly: an FM-index or a suffix sort, the operator's choice.
4. Repeated windows return to their group and the covered elements are marked.

Each step is a Spark shuffle of packed rows; memory is bounded by the group, the bucket and the shard,
whose numbers grow with the input. The documents are shuffled once and that exchange is used by
steps 1, 3 and 4.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_stage, ready, utf8_buffer, word_bounds

GROUP_BYTES = 4 << 20
BUCKET_RECORDS = 400_000
BATCH_SEGMENTS = 20_000
#: Position bits in a selection key: most elements of one piece.
PLACE_BITS = 21
LAST_ID = np.iinfo(np.int64).max

U = np.uint64
RANDOM = np.random.default_rng(0x5EED)
BYTE_VALUE = RANDOM.integers(0, 1 << 64, 256, dtype=U)
BASE, BASE_INVERSE = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP_FACTORS = RANDOM.integers(0, 1 << 63, 16, dtype=U) * U(2) + U(1)

#: What travels of a segment. An anchor is known by its bucket and 32 more bits of its hash: different anchors that
#: fall together are only compared for nothing.
SEGMENT = np.dtype([("anchor", "<u4"), ("content", "<u8"), ("doc", "<i4"), ("start", "<i4"), ("windows", "<u2"), ("place", "<u2")])
LOCAL = np.dtype([*SEGMENT.descr, ("high", "<u4")])
FOUND = np.dtype([("doc", "<i4"), ("start", "<i4"), ("windows", "<i4")])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(29))


_POWERS: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64; the longest asked for are kept."""
    if len(_POWERS[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for k, b in enumerate((BASE, BASE_INVERSE)):
            x = np.full(size, b, U)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """n+1 running sums of value * base^position; ``(s[j] - s[i]) * base^-i`` is the polynomial hash of i..j."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their byte bounds."""
    if not len(starts):
        return np.zeros(0, U)
    out = np.zeros(len(starts), U)
    for a in range(0, len(starts), 1 << 17):     # powers of one chunk at a time
        s, e = starts[a:a + (1 << 17)], ends[a:a + (1 << 17)]
        sums = prefix_hashes(BYTE_VALUE[data[s[0]:e[-1]]])
        i, j = s - s[0], e - s[0]
        out[a:a + len(s)] = mixed((sums[j] - sums[i]) * powers(int(i[-1]) + 1)[1][i] + (j - i).astype(U) * STEP_FACTORS[0])
    return out


def segments(values: np.ndarray, off: np.ndarray, length: int, run: int) -> np.ndarray:
    """Segments of texts given by their element offsets; ``start`` counts from the text's first element."""
    n = len(values)
    if n < length:
        return np.zeros(0, LOCAL)
    h, span, i = values, 1, 0
    while span < run:       # run is a power of two
        h = h[:-span] * STEP_FACTORS[i] + h[span:]
        span, i = span * 2, i + 1
    h = mixed(h)
    low = U((1 << PLACE_BITS) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=U)
    width, span = length - run + 1, 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[:len(key) - (width - span)], key[width - span:])
    place = (key & low).astype(np.int64)        # the anchor of the window that starts here
    sizes = np.diff(off)
    long = np.flatnonzero(sizes >= length)
    delta = np.zeros(len(place) + 1, np.int8)
    np.add.at(delta, off[long], 1)
    np.add.at(delta, off[long] + sizes[long] - length + 1, -1)
    valid = np.cumsum(delta[:-1], dtype=np.int8).astype(bool)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    end = valid.copy()
    end[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    doc = np.searchsorted(off, first, side="right") - 1
    sums, inverse = prefix_hashes(values), powers(n)[1]
    out = np.empty(len(first), LOCAL)
    out["anchor"], out["high"] = h[place[first]] & U(0xFFFFFFFF), h[place[first]] >> U(32)
    out["content"] = mixed((sums[last + length] - sums[first]) * inverse[first] + (last - first).astype(U) * STEP_FACTORS[1])
    out["doc"], out["start"] = doc, first - off[doc]
    out["windows"], out["place"] = last - first + 1, place[first] - first
    return out


def all_segments(values: np.ndarray, off: np.ndarray, length: int, run: int, most: int = 1 << 18) -> np.ndarray:
    """``segments`` of any amount of text: in pieces of whole texts, and a very long text in pieces that
    overlap by a window less one element (its segments are then cut there, equally correct)."""
    out, n, i = [], len(off) - 1, 0
    limit = (1 << PLACE_BITS) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        a, b = int(off[i]), int(off[j])
        if b - a <= limit:
            s = segments(values[a:b], off[i:j + 1] - a, length, run)
            s["doc"] += i
            out.append(s)
        else:       # one long text
            for c in range(a, b - length + 1, most):
                d = min(b, c + most + length - 1)
                s = segments(values[c:d], np.array([0, d - c]), length, run)
                s["doc"] += i
                s["start"] += c - a
                out.append(s)
        i = j
    return np.concatenate(out) if out else np.zeros(0, LOCAL)


# ------------------------------------------------------------------------------------------------
# groups of documents
# ------------------------------------------------------------------------------------------------
@dataclass
class Group:
    """The documents of one group, ordered by (id, text); equal rows are interchangeable."""
    table: pa.Table
    ids: np.ndarray         # null: LAST_ID
    data: np.ndarray        # UTF-8 of all texts
    off: np.ndarray


def group_of(t: pa.Table) -> Group:
    """Columns: group, id, text, then any others."""
    ids = t.column(1).combine_chunks().fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    srt = ids[order]
    if (srt[1:] == srt[:-1]).any():
        texts = t.column(2).to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i] or "")), np.int64)
    t = t.take(pa.array(order))
    data, off = utf8_buffer(t.column(2))
    return Group(t, ids[order], data, off)


def elements(g: Group, words: bool) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """Element values and offsets by document, and the words' byte bounds."""
    if not words:
        return BYTE_VALUE[g.data], g.off, None
    starts, ends, off = word_bounds(g.data, g.off)
    return word_values(g.data, starts, ends), off, (starts, ends)


def deal(docs: DataFrame, id_col: str, text: str, carry: list[str]) -> tuple[DataFrame, int]:
    """__g, id, text and the carried columns, and the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = max(1, -(-total // GROUP_BYTES))
    return docs.select(F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(n)).cast("int").alias("__g"),
                       F.col(id_col).cast("long").alias("__id"), F.col(text).alias("__text"), *carry), total


def packed(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


#: Packed records on their way: to a bucket or shard ("to"), of a group, with the ids of its documents.
SENT = pa.schema([("to", pa.int32()), ("g", pa.int32()), ("numbers", pa.binary()), ("ids", pa.binary()), ("records", pa.binary()),
                  ("body", pa.binary())])
SENT_SQL = "to int, g int, numbers binary, ids binary, records binary, body binary"
BACK = pa.schema([("__g", pa.int32()), ("kind", pa.int32()), ("records", pa.binary())])
BACK_SQL = "__g int, kind int, records binary"
REPEATED, ASKED = 0, 1


def received(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records of all rows of a bucket, with the documents' numbers in their groups; the group and document id of each."""
    parts, groups, ids = [], [], []
    for g, number, doc_id, r in zip(*(t.column(c).to_pylist() for c in ("g", "numbers", "ids", "records")), strict=True):
        r = np.frombuffer(r, SEGMENT).copy()
        ids.append(np.frombuffer(doc_id, np.int64)[r["doc"]])
        r["doc"] = np.frombuffer(number, np.int32)[r["doc"]]
        parts.append(r)
        groups.append(np.full(len(r), g, np.int64))
    return np.concatenate(parts), np.concatenate(groups), np.concatenate(ids)


def returned(g: np.ndarray, kind: int, records: np.ndarray) -> list[tuple]:
    """One row per group."""
    order = np.argsort(g, kind="stable")
    g, records = g[order], records[order]
    return [(int(g[a]), kind, records[a:b].tobytes()) for a, b in ranges(g)]


def ranges(keys: np.ndarray) -> list[tuple[int, int]]:
    """First and last + 1 of every run of equal keys."""
    if not len(keys):
        return []
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return list(zip(cut.tolist(), [*cut[1:].tolist(), len(keys)], strict=True))


def send(g: int, ids: np.ndarray, records: np.ndarray, to: np.ndarray, body: Callable) -> list[tuple]:
    """One row per destination, with the numbers and ids of just the documents named; ``body(part)``: bytes sent along,
    given the positions of the part in ``records``."""
    order = np.argsort(to, kind="stable")
    to, rows = to[order], []
    for a, b in ranges(to):
        part = np.empty(b - a, SEGMENT)
        for name in SEGMENT.names:
            part[name] = records[name][order[a:b]]
        used, part["doc"] = np.unique(part["doc"], return_inverse=True)
        rows.append((int(to[a]), g, used.astype(np.int32).tobytes(), ids[used].tobytes(), part.tobytes(), body(order[a:b])))
    return rows


def decide(t: pa.Table, same_document: bool) -> pa.Table:
    """Step 2, of one bucket."""
    new_stage()
    held = [(g, REPEATED, x) for g, x in zip(t.column("g").to_pylist(), t.column("body").to_pylist(), strict=True) if x]
    recs, g, doc_id = received(t)
    order = np.argsort(recs["anchor"], kind="stable")
    a = recs["anchor"][order]
    twice = np.zeros(len(a), bool)
    twice[1:] = a[1:] == a[:-1]
    twice[:-1] |= twice[1:]
    keep = order[twice]
    if not len(keep):
        return packed(held, BACK)
    recs, g, doc_id = recs[keep], g[keep], doc_id[keep]
    order = np.lexsort((recs["start"], recs["doc"], g, doc_id, recs["content"], recs["anchor"]))
    recs, g, doc_id = recs[order], g[order], doc_id[order]
    new_anchor = np.r_[True, recs["anchor"][1:] != recs["anchor"][:-1]]
    new = new_anchor | np.r_[True, recs["content"][1:] != recs["content"][:-1]]
    owner = np.flatnonzero(new)[np.cumsum(new) - 1]
    repeated = ~new if same_document else doc_id != doc_id[owner]
    group = np.cumsum(new_anchor) - 1
    contents = np.bincount(group, weights=new)[group]
    asked = ~repeated & (contents > 1)
    return packed(held + returned(g[repeated], REPEATED, plain(recs[repeated])) + returned(g[asked], ASKED, recs[asked]), BACK)


def plain(recs: np.ndarray) -> np.ndarray:
    out = np.empty(len(recs), FOUND)
    for name in FOUND.names:
        out[name] = recs[name]
    return out


def runs_of(hit: np.ndarray, recs: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Repeated windows, given one bool for each window of the records, as runs."""
    seg = np.repeat(np.arange(len(recs)), recs["windows"])
    pos = spans(np.zeros(len(recs), np.int64), recs["windows"].astype(np.int64))
    border = np.r_[True, seg[1:] != seg[:-1]] if len(seg) else np.zeros(0, bool)
    a = np.flatnonzero(hit & (border | np.r_[True, ~hit[:-1]])) if len(seg) else np.zeros(0, int)
    b = np.flatnonzero(hit & np.r_[border[1:] | ~hit[1:], True]) if len(seg) else np.zeros(0, int)
    out = np.empty(len(a), FOUND)
    out["doc"], out["start"], out["windows"] = recs["doc"][seg[a]], recs["start"][seg[a]] + pos[a], b - a + 1
    return g[seg[a]], REPEATED, out


def removed_mask(off: np.ndarray, found: np.ndarray, length: int) -> np.ndarray:
    """True at the elements that the repeated windows cover."""
    delta = np.zeros(int(off[-1]) + 1, np.int64)
    at = off[found["doc"]] + found["start"]
    np.add.at(delta, at, 1)
    np.add.at(delta, at + found["windows"] + length - 1, -1)
    return np.cumsum(delta[:-1]) > 0


def mark_repeats(docs: DataFrame, *, length: int, run: int, words: bool, same_document: bool, solve: Callable, finish: Callable,
                 result: T.StructType, id_col: str, text: str, carry: list[str]) -> DataFrame:
    """``solve(records, doc_id, values, at, length)`` gives a bool for each window of the asked segments, whose elements are
    ``values[at[i]:at[i + 1]]``, in the order of anchors, documents and starts; ``finish(group, removed elements, element
    offsets, word bounds)`` gives the result's columns. ``same_document``: an earlier start in the same document counts."""
    ready(docs.sparkSession)
    dealt, total = deal(docs, id_col, text, carry)
    density = 2 / (length - run + 2) / (6 if words else 1)
    n_buckets = n_shards = max(8, int(total * density / BUCKET_RECORDS))

    def announce(t: pa.Table) -> pa.Table:
        new_stage()
        g = group_of(t)
        values, off, _ = elements(g, words)
        recs = all_segments(values, off, length, run)
        if not len(recs):
            return packed([], SENT)
        # of equal segments of the group the first is sent; those a bucket would call repeated go along as such
        recs = recs[np.lexsort((recs["start"], recs["doc"], recs["content"], recs["anchor"]))]
        same = np.r_[False, (recs["content"][1:] == recs["content"][:-1]) & (recs["anchor"][1:] == recs["anchor"][:-1])]
        owner = np.maximum.accumulate(np.where(same, 0, np.arange(len(recs))))
        later = same if same_document else same & (g.ids[recs["doc"]] != g.ids[recs["doc"][owner]])
        to = (recs["high"] % np.uint32(n_buckets)).astype(np.int64)
        back_to, back = to[later], recs[later]
        order = np.argsort(back_to, kind="stable")
        held = {int(back_to[order[a]]): plain(back[order[a:b]]).tobytes() for a, b in ranges(back_to[order])}
        recs, to = recs[~later], to[~later]
        return packed(send(int(t.column(0)[0].as_py()), g.ids, recs, to, lambda part: held.get(int(to[part[0]]), b"")), SENT)

    def cut(docs_: pa.Table, back: pa.Table) -> pa.Table:
        new_stage()
        asked = [np.frombuffer(r, SEGMENT) for r in back.column(2).to_pylist()]
        if not asked or not docs_.num_rows:
            return packed([], SENT)
        g, recs = group_of(docs_), np.concatenate(asked)
        if words:
            starts, ends, off = word_bounds(g.data, g.off)
            source = word_values(g.data, starts, ends)
        else:
            source, off = g.data, g.off
        first, size = off[recs["doc"]] + recs["start"], recs["windows"].astype(np.int64) + length - 1
        to = (mixed(recs["anchor"].astype(U)) % U(n_shards)).astype(np.int64)
        return packed(send(int(docs_.column(0)[0].as_py()), g.ids, recs, to,
                           lambda part: source[spans(first[part], size[part])].tobytes()), SENT)

    def resolve(t: pa.Table) -> pa.Table:
        new_stage()
        recs, g, doc_id = received(t)
        values = np.frombuffer(b"".join(t.column("body").to_pylist()), U if words else np.uint8)
        at = np.concatenate([[0], np.cumsum(recs["windows"].astype(np.int64) + length - 1)])
        # anchors that meet in a shard, in batches of whole anchors
        order = np.lexsort((recs["start"], recs["doc"], g, doc_id, recs["anchor"]))
        rows, a = [], 0
        cuts = np.array([b for _, b in ranges(recs["anchor"][order])])
        while a < len(order):
            b = int(cuts[min(np.searchsorted(cuts, a + BATCH_SEGMENTS), len(cuts) - 1)])
            mine = order[a:b]
            size = at[mine + 1] - at[mine]
            part = recs[mine]
            hit = solve(part, doc_id[mine], values[spans(at[mine], size)], np.concatenate([[0], np.cumsum(size)]), length)
            rows += returned(*runs_of(hit, part, g[mine]))
            a = b
        return packed(rows, BACK)

    def close(docs_: pa.Table, back: pa.Table) -> pa.Table:
        new_stage()
        if not docs_.num_rows:
            return target.empty_table()
        g = group_of(docs_)
        starts, ends, off = word_bounds(g.data, g.off) if words else (None, None, g.off)
        found = [np.frombuffer(r, FOUND) for r in back.column(2).to_pylist()]
        mask = removed_mask(off, np.concatenate([np.zeros(0, FOUND), *found]), length)
        return pa.Table.from_arrays([*finish(g, mask, off, (starts, ends)), *[g.table.column(c) for c in carry]], schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    full = T.StructType([*result.fields, *[dealt.schema[c] for c in carry]])
    target = to_arrow_schema(full)
    by_group = dealt.groupBy("__g")
    sent = by_group.applyInArrow(announce, SENT_SQL)
    back = sent.groupBy("to").applyInArrow(lambda t: decide(t, same_document), BACK_SQL)
    asked = by_group.cogroup(back.filter(F.col("kind") == ASKED).groupBy("__g")).applyInArrow(cut, SENT_SQL)
    solved = asked.groupBy("to").applyInArrow(resolve, BACK_SQL)
    every = back.filter(F.col("kind") == REPEATED).unionByName(solved)
    return by_group.cogroup(every.groupBy("__g")).applyInArrow(close, full)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive ranges, one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    at = np.cumsum(sizes) - sizes
    return np.repeat(starts - at, sizes) + np.arange(int(sizes.sum()))
