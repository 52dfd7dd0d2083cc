"""Substring dedup by a hash-compared suffix sort.

Texts are rows of bytes; a byte goes where a window of 100 bytes that covers it also starts earlier,
in a smaller document or before in the same one. Segments that may hold such windows meet in a shard
by their anchor (see ``anchors``), and there the suffixes that start at the anchors are sorted.

Two suffixes are compared in logarithmic time: prefix polynomial hashes give the hash of any range,
and binary search over the length finds their common extension; the byte after it decides. The sort
is a bottom-up mergesort in which every suffix finds its place in the neighbouring run by binary
search, all suffixes of a level at once. In sorted order, suffixes that agree in the ``100 - o`` bytes
from the anchor on are neighbours; those that also agree in the ``o`` bytes before it share the window
that starts ``o`` before the anchor. The earliest stays. Every match is verified byte by byte against
the window it repeats, and the windows of an anchor for which that fails are compared by their bytes.

Defined results: a null text is empty; a text shorter than the window stays; rows of one id are texts
of their own in the order of their texts; a null id counts as the largest; texts of any length are
processed whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .anchors import BYTE_VALUE, STEP_FACTORS, U, Group, mark_repeats, mixed, powers, ranges, spans

WINDOW = 100
#: Bytes that choose a window's anchor.
RUN = 32


class Hashed:
    """Ranges of segments laid end to end by prefix polynomial hashes; positions count within a segment."""

    def __init__(self, values: np.ndarray, at: np.ndarray):
        self.values, self.at = values, at
        self.within = spans(np.zeros(len(at) - 1, np.int64), np.diff(at))
        power, self.inverse = powers(int(self.within.max(initial=0)) + 2)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(BYTE_VALUE[values] * power[self.within], out=self.sums[1:])

    def of(self, i: np.ndarray, size) -> np.ndarray:
        return (self.sums[i + size] - self.sums[i]) * self.inverse[self.within[i]]

    def common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Common extension of the positions, at most ``most``, by binary search."""
        n = np.zeros(len(i), np.int64)
        step = 1 << (int(most.max(initial=1)).bit_length() - 1)
        while step:
            live = np.flatnonzero(n + step <= most)
            a, b = i[live] + n[live], j[live] + n[live]
            n[live[self.of(a, step) == self.of(b, step)]] += step
            step >>= 1
        return n


def suffix_order(text: Hashed, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes ``start`` (of ``size`` bytes) inside their groups, which lie together. A suffix
    that another one begins with comes first; equal suffixes keep their order."""
    border = np.r_[True, group[1:] != group[:-1]]
    first = np.flatnonzero(border)[np.cumsum(border) - 1]
    count = np.bincount(np.cumsum(border) - 1)[np.cumsum(border) - 1]
    order, width, local = np.arange(len(start)), 1, np.arange(len(start)) - first
    while width < count.max(initial=0):
        run = local // width
        left = run % 2 == 0
        side = np.where(left, run + 1, run - 1) * width         # where the neighbouring run begins
        lo = np.minimum(side, count)
        hi = np.minimum(side + width, count)
        begin = lo.copy()
        mine = order                                            # the suffix at every place
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) // 2
            x, y = mine[live], order[first[live] + mid]
            most = np.minimum(size[x], size[y])
            same = text.common(start[x], start[y], most)
            ended = same == most
            bx = text.values[np.minimum(start[x] + same, len(text.values) - 1)].astype(np.int64)
            by = text.values[np.minimum(start[y] + same, len(text.values) - 1)].astype(np.int64)
            cmp = np.where(ended, size[y] - size[x], by - bx)   # sign of y against x
            before = np.where(left[live], cmp < 0, cmp <= 0)    # equal ones of the left run stay before
            lo[live] = np.where(before, mid + 1, lo[live])
            hi[live] = np.where(before, hi[live], mid)
            live = live[lo[live] < hi[live]]
        place = np.where(left, local, local - width) + (lo - begin)
        merged = np.empty_like(order)
        merged[first + place] = mine
        order, width = merged, width * 2
    return order


def repeated_windows(records: np.ndarray, doc_id: np.ndarray, values: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For every window of every segment: whether it starts earlier too. Records come in the order of
    anchors, documents and starts, so among the segments of an anchor the earliest stands first."""
    text = Hashed(values, at)
    place, windows = records["place"].astype(np.int64), records["windows"].astype(np.int64)
    # a window may start before the segment's own anchor only: starts 0..windows-1 are all <= place
    begin = at[:-1] + place
    order = suffix_order(text, begin, at[1:] - begin, records["anchor"])
    s, anchor = order, records["anchor"][order]
    size = (at[1:] - begin)[s]
    lcp = np.zeros(len(s), np.int64)
    lcp[1:] = text.common(begin[s[1:]], begin[s[:-1]], np.minimum(size[1:], size[:-1]))
    lcp[1:][anchor[1:] != anchor[:-1]] = -1
    lcp[:1] = -1
    first_window = np.cumsum(windows) - windows
    hit = np.zeros(int(windows.sum()), bool)
    checks = []
    for o in range(int(place.max(initial=0)) + 1):
        have = (place[s] >= o) & (place[s] - o < windows[s])
        cls = np.cumsum(lcp < length - o) - 1
        near = np.flatnonzero(have)
        near = near[np.bincount(cls[near], minlength=1)[cls[near]] > 1]
        if not len(near):
            continue
        i = s[near]
        key = mixed(text.of(begin[i] - o, o) + cls[near].astype(U) * STEP_FACTORS[2])
        by = np.lexsort((i, key))
        i, key = i[by], key[by]
        new = np.r_[True, key[1:] != key[:-1]]
        owner = i[np.flatnonzero(new)[np.cumsum(new) - 1]]
        i, owner = i[~new], owner[~new]
        if not len(i):
            continue
        hit[first_window[i] + place[i] - o] = True
        checks.append(np.stack([i, owner, np.full(len(i), o)]))
    if checks:
        verify(np.concatenate(checks, axis=1), hit, records, values, at, place, windows, first_window, length)
    return hit


def verify(found: np.ndarray, hit, records, values, at, place, windows, first_window, length: int) -> None:
    """Compare every repeated window with the one it repeats, byte by byte. The windows of one pair of segments are taken
    together. Where bytes differ, the anchor's windows are told apart by their bytes."""
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    i, j, o = found
    new = np.r_[True, (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (o[1:] != o[:-1] + 1)]
    a = np.flatnonzero(new)
    b = np.r_[a[1:], len(i)] - 1
    size = length + o[b] - o[a]
    x, y = at[i[a]] + place[i[a]] - o[b], at[j[a]] + place[j[a]] - o[b]
    bad = []
    for c in range(0, len(a), 1 << 13):
        p = slice(c, c + (1 << 13))
        same = values[spans(x[p], size[p])] == values[spans(y[p], size[p])]
        edge = np.concatenate([[0], np.cumsum(size[p])])[:-1]
        bad += np.unique(records["anchor"][i[a[p]][~np.logical_and.reduceat(same, edge)]]).tolist()
    for lo, hi in ranges(records["anchor"]):
        if records["anchor"][lo] in bad:
            by_bytes(range(lo, hi), hit, values, at, windows, first_window, length)


def by_bytes(segments, hit, values, at, windows, first_window, length: int) -> None:
    seen = set()
    for i in segments:
        for w in range(windows[i]):
            window = values[at[i] + w:at[i] + w + length].tobytes()
            hit[first_window[i] + w] = window in seen
            seen.add(window)


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                          carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that stay), then ``carry``."""
    result = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept", T.BinaryType())])

    def finish(g: Group, removed: np.ndarray, off: np.ndarray, _) -> list:
        begins = removed.copy()
        if len(removed):
            inner = np.ones(len(removed), bool)     # a run ends with its text
            edge = off[:-1][off[:-1] < len(removed)]
            inner[edge] = False
            begins[1:] &= ~(removed[:-1] & inner[1:])
        gone, runs = np.concatenate([[0], np.cumsum(removed)]), np.concatenate([[0], np.cumsum(begins)])
        cut = off - gone[off]
        body = g.data[~removed] if removed.any() else g.data
        kept = pa.BinaryArray.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(cut.astype(np.int32).tobytes()),
                                                                       pa.py_buffer(np.ascontiguousarray(body).tobytes())])
        return [g.table.column(1), pa.array(np.diff(off)), pa.array(gone[off[1:]] - gone[off[:-1]]),
                pa.array(runs[off[1:]] - runs[off[:-1]]), kept]

    return mark_repeats(docs, length=window, run=RUN, words=False, same_document=True, solve=repeated_windows, finish=finish,
                        result=result, id_col=id_col, text=text, carry=list(carry))
