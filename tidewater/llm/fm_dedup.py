"""Substring dedup by compressed FM-indexes, one per shard.

Documents are cut into segments that may hold repeated windows (see ``anchors``); equal windows
always meet in one shard. There an FM-index is built over the shard's segments as rows of word
hashes: the Burrows-Wheeler transform of bounded context, kept as a wavelet matrix with bit-packed
levels, and for every row of the index its class of equal windows. All segments are then streamed
through the index from their last word to their first: one backward step per word moves the
interval of the current match, and whenever the match exceeds the threshold the interval is widened
to its class, which keeps the matching statistics capped at the threshold. A window is reported where
the match reaches the threshold and the class holds a document of smaller id. Every streamed segment
is part of its shard's index, so a match never breaks off.

Words are compared by 64-bit hashes: two different passages of 50 words would need 50 collisions
(or as many as they differ in) to be taken for equal.

Defined results: a null or empty text has no words; ids that occur more than once do not repeat each
other; a null id counts as the largest; texts of any length are processed whole; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .anchors import Group, mark_repeats, spans

WINDOW = 50
#: Words that choose a window's anchor.
RUN = 8


class WaveletMatrix:
    """rank queries over a sequence of small integers, one packed bit vector per bit of the symbols."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.levels, n = [], len(seq)
        for b in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = ((seq >> b) & 1).astype(bool)
            words = np.packbits(np.concatenate([bit, np.zeros(-n % 64 + 64, bool)]), bitorder="little").view(np.uint64)
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = n - int(bit.sum())
            self.levels.append((b, words, before, zeros))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.base = self.walk(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, words, before, zeros in self.levels:
            w, r = i >> 6, (i & 63).astype(np.uint64)
            ones = before[w] + np.bitwise_count(words[w] & ((np.uint64(1) << r) - np.uint64(1)))
            i = np.where((symbol >> b) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbols before the positions."""
        return self.walk(symbol, i) - self.base[symbol]


def joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


class FMIndex:
    """Over texts laid end to end, each closed by symbol 0; contexts are sorted to ``depth`` + 1 symbols at least."""

    def __init__(self, text: np.ndarray, n_symbols: int, owner: np.ndarray, depth: int):
        n = len(text)
        shifted = lambda r, h: np.concatenate([r[h:], np.zeros(min(h, n), r.dtype)])
        rank, span = text.astype(np.int64), 1
        cls = None
        while span <= depth:
            if span * 2 > depth and cls is None:        # classes of equal windows of `depth` symbols
                cls = joint(rank, shifted(rank, depth - span)) if depth > span else rank
            rank, span = joint(rank, shifted(rank, span)), span * 2
        rows = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(text[rows - 1], n_symbols)
        counts = np.bincount(text, minlength=n_symbols)
        self.first = np.cumsum(counts) - counts
        sorted_class = cls[rows]
        new = np.r_[True, sorted_class[1:] != sorted_class[:-1]]
        begin = np.flatnonzero(new)
        self.class_of = np.cumsum(new) - 1
        self.class_begin, self.class_end = begin, np.r_[begin[1:], n]
        self.class_owner = np.minimum.reduceat(owner[rows], begin)
        self.n = n

    def back(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + match."""
        return self.first[symbol] + self.bwt.rank(symbol, lo), self.first[symbol] + self.bwt.rank(symbol, hi)


def matching_windows(records: np.ndarray, doc_id: np.ndarray, values: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For every window of every segment: whether it also starts in a document of smaller id."""
    n_seg, size = len(records), np.diff(at)
    ids, symbols = np.unique(values, return_inverse=True)
    place = at[:-1] + np.arange(n_seg)              # each text is followed by a 0
    text = np.zeros(len(values) + n_seg, np.int64)
    inside = spans(place, size)
    text[inside] = symbols + 1
    owner = np.repeat(doc_id, size + 1)
    index = FMIndex(text, len(ids) + 1, owner, length)
    hit = np.zeros(int(records["windows"].sum()), bool)
    first_window = np.cumsum(records["windows"].astype(np.int64)) - records["windows"]
    order = np.argsort(-size, kind="stable")        # longest first: the live ones are a prefix
    lo, hi, seen = np.zeros(n_seg, np.int64), np.full(n_seg, index.n, np.int64), 0
    steps = np.searchsorted(-size[order], -np.arange(1, int(size.max()) + 1), side="right")
    for t, live in enumerate(steps):
        s = order[:live]
        j = size[s] - 1 - t
        c = text[place[s] + j]
        lo_, hi_ = index.back(c, lo[:live], hi[:live])
        seen = t + 1
        if seen >= length:
            cls = index.class_of[lo_]
            lo_, hi_ = index.class_begin[cls], index.class_end[cls]
            hit[first_window[s] + j] = index.class_owner[cls] < doc_id[s]
        lo[:live], hi[:live] = lo_, hi_
    return hit


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                             carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words that stay, joined by single spaces), then ``carry``."""
    result = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def finish(g: Group, removed: np.ndarray, off: np.ndarray, bounds) -> list:
        starts, ends = bounds
        n = np.diff(off)
        gone = np.concatenate([[0], np.cumsum(removed)])
        n_removed = gone[off[1:]] - gone[off[:-1]]
        stay = np.flatnonzero(~removed)
        # every word that stays with one byte after it, which becomes a space
        size = ends[stay] - starts[stay] + 1
        body = np.concatenate([g.data, np.array([0x20], np.uint8)])[spans(starts[stay], size)]
        edge = np.cumsum(size)
        body[edge - 1] = 0x20
        count = n - n_removed
        upto = np.concatenate([[0], edge])[np.concatenate([[0], np.cumsum(count)])]
        # the space after a text's last word goes
        drop = np.ones(len(body), bool)
        last = upto[1:][count > 0] - 1
        drop[last] = False
        body = body[drop]
        cut = upto - np.concatenate([[0], np.cumsum(count > 0)])
        kept = pa.StringArray.from_buffers(len(n), pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(body.tobytes()))
        return [g.table.column(1), pa.array(n), pa.array(n_removed), kept]

    return mark_repeats(docs, length=window, run=RUN, words=True, same_document=False, solve=matching_windows, finish=finish,
                        result=result, id_col=id_col, text=text, carry=list(carry))
