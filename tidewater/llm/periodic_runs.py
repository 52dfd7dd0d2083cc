"""Periodic runs of words by longest common extensions over a difference cover.

A run is a stretch of words with a smallest period q, of at least ``max(min_length, 4 q)`` words, that no neighbour
extends. All runs of a text are found on a harmonic grid: for every period q the positions i at multiples of 3 q are
asked how far the words from i and from i + q agree, forwards and backwards. A run of period q holds at least 4 q words,
so some grid position lies in it and gives exactly the run; the grids of all periods hold n/3 (1 + 1/2 + 1/3 + ...)
positions. A stretch that a multiple of its period gives again is the same stretch, and the least period keeps it.

A longest common extension takes constant time:

* Suffixes are sorted at the positions only whose number modulo 31 lies in a perfect difference cover (6 of 31). They are
  split by one word after the other up to 31, and then by doubling, as the suffix 31 * 2^k words on is a sampled one too;
  only suffixes still tied are looked at again, and only suffixes of one text are compared.
* Two positions are compared word by word until both are sampled, which the cover grants within 31 words; most differ before.
* From there the answer is the least of the adjacent common prefixes between the two in sorted order, by a sparse table.

Backward extensions are those of the reversed text. Words are numbered exactly, by a dictionary, so nothing rests on
hashes. Every document is one row and its own work: nothing is shuffled, and a task holds one piece of whole texts of
about 1 MB (or one longer text) at a time.

Defined results: a null or empty text has no words and no runs; rows are judged each, also those of one id; a null id is
kept; texts of any length are processed whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import spans
from .common import IS_SPACE, new_stage, pieces, ready, utf8_buffer, word_bounds

MIN_LENGTH, MIN_PERIODS = 6, 4
GRID = MIN_PERIODS - 1
#: A perfect difference cover: every difference modulo 31 is one of two of its members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: For a difference d: a member x of the cover with x + d in it.
MEMBER = np.array([next(x for x in COVER if (x + d) % MODULUS in COVER) for d in range(MODULUS)])
#: Grid positions asked at once.
CHUNK = 1 << 19


class Extensions:
    """Common extensions inside texts laid end to end: ``words`` are numbers, ``off`` the n+1 offsets of the texts."""

    def __init__(self, words: np.ndarray, off: np.ndarray):
        self.words = words
        n = len(words)
        sample = np.flatnonzero(IN_COVER[np.arange(n) % MODULUS])
        self.number = np.full(n, -1, np.int32)
        self.number[sample] = np.arange(len(sample), dtype=np.int32)
        text = np.searchsorted(off, sample, side="right") - 1
        end = off[text + 1]
        order, head = np.arange(len(sample)), np.searchsorted(text, text).astype(np.int64)
        tied = self.tied_slots(head)
        for t in range(MODULUS):
            if not len(tied):
                break
            at = sample[order[tied]] + t
            inside = at < end[order[tied]]
            tied = self.split(order, head, tied, np.where(inside, words[np.where(inside, at, 0)].astype(np.int64), -1))
        levels, span = [self.rank_of(order, head)], MODULUS
        while len(tied):
            at = sample[order[tied]] + span
            inside = at < end[order[tied]]
            ahead = levels[-1][self.number[np.where(inside, at, sample[0])]]
            tied = self.split(order, head, tied, np.where(inside, ahead, -1))
            levels.append(self.rank_of(order, head))
            span *= 2
        self.rank = np.empty(len(sample), np.int64)
        self.rank[order] = np.arange(len(sample))
        # common prefixes of neighbours in sorted order, by the levels from the longest
        a, b = order[1:], order[:-1]
        near = np.flatnonzero(text[a] == text[b])
        x, y, room = sample[a[near]], sample[b[near]], np.minimum(end[a[near]] - sample[a[near]], end[b[near]] - sample[b[near]])
        common = np.zeros(len(near), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            size = MODULUS << k
            live = np.flatnonzero(common + size <= room)
            i, j = self.number[x[live] + common[live]], self.number[y[live] + common[live]]
            common[live[levels[k][i] == levels[k][j]]] += size
        common += self.direct(x + common, y + common, np.minimum(MODULUS, room - common))
        least = np.zeros(len(sample), np.int32)         # of every suffix and the one before it
        least[near + 1] = common
        self.table = [least]
        while 2 << (len(self.table) - 1) <= len(least):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def tied_slots(head: np.ndarray) -> np.ndarray:
        same = head[1:] == head[:-1]
        return np.flatnonzero(np.r_[same, False] | np.r_[False, same]) if len(head) else np.zeros(0, np.int64)

    @staticmethod
    def rank_of(order: np.ndarray, head: np.ndarray) -> np.ndarray:
        out = np.empty(len(order), np.int64)
        out[order] = head
        return out

    @staticmethod
    def split(order: np.ndarray, head: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Sort the tied slots of every group by the key; the slots still tied."""
        by = np.lexsort((key, head[tied]))
        order[tied] = order[tied][by]
        key, group = key[by], head[tied]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        first = np.flatnonzero(new)
        head[tied] = tied[first][np.cumsum(new) - 1]
        alone = new & np.r_[new[1:], True]
        return tied[~alone]

    def direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most``, compared one by one."""
        n = np.zeros(len(i), np.int64)
        live, t = np.flatnonzero(most > 0), 0
        while len(live):
            live = live[self.words[i[live] + t] == self.words[j[live] + t]]
            t += 1
            n[live] = t
            live = live[most[live] > t]
        return n

    def common(self, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Longest common extension of positions i < j of one text; ``room``: words from j to its text's end."""
        to_sample = (MEMBER[(j - i) % MODULUS] - i) % MODULUS
        n = self.direct(i, j, np.minimum(to_sample, room))
        on = np.flatnonzero((n == to_sample) & (to_sample < room))
        if len(on):
            x, y = (self.rank[self.number[p[on] + n[on]]] for p in (i, j))
            lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
            k = np.frexp((hi - lo).astype(np.float64))[1] - 1
            least = np.empty(len(on), np.int64)
            for level in np.unique(k):
                m = np.flatnonzero(k == level)
                row = self.table[level]
                least[m] = np.minimum(row[lo[m]], row[hi[m] - (1 << int(level))])
            n[on] += least
        return n


def runs_of_words(words: np.ndarray, off: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text and start; starts count from the text's first word."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(off)
    periods = np.maximum(sizes // MIN_PERIODS, 0)
    if not periods.sum():
        return none, none, none, none
    ahead, behind = Extensions(words, off), Extensions(words[::-1], len(words) - off[::-1])
    text = np.repeat(np.arange(len(sizes)), periods)
    q = spans(np.ones(len(sizes), np.int64), periods)
    points = -(-(sizes[text] - q) // (GRID * q))
    upto = np.concatenate([[0], np.cumsum(points)])
    found = []
    a = 0
    while a < len(q):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + CHUNK, side="right")) - 1)
        which = np.repeat(np.arange(a, b), points[a:b])
        t, p = text[which], q[which]
        i = off[t] + spans(np.zeros(b - a, np.int64), points[a:b]) * GRID * p
        live = np.flatnonzero(words[i] == words[i + p])
        i, t, p = i[live], t[live], p[live]
        forward = ahead.common(i, i + p, off[t + 1] - i - p)
        # backwards a run can add at most what lies before the position
        live = np.flatnonzero(forward + i - off[t] + p >= np.maximum(min_length, MIN_PERIODS * p))
        i, t, p, forward = i[live], t[live], p[live], forward[live]
        back = behind.common(len(words) - i - p, len(words) - i, i - off[t])
        size = back + forward + p
        live = size >= np.maximum(min_length, MIN_PERIODS * p)
        found.append(np.stack([t, i - back - off[t], size, p])[:, live])
        a = b
    t, start, size, p = np.concatenate(found, axis=1)
    by = np.lexsort((p, size, start, t))
    t, start, size, p = t[by], start[by], size[by], p[by]
    new = np.r_[True, (t[1:] != t[:-1]) | (start[1:] != start[:-1]) | (size[1:] != size[:-1])] if len(t) else np.zeros(0, bool)
    # of one start the runs come by period
    t, start, size, p = t[new], start[new], size[new], p[new]
    by = np.lexsort((p, start, t))
    return t[by], start[by], size[by], p[by]


def numbered_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words (equal words, equal numbers), word offsets by text, and the words' byte bounds."""
    starts, ends, at = word_bounds(data, off)
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    body = pa.py_buffer(np.ascontiguousarray(data[~IS_SPACE[data]]))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)), body])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False), at, starts, ends


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray, at: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by single spaces."""
    stay = np.flatnonzero(keep)
    size = ends[stay] - starts[stay] + 1
    body = np.concatenate([data, np.zeros(1, np.uint8)])[spans(starts[stay], size)]
    edge = np.cumsum(size)
    body[edge - 1] = 0x20
    count = np.concatenate([[0], np.cumsum(keep)])[at]
    cut = np.concatenate([[0], edge])[count]
    some = np.diff(count) > 0
    whole = np.ones(len(body), bool)
    whole[cut[1:][some] - 1] = False                    # the space after a text's last word
    cut -= np.concatenate([[0], np.cumsum(some)])
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(body[whole]))


RUN = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text: str = "text",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, runs (by start, then period), collapsed (the words without what a run holds after its
    first period, joined by single spaces), then ``carry``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text).alias("__text"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    result = T.StructType([source.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)),
                           T.StructField("collapsed", T.StringType()), *[source.schema[c] for c in carry]])
    target = to_arrow_schema(result)

    def find(batches):
        new_stage()
        for b in batches:
            data, off = utf8_buffer(b.column(b.num_columns - 1))
            for i, j in pieces(data, off):
                part, sizes = data[off[i]:off[j]], off[i:j + 1] - off[i]
                words, at, starts, ends = numbered_words(part, sizes)
                t, start, size, period = runs_of_words(words, at, min_length)
                delta = np.zeros(len(words) + 1, np.int64)
                np.add.at(delta, at[t] + start + period, 1)
                np.add.at(delta, at[t] + start + size, -1)
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(t, np.arange(j - i + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(start), pa.array(size), pa.array(period)], names=["start", "length", "period"]))
                columns = [b.column(0).slice(i, j - i), pa.array(np.diff(at)), runs, join_words(part, starts, ends, np.cumsum(delta[:-1]) == 0, at),
                           *[b.column(k).slice(i, j - i) for k in range(1, b.num_columns - 1)]]
                yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return source.mapInArrow(find, result)
