"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens (its documents end to end, each closed by an end id). A window of
``length`` tokens adds to each source a quantum of length * share to its deficit and is filled by
serving the sources, whole tokens at a time, by the greatest claim; what a source is owed or has
overdrawn is carried into the next window. Served that way, the t-th of a source's n tokens comes at
the virtual time (t + 1/2) / n, and the order of service is the order of virtual times (ties: by
source). The state of every queue at the start of any window, deficits included, therefore follows from
the sources' totals alone, in exact integers: each partition computes the deficits it starts with
instead of waiting for the partitions before, and every window holds every source's share to within
about one token. Only the last window can be short.

With ``targets``, quanta are the given shares; when a source runs dry the others share its quantum
by weight. This splits the service into rounds, in each of which the totals are what each source
gives; without targets the shares are the sources' own and all queues end together.

Documents are tokenized once, in blocks of about 2 MB that are written as rows of packed ids. A
block's place in its sources' queues is the sum of the blocks before, kept per (source, block); it
joins the blocks by broadcast only if Spark measures it small. A source that holds a third of all
tokens is as spread as any other: nothing is grouped by source but block totals. The driver holds one
total per source.

Words between ASCII white space are tokenized on their own, without a closing mark behind them, and remembered
in the Python worker in a flat table of about 40 bytes a word, found by hash and compared by their bytes. At
``WORD_CACHE`` words a table becomes the old one, from which words still in use move on. That is exact for
tokenizers that drop white space.

Defined results: a null or empty text is its end id alone; repeated rows are packed each; a null source
is a source of its own; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anchors import spans, word_values
from .common import IS_SPACE, materialise, new_stage, pieces, ready, remembered, utf8_buffer, word_bounds

#: Most words of a table; a Python worker holds the one it fills and the one before.
WORD_CACHE = 1_000_000
BLOCK_BYTES = 1 << 21
CLOSING = b",.;:!?"
IS_CLOSING = np.isin(np.arange(256), list(CLOSING))
IS_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words that are tokenized as one text.
TOGETHER = 50


class Growing:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.held, self.n = np.zeros(1024, dtype), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            wide = np.zeros((self.n + len(more)) * 5 // 4, self.held.dtype)
            wide[:self.n] = self.held[:self.n]
            self.held = wide
        self.held[self.n:self.n + len(more)] = more
        self.n += len(more)


class WordTable:
    """Ids of words. A word is found by its hash among the sorted ones and compared by its bytes; of two words of one hash
    only the first is held."""

    def __init__(self, narrow: bool = False):
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.bytes, self.ids = Growing(np.uint8), Growing(np.uint16 if narrow else np.uint32)
        # a table holds some millions of words and ids at most
        self.upto, self.ids_upto = Growing(np.int32), Growing(np.int32)
        self.upto.add(np.zeros(1, np.int32))
        self.ids_upto.add(np.zeros(1, np.int32))

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray, body: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of the words, -1 where unknown."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        e = self.entry[at[hit]].astype(np.int64)
        held = self.upto.held[e].astype(np.int64)
        same = self.upto.held[e + 1] - held == size[hit]
        hit, e, held = hit[same], e[same], held[same]
        if len(hit):
            n = size[hit]
            differ = self.bytes.held[spans(held, n)] != body[spans(begin[hit], n)]
            edge = np.cumsum(n) - n
            same = ~np.logical_or.reduceat(differ, edge)
            out[hit[same]] = e[same]
        return out

    def of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries one after the other, and the number of each."""
        first = self.ids_upto.held[entry].astype(np.int64)
        n = self.ids_upto.held[entry + 1] - first
        return self.ids.held[spans(first, n)].astype(np.uint32), n

    def add(self, keys: np.ndarray, body: np.ndarray, begin: np.ndarray, size: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        keys, new = np.unique(keys, return_index=True)
        place = np.searchsorted(self.keys, keys)
        if len(self.keys):
            free = self.keys[np.minimum(place, len(self.keys) - 1)] != keys
            keys, new, place = keys[free], new[free], place[free]
        entry = len(self) + np.arange(len(new))
        self.keys, self.entry = np.insert(self.keys, place, keys), np.insert(self.entry, place, entry.astype(np.int32))
        first = np.cumsum(n) - n
        self.bytes.add(body[spans(begin[new], size[new])])
        self.ids.add(ids[spans(first[new], n[new])])
        self.upto.add(self.upto.held[self.upto.n - 1] + np.cumsum(size[new]))
        self.ids_upto.add(self.ids_upto.held[self.ids_upto.n - 1] + np.cumsum(n[new]))


class WordTokenizer:
    """Ids of texts by a tokenizers file that splits at white space and drops it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        probe = "Ab  cd's\t<x>\n12 é f"
        whole = self.model.encode(probe, add_special_tokens=False).ids
        if whole != [i for w in probe.encode().split() for i in self.model.encode(w.decode(), add_special_tokens=False).ids]:
            raise ValueError("the tokenizer keeps white space: words cannot be encoded one by one")
        # an ASCII word may be looked up in lower case if the tokenizer lower-cases anyway
        self.lower = whole == self.model.encode(probe.lower(), add_special_tokens=False).ids
        pieces_ = self.model.get_vocab(with_added_tokens=False)
        closing = [i for x, i in pieces_.items() if x.endswith("</w>")]
        self.closes = np.zeros(max(self.model.get_vocab().values()) + 1, bool) if closing else None
        if closing:
            self.closes[closing] = True
        self.marks, self.mark_sizes = self.ids_of([chr(c) for c in CLOSING])
        self.narrow = max(self.model.get_vocab().values()) < 1 << 16
        self.table, self.old = WordTable(self.narrow), WordTable(self.narrow)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and the number of each."""
        ids = [e.ids for e in self.model.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], np.int64)

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters: each is one piece of the tokenizer, so in a text of many of them the ids that close
        a piece tell where a word ends. Where they are not as many as the words, the tokenizer sees other letters."""
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        out, sizes = [], []
        for g, e in zip(groups, self.model.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            n = np.diff(ends, prepend=0)
            if len(ends) != len(g):
                ids, n = self.ids_of(g)
            out.append(ids)
            sizes.append(n)
        return np.concatenate(out), np.concatenate(sizes)

    def tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        alpha = np.array([self.closes is not None and w.isalpha() for w in words], bool)
        n, parts = np.zeros(len(words), np.int64), []
        for mine, find in ((np.flatnonzero(alpha), self.letters), (np.flatnonzero(~alpha), self.ids_of)):
            if len(mine):
                ids, n[mine] = find([words[i] for i in mine.tolist()])
                parts.append((mine, ids))
        out, first = np.empty(int(n.sum()), np.uint32), np.cumsum(n) - n
        for mine, ids in parts:
            out[spans(first[mine], n[mine])] = ids
        return out, n

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and the number of each; what is unknown is tokenized and remembered."""
        body, off = utf8_buffer(words)
        begin, size = off[:-1], np.diff(off)
        keys = word_values(body, begin, off[1:])
        if len(self.table) > WORD_CACHE:
            self.table, self.old = WordTable(self.narrow), self.table
        now = self.table.find(keys, body, begin, size)
        n, parts = np.zeros(len(keys), np.int64), []

        def take(mine, ids, sizes):
            n[mine] = sizes
            parts.append((mine, ids))

        known, rest = np.flatnonzero(now >= 0), np.flatnonzero(now < 0)
        take(known, *self.table.of(now[known]))
        before = self.old.find(keys[rest], body, begin[rest], size[rest])
        older, new = rest[before >= 0], rest[before < 0]
        for mine, (ids, sizes) in ((older, self.old.of(before[before >= 0])), (new, self.tokenized(words.take(pa.array(new)).to_pylist()))):
            take(mine, ids, sizes)
            self.table.add(keys[mine], body, begin[mine], size[mine], ids, sizes)
        out, first = np.empty(int(n.sum()), np.uint32), np.cumsum(n) - n
        for mine, ids in parts:
            out[spans(first[mine], n[mine])] = ids
        return out, n

    def encode(self, data: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end``, and the n+1 offsets. ASCII letters are lowered first where that cannot
        change the ids: none of them composes with a mark outside U+0300..U+033F, whose UTF-8 starts with 0xCC, and ``<``
        may open a special token. One closing mark behind an ASCII letter or digit is a piece of its own: such a word is
        its stem's ids and the mark's."""
        if self.lower:
            odd = np.concatenate([[0], np.cumsum((data == 0x3C) | (data == 0xCC))])
            data = np.where(np.repeat(odd[off[1:]] == odd[off[:-1]], np.diff(off)), LOWER[data], data)
        starts, ends, at = word_bounds(data, off)
        coded = binary_words(data[~IS_SPACE[data]], ends - starts).dictionary_encode()
        body, edge = utf8_buffer(coded.dictionary)
        size = np.diff(edge)
        last = body[edge[1:] - 1]
        marked = (size > 1) & IS_CLOSING[last] & IS_ALNUM[body[np.maximum(edge[1:] - 2, 0)]]
        keep = np.ones(len(body), bool)
        keep[edge[1:][marked] - 1] = False
        stems = binary_words(body[keep], size - marked).dictionary_encode()
        ids, n = self.look_up(stems.dictionary.cast(pa.string()))
        # every distinct word: its stem's ids, then its mark's
        stem = stems.indices.to_numpy(zero_copy_only=False)
        mark = np.argmax(last[:, None] == np.frombuffer(CLOSING, np.uint8), axis=1)
        pool = np.concatenate([ids, self.marks])
        stem_at, mark_at = np.cumsum(n) - n, len(ids) + np.cumsum(self.mark_sizes) - self.mark_sizes
        two = np.stack([n[stem], np.where(marked, self.mark_sizes[mark], 0)], axis=1)
        flat = pool[spans(np.stack([stem_at[stem], mark_at[mark]], axis=1).ravel(), two.ravel())]
        sizes = two.sum(1)
        begin = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy(zero_copy_only=False)
        size = sizes[word]
        upto = np.concatenate([[0], np.cumsum(size)])[at]
        ends = upto + np.arange(len(off))
        out = np.full(int(ends[-1]), end, np.uint32)
        inside = np.ones(len(out), bool)
        inside[ends[1:] - 1] = False
        out[inside] = flat[spans(begin[word], size)]
        return out, ends


def binary_words(body: np.ndarray, size: np.ndarray) -> pa.Array:
    """Words laid end to end, of the sizes given."""
    edge = pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, edge, pa.py_buffer(np.ascontiguousarray(body))])


def tokenizer(path: str) -> WordTokenizer:
    return remembered(("word tokenizer", path), lambda: WordTokenizer(path))


class Service:
    """The order in which the tokens of all queues are served, from the sources' totals."""

    def __init__(self, totals: list[int], weights: list[float] | None = None):
        self.total = np.array(totals, np.int64)
        self.n = int(self.total.sum())
        dry = self.total / np.array(weights) if weights else np.ones(len(totals))
        # tokens that every source has given when the k-th round ends
        given = [np.zeros(len(totals), np.int64)]
        for x in sorted(set(dry.tolist())):
            upto = np.where(dry <= x, self.total, np.floor(x * np.array(weights)).astype(np.int64) if weights else self.total)
            given.append(np.minimum(self.total, np.maximum(given[-1], upto)))
        self.given = np.array(given)
        self.before = self.given.sum(1)         # tokens served before each round

    @staticmethod
    def quotient(a: np.ndarray, b: np.ndarray, minus: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """floor((a * b - minus) / d) and the remainder, exact beyond 64 bits: the quotient comes from doubles and is off by
        little, and the remainder is exact modulo 2^64."""
        q = np.floor((a.astype(np.float64) * b.astype(np.float64) - minus) / d).astype(np.int64)
        with np.errstate(over="ignore"):
            r = a * b - minus - q * d
        fix = np.floor_divide(r, d)
        return q + fix, r - fix * d

    def rank(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Tokens served before the t-th token of source s."""
        k = np.zeros(len(t), np.int64)
        for i in range(1, len(self.given) - 1):
            k += t >= self.given[i][s]
        own = t - self.given[k, s]
        n = self.given[k + 1] - self.given[k]           # (tokens, sources) of the round
        mine = n[np.arange(len(t)), s][:, None]
        q, r = self.quotient((2 * own + 1)[:, None], n, mine, 2 * mine)
        other = np.arange(len(self.total))[None, :]
        count = np.where(other < s[:, None], q + 1, q + (r > 0))
        count = np.where(other == s[:, None], own[:, None], count)
        return self.before[k] + np.clip(count, 0, n).sum(1)

    def served(self, upto: np.ndarray) -> np.ndarray:
        """Tokens of every source among the first ``upto`` served: (places, sources).

        By the time upto / size a source has given its tokens up to that time; their sum misses ``upto`` by at most half
        the number of sources, and so many tokens next to that time, the first or last in order, are added or taken."""
        upto = np.minimum(upto, self.n)
        k = np.clip(np.searchsorted(self.before, upto, side="right") - 1, 0, len(self.before) - 2)
        n, size = self.given[k + 1] - self.given[k], (self.before[k + 1] - self.before[k])[:, None]
        whole, u = np.maximum(size, 1), (upto - self.before[k])[:, None]
        c = np.clip(self.quotient(2 * u, n, -whole, 2 * whole)[0], 0, n)
        over = c.sum(1) - u[:, 0]
        while True:
            rows = np.flatnonzero(over)
            if not len(rows):
                return self.given[k] + c
            sign = np.sign(over[rows])[:, None]             # 1: the last token goes, -1: the next one comes
            t, m = c[rows] - (sign > 0), n[rows]
            with np.errstate(over="ignore"):                # a small number, so exact modulo 2^64
                late = ((2 * t + 1) * whole[rows] - 2 * u[rows] * m) * sign
            col = self.latest(late, np.where((t >= 0) & (t < m), m, 0), sign[:, 0])
            c[rows, col] -= sign[:, 0]
            over[rows] -= sign[:, 0]

    @staticmethod
    def latest(late: np.ndarray, n: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The column of the greatest late / n (n = 0: none) in every row; of equal ones the last, or the first where the sign is
        negative. Doubles decide unless they are close and the numbers are not the same; then whole numbers do."""
        with np.errstate(divide="ignore", invalid="ignore"):
            key = np.where(n > 0, late / n, -np.inf)
        last = n.shape[1] - 1
        best = np.where(sign > 0, last - np.argmax(key[:, ::-1], axis=1), np.argmax(key, axis=1))
        rows = np.arange(len(best))
        top = key[rows, best][:, None]
        near = (key >= top - 1e-9 * (1 + np.abs(top))) & ((late != late[rows, best][:, None]) | (n != n[rows, best][:, None]))
        for r in np.flatnonzero(near.any(1)).tolist():
            exact = [(Fraction(int(x), int(m)), i * int(sign[r])) for i, (x, m) in enumerate(zip(late[r], n[r], strict=True)) if m]
            best[r] = abs(max(exact)[1])
        return best


def cut(service: Service, s: np.ndarray, first: np.ndarray, n: np.ndarray, length: int):
    """Pieces of documents that are tokens first..first+n of queue s: (document, start, length, window, offset)."""
    j0, j1 = service.rank(s, first) // length, service.rank(s, first + n - 1) // length
    doc = np.repeat(np.arange(len(s)), j1 - j0 + 1)
    j = spans(j0, j1 - j0 + 1)
    need, at = np.unique(np.concatenate([j, j + 1]), return_inverse=True)
    served = service.served(need * length)
    lo, hi = served[at[:len(j)]], served[at[len(j):]]
    rows = np.arange(len(j))
    a, b = np.maximum(lo[rows, s[doc]], first[doc]), np.minimum(hi[rows, s[doc]], first[doc] + n[doc])
    share = hi - lo
    base = np.cumsum(share, axis=1)[rows, s[doc]] - share[rows, s[doc]]
    ok = a < b
    offset = base + a - lo[rows, s[doc]]
    return doc[ok], (a - first[doc])[ok], (b - a)[ok], j[ok], offset[ok]


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, "
          "ids array<int>")


def pack(docs: DataFrame, tokenizer_path: str, end: int = 2, length: int = 4096, targets: dict[str, float] | None = None,
         id_col: str = "doc_id", source: str = "source", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids."""
    spark = docs.sparkSession
    ready(spark)
    key = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))

    def tokenize(batches):
        t = tokenizer(tokenizer_path)
        for b in batches:
            data, off = utf8_buffer(b.column(2))
            ids = b.column(0)
            for i, j in pieces(data, off, BLOCK_BYTES):
                body, at = t.encode(data[off[i]:off[j]], off[i:j + 1] - off[i], end)
                names = b.column(1).slice(i, j - i).to_pylist()
                known = sorted(set(names))
                number = {x: k for k, x in enumerate(known)}
                s = np.array([number[x] for x in names], np.int32)
                sizes = np.diff(at)
                mine = ids.slice(i, j - i)
                yield pa.RecordBatch.from_pylist([{
                    "names": known, "totals": np.bincount(s, weights=sizes, minlength=len(known)).astype(np.int64).tolist(),
                    "sources": s.tobytes(), "doc_ids": mine.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                    "nulls": np.array(mine.is_null(), bool).tobytes(), "sizes": sizes.tobytes(),
                    "ids": (body.astype(np.uint16) if body.max() < 65536 else body).tobytes()}], schema=packed)

    packed = pa.schema([("names", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())), ("sources", pa.binary()), ("doc_ids", pa.binary()),
                        ("nulls", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("source"), F.col(text).alias("text"))
    blocks = materialise(rows.mapInArrow(
        tokenize, "names array<string>, totals array<long>, sources binary, doc_ids binary, nulls binary, sizes binary, ids binary")
        .withColumn("block", F.monotonically_increasing_id()), "packing-blocks")      # fixed once it is written

    shares = blocks.select("block", F.explode(F.arrays_zip("names", "totals")).alias("x")) \
                   .select("block", F.col("x.names").alias("name"), F.col("x.totals").alias("total"))
    totals = {r["name"]: r["total"] for r in shares.groupBy("name").agg(F.sum("total").alias("total")).collect()}
    names = sorted(totals)
    weights = [float(targets[x[1:] if x[0] == "s" else None]) for x in names] if targets else None
    service = Service([totals[x] for x in names], weights) if names else None
    number = {x: i for i, x in enumerate(names)}

    # the tokens of a source before a block: slices of blocks, then blocks in a slice
    sliced = shares.withColumn("slice", F.shiftright("block", 33))      # the task that wrote it
    slices = sliced.groupBy("name", "slice").agg(F.sum("total").alias("total"))
    earlier = lambda *k: Window.partitionBy(*k).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("name", "slice", F.coalesce(F.sum("total").over(earlier("name").orderBy("slice")), F.lit(0)).alias("skip"))
    inside = F.coalesce(F.sum("total").over(earlier("name", "slice").orderBy("block")), F.lit(0))
    starts = sliced.withColumn("inside", inside).join(slices, ["name", "slice"]) \
        .groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("name", F.col("inside") + F.col("skip")))).alias("starts"))
    placed = blocks.join(starts, "block").select("names", "starts", "sources", "doc_ids", "nulls", "sizes", "ids")

    def deal(batches):
        new_stage()
        for b in batches:
            for r in b.to_pylist():
                begin = dict(r["starts"])
                local, sizes = np.frombuffer(r["sources"], np.int32), np.frombuffer(r["sizes"], np.int64)
                s = np.array([number[x] for x in r["names"]], np.int64)[local]
                first = np.empty(len(s), np.int64)
                for k, x in enumerate(r["names"]):
                    mine = np.flatnonzero(local == k)
                    first[mine] = begin[x] + np.cumsum(sizes[mine]) - sizes[mine]
                doc, start, size, window, offset = cut(service, s, first, sizes, length)
                at = np.cumsum(sizes) - sizes
                wide = len(r["ids"]) != 2 * int(sizes.sum())
                ids = np.frombuffer(r["ids"], np.uint32 if wide else np.uint16).astype("<u4")
                raw = memoryview(ids).cast("B")
                a = (at[doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * x:4 * (x + n)]) for x, n in zip(a, size.tolist(), strict=True)]
                null = np.frombuffer(r["nulls"], bool)[doc]
                cols = [pa.array(np.frombuffer(r["doc_ids"], np.int64)[doc], mask=null), pa.array(start), pa.array(size),
                        pa.array(crc, pa.int64()), pa.array(sizes[doc]), pa.array(window), pa.array(offset),
                        pa.array([r["names"][k][1:] if r["names"][k][0] == "s" else None for k in local[doc].tolist()], pa.string())]
                if with_ids:
                    flat = ids[spans(at[doc] + start, size)].astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=columns)

    schema = PIECES if with_ids else PIECES.rpartition(",")[0]
    columns = [x.split()[0] for x in schema.split(", ")]
    return placed.mapInArrow(deal, schema)
