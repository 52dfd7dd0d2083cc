"""Benchmark decontamination by an FM-index for every training shard.

The words of a text (lower-cased A-Z; runs of digits, letters and whatever is not ASCII) that lie inside an occurrence of
a test phrase are hit. Phrases are the windows of ten words of the test items, and items of fewer words as they are.

1. ``index_shards`` cuts the documents, where they lie, into shards of about 4 MB of whole texts and writes an
   FM-index for each: the words' dictionary, the Burrows-Wheeler transform of the shard's distinct texts as a wavelet
   matrix with bit-packed levels, and every eighth suffix position. Suffixes are sorted fully, by as many words at once as
   64 bits hold and then by doubling, tied ones only. A text of more than a million words is indexed in parts that overlap
   by a window less one word. The table serves any number of test sets.
2. ``search`` takes the phrases in blocks of bounded size, each sent to the executors in turn. In every shard all
   phrases of a block are searched at once, backwards: a step narrows the intervals of those still alive by two
   wavelet-tree ranks; phrases with a word that the shard does not hold end before. The rows of the intervals left walk
   back to the next sampled suffix, which gives their places. Occurrences are merged into spans per text.
3. The spans and items of a shard are put together over the blocks, and every document of the shard takes its text's.

No document is shuffled; what moves is the phrases and what was found. A phrase that occurs everywhere costs its
occurrences. Equal texts of a shard are indexed once. Words are compared exactly.

Defined results: a null or empty text (or item) has no words; rows are judged each, also those of one id; a null
item id is the empty string in lists of items, and rows of one item id are one item; an empty table of documents gives no
rows, an empty test set hits nothing.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import spans
from .common import materialise, new_stage, pieces, ready, utf8_buffer, word_bounds

WINDOW = 10
SHARD_BYTES = 4 << 20
#: Most words of one index.
MOST_WORDS = 1 << 20
#: Every so manieth suffix position is kept.
RATE = 8
#: Most (item, phrase) pairs and bytes of phrases that are sent at once, on average of a hash.
BLOCK_PHRASES, BLOCK_BYTES = 100_000, 16 << 20
#: Occurrences located at once.
CHUNK = 1 << 18

U = np.uint64
#: What every byte counts as: letters lowered, anything that is no part of a word a space.
FOLDED = np.full(256, 0x20, np.uint8)
for _a, _b, _to in ((0x30, 0x3A, 0x30), (0x41, 0x5B, 0x61), (0x61, 0x7B, 0x61), (0x80, 0x100, 0x80)):
    FOLDED[_a:_b] = np.arange(_to, _to + _b - _a)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# ------------------------------------------------------------------------------------------------
# FM-index
# ------------------------------------------------------------------------------------------------
def sorted_suffixes(text: np.ndarray, n_texts: int) -> np.ndarray:
    """Suffixes in order, of texts that each end with symbol 0; these ends are told apart by their place."""
    n = len(text)
    value = text.astype(np.int64) + n_texts
    ends = np.flatnonzero(text == 0)
    value[ends] = np.arange(n_texts)
    bits = int(value.max()).bit_length()
    span = max(1, min(62 // bits, n))
    key = np.zeros(n, np.int64)
    for t in range(span):
        key <<= bits
        key[:n - t] |= value[t:]
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
    rank = np.empty(n, np.int64)
    rank[order] = head
    while len(tied):
        suffix = order[tied]
        key = head[tied] * n + rank[suffix + span]      # tied ones agree in `span` words, so both go on
        by = np.argsort(key)
        order[tied], key = suffix[by], key[by]
        new = np.r_[True, key[1:] != key[:-1]]
        head[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        rank[order[tied]] = head[tied]
        tied = tied[~(new & np.r_[new[1:], True])]
        span *= 2
    return order


class Bits:
    """Rank over packed bits."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    @staticmethod
    def pack(bit: np.ndarray) -> np.ndarray:
        return np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, bool)]), bitorder="little").view(U)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(U)) & U(1) == U(1)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before the positions."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((U(1) << (i & 63).astype(U)) - U(1)))


@dataclass
class FMIndex:
    counts: np.ndarray          # of every symbol
    levels: np.ndarray          # packed bits of the wavelet matrix, the highest bit first
    marks: np.ndarray           # packed: the rows whose suffix position is kept
    places: np.ndarray          # those positions, by row
    begin: np.ndarray           # where every text starts, and the end of the last
    text: np.ndarray            # number of every text
    first: np.ndarray           # its first word's number in the document's text
    words: bytes                # dictionary: symbol k+1 is the k-th, closed by line feeds

    @classmethod
    def build(cls, texts: list[np.ndarray], number: np.ndarray, first: np.ndarray, words: pa.Array) -> FMIndex:
        """Texts are arrays of symbols from 1."""
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        text = np.zeros(int(begin[-1]), np.int64)
        text[spans(begin[:-1], size)] = np.concatenate(texts)
        order = sorted_suffixes(text, len(texts))
        start = np.zeros(len(text), bool)
        start[begin[:-1]] = True
        kept = start[order] | (order % RATE == 0)
        seq, levels = text[order - 1].astype(np.uint16 if len(words) < 1 << 16 else np.uint32), []
        for b in range(max(1, len(words).bit_length()) - 1, -1, -1):
            bit = ((seq >> b) & 1).astype(bool)
            levels.append(Bits.pack(bit))
            seq = np.concatenate([seq[~bit], seq[bit]])
        body = pc.binary_join(pa.array([words.to_pylist()], pa.list_(pa.binary())), b"\n")[0].as_py() if len(words) else b""
        return cls(np.bincount(text, minlength=len(words) + 1).astype(np.uint32), np.stack(levels), Bits.pack(kept), order[kept].astype(np.int32), begin, number, first, body)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: np.frombuffer(v, np.uint8) if k == "words" else v for k, v in vars(self).items()})
        return out.getvalue()

    @classmethod
    def load(cls, body: bytes) -> FMIndex:
        with np.load(io.BytesIO(body), allow_pickle=False) as x:
            return cls(**{k: x[k].tobytes() if k == "words" else x[k] for k in x.files})

    def dictionary(self) -> pa.Array:
        return pa.array(self.words.split(b"\n") if self.words else [], pa.binary())

    def open(self) -> FMIndex:
        """Ready to search: ranks, and where every symbol's rows begin in order and in the lowest level."""
        self.counts = self.counts.astype(np.int64)
        self.n, depth = int(self.counts.sum()), len(self.levels)
        self.bits, self.mark = [Bits(x) for x in self.levels], Bits(self.marks)
        self.zeros = [self.n - int(np.bitwise_count(x).sum()) for x in self.levels]
        self.head = np.cumsum(self.counts) - self.counts
        turned, symbol = np.zeros(len(self.counts), np.int64), np.arange(len(self.counts))
        for b in range(depth):
            turned = turned << 1 | (symbol >> b) & 1
        by = np.argsort(turned)
        self.shift = np.empty(len(by), np.int64)
        self.shift[by] = np.cumsum(self.counts[by]) - self.counts[by]
        self.shift = self.head - self.shift
        return self

    def back(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the rows before i lead with the symbol before them."""
        for b, bits, zeros in zip(range(len(self.levels) - 1, -1, -1), self.bits, self.zeros, strict=True):
            ones = bits.ones(i)
            i = np.where((symbol >> b) & 1, zeros + ones, i - ones)
        return i + self.shift[symbol]

    def previous(self, i: np.ndarray) -> np.ndarray:
        """The rows of the suffixes one word longer."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.bits, self.zeros, strict=True):
            bit, ones = bits.get(i), bits.ones(i)
            i = np.where(bit, zeros + ones, i - ones)
            symbol = symbol << 1 | bit
        return i + self.shift[symbol]

    def search(self, phrases: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (rows of symbols, the last word last, ended at the right) to (phrase, first row, last row + 1) where any."""
        at = np.arange(len(phrases))
        c = phrases[:, -1]
        lo, hi = self.head[c], self.head[c] + self.counts[c]
        for t in range(1, phrases.shape[1]):
            live = np.flatnonzero((lo < hi) & (size[at] > t))
            done = np.flatnonzero((lo < hi) & (size[at] <= t))
            if not len(live):
                break
            c = phrases[at[live], -1 - t]
            lo = np.concatenate([lo[done], self.back(c, lo[live])])
            hi = np.concatenate([hi[done], self.back(c, hi[live])])
            at = np.concatenate([at[done], at[live]])
        some = lo < hi
        return at[some], lo[some], hi[some]

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at the rows."""
        out, live, steps = np.empty(len(row), np.int64), np.arange(len(row)), 0
        while len(live):
            known = self.mark.get(row)
            out[live[known]] = self.places[self.mark.ones(row[known])] + steps
            live, row = live[~known], self.previous(row[~known])
            steps += 1
        return out


# ------------------------------------------------------------------------------------------------
# training shards
# ------------------------------------------------------------------------------------------------
def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of all words, their dictionary, and word offsets by text."""
    data = FOLDED[data]
    starts, ends, at = word_bounds(data, off)
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    body = pa.py_buffer(np.ascontiguousarray(data[data != 0x20]))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)), body]).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary.cast(pa.binary()), at


def indexes_of(data: np.ndarray, off: np.ndarray, window: int) -> tuple[list[bytes], np.ndarray]:
    """The indexes of a shard's distinct texts, and the number of words of each."""
    words, names, at = words_of(data, off)
    n = np.diff(at)
    parts = [(t, a) for t in range(len(n)) for a in range(0, max(int(n[t]) - window + 1, 1), MOST_WORDS) if n[t]]
    out, held, size = [], [], 0
    for k, (t, a) in enumerate(parts):
        held.append((t, a, words[at[t] + a:min(at[t] + a + MOST_WORDS + window - 1, at[t + 1])]))
        size += len(held[-1][2])
        if size >= MOST_WORDS or k == len(parts) - 1:
            known, coded = np.unique(np.concatenate([x for *_, x in held]), return_inverse=True)
            cut = np.cumsum([len(x) for *_, x in held])[:-1]
            out.append(FMIndex.build(np.split(coded + 1, cut), np.array([t for t, *_ in held], np.int64), np.array([a for _, a, _ in held], np.int64),
                                     names.take(pa.array(known))).dump())
            held, size = [], 0
    return out, n


def index_shards(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard: shard, ids of its documents, the number of each document's text, words of every text, indexes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("__text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(source.schema["doc_id"].dataType)), T.StructField("text_of", T.BinaryType()),
                           T.StructField("n_words", T.BinaryType()), T.StructField("indexes", T.ArrayType(T.BinaryType()))])
    target = to_arrow_schema(schema)

    def build(batches):
        new_stage()
        for b in batches:
            _, off = utf8_buffer(b.column(1))
            for i, j in pieces(off, off, SHARD_BYTES):
                coded = pc.fill_null(b.column(1).slice(i, j - i), "").dictionary_encode()
                data, at = utf8_buffer(coded.dictionary)
                indexes, n = indexes_of(data, at, window)
                ids = b.column(0).slice(i, j - i)
                row = [pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), pa.concat_arrays([ids])),
                       pa.array([coded.indices.to_numpy(zero_copy_only=False).astype(np.int32).tobytes()]), pa.array([n.astype(np.int64).tobytes()]),
                       pa.array([indexes], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(row, target, strict=True)], schema=target)

    return materialise(source.mapInArrow(build, schema).withColumn("shard", F.monotonically_increasing_id()), "shard-indexes")


# ------------------------------------------------------------------------------------------------
# test phrases
# ------------------------------------------------------------------------------------------------
def phrases_of(items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, phrase): windows of the items' words, or all the words where there are fewer."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.regexp_extract_all(F.translate(F.col(text), upper, upper.lower()), F.lit(f"({WORD})"))
    cut = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return cut.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at"), window).alias("phrase")).distinct()


@dataclass
class Phrases:
    """A block of distinct phrases: words by number, the last one at the right, and the items of each."""
    words: pa.Array
    codes: np.ndarray           # (phrases, window); -1 before a short one
    size: np.ndarray
    items: pa.Array
    item: np.ndarray            # items of all phrases, by phrase
    upto: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, window: int) -> Phrases:
        phrase = table.column("phrase").combine_chunks()
        words = phrase.flatten().dictionary_encode()
        size = np.diff(phrase.offsets.to_numpy()).astype(np.int64)
        codes = np.full((len(size), window), -1, np.int64)
        codes[np.repeat(np.arange(len(size)), size), window - np.repeat(size, size) + spans(np.zeros(len(size), np.int64), size)] = \
            words.indices.to_numpy(zero_copy_only=False)
        items = table.column("item").combine_chunks().dictionary_encode()
        codes, which = np.unique(codes, axis=0, return_inverse=True)
        which = which.reshape(-1)
        by = np.argsort(which, kind="stable")
        return cls(words.dictionary.cast(pa.binary()), codes, (codes >= 0).sum(1), items.dictionary,
                   items.indices.to_numpy(zero_copy_only=False)[by].astype(np.int64), np.searchsorted(which[by], np.arange(len(codes) + 1)))

    def find(self, index: FMIndex) -> tuple[np.ndarray, np.ndarray]:
        """Spans (text, first word, last word + 1) that the phrases cover, merged, and distinct (text, item)."""
        symbol = pc.fill_null(pc.index_in(self.words, value_set=index.dictionary()), -2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        codes = np.where(self.codes >= 0, symbol[self.codes], 0)
        able = np.flatnonzero((codes >= 0).all(axis=1))
        none = np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
        if not len(able):
            return none
        index.open()
        at, lo, hi = index.search(codes[able], self.size[able])
        if not len(at):
            return none
        at, count = able[at], np.cumsum(hi - lo)
        cover, pairs, a = np.zeros(index.n + 1, np.int64), [], 0
        while a < len(at):
            done = int(count[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(count, done + CHUNK, side="right")))
            for c in range(0, int((hi[a:b] - lo[a:b]).max()), CHUNK) if b == a + 1 else (0,):     # one phrase may have more
                size = np.minimum(hi[a:b] - lo[a:b] - c, CHUNK) if b == a + 1 else hi[a:b] - lo[a:b]
                place = index.locate(spans(lo[a:b] + c, size))
                phrase = np.repeat(at[a:b], size)
                np.add.at(cover, place, 1)
                np.add.at(cover, place + self.size[phrase], -1)
                text = np.searchsorted(index.begin, place, side="right") - 1
                seen = np.unique(text * len(self.codes) + phrase)
                text, phrase = seen // len(self.codes), seen % len(self.codes)
                n = self.upto[phrase + 1] - self.upto[phrase]
                pairs.append(np.unique(np.repeat(index.text[text], n) * len(self.items) + self.item[spans(self.upto[phrase], n)]))
            a = b
        inside = np.cumsum(cover[:-1]) > 0              # no phrase covers the end of a text
        begin, end = np.flatnonzero(inside & ~np.r_[False, inside[:-1]]), np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
        text = np.searchsorted(index.begin, begin, side="right") - 1
        shift = index.first[text] - index.begin[text]
        pairs = np.unique(np.concatenate(pairs))
        return np.stack([index.text[text], begin + shift, end + shift], axis=1), np.stack([pairs // len(self.items), pairs % len(self.items)], axis=1)


FOUND = "shard long, spans binary, texts binary, items array<string>"


def search(shards: DataFrame, phrases: DataFrame, window: int = WINDOW) -> DataFrame:
    """What the phrases (item, phrase) hit in every shard: spans and items by text, block by block of the phrases."""
    spark = shards.sparkSession
    phrases = materialise(phrases.withColumn("h", F.xxhash64("item", "phrase")), "phrases")
    n, size = phrases.agg(F.count(F.lit(1)), F.sum(F.length(F.array_join("phrase", " ")))).first()
    blocks = max(1, -(-n // BLOCK_PHRASES), -(-(size or 0) // BLOCK_BYTES))
    found = []
    for k in range(blocks if n else 0):
        block = spark.sparkContext.broadcast(Phrases.of(phrases.filter(F.pmod("h", F.lit(blocks)) == k).select("item", "phrase").toArrow(), window))

        def run(batches, block=block):
            new_stage()
            p = block.value
            for b in batches:
                for shard, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    got = [p.find(FMIndex.load(x.as_buffer())) for x in body.values] if body.values is not None else []
                    if not sum(len(s) for s, _ in got):
                        continue
                    pairs = np.unique(np.concatenate([x for _, x in got]), axis=0)
                    yield pa.RecordBatch.from_pylist([{
                        "shard": shard, "spans": np.concatenate([s for s, _ in got]).tobytes(), "texts": pairs[:, 0].tobytes(),
                        "items": p.items.take(pa.array(pairs[:, 1])).to_pylist()}], schema=target)

        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(spark.createDataFrame([], FOUND).schema)
        found.append(materialise(shards.select("shard", "indexes").mapInArrow(run, FOUND), "phrases-found"))
        block.unpersist()
    out = spark.createDataFrame([], FOUND)
    for f in found:
        out = out.unionByName(f)
    return out


def merged(spans_: np.ndarray) -> np.ndarray:
    """Spans (text, begin, end) in order, those that overlap or touch as one."""
    if not len(spans_):
        return spans_
    spans_ = spans_[np.lexsort((spans_[:, 1], spans_[:, 0]))]
    # the furthest end so far, within a text
    base = spans_[:, 0] * (int(spans_[:, 2].max()) + 2)
    reach = np.maximum.accumulate(spans_[:, 2] + base) - base
    new = np.r_[True, (spans_[1:, 0] != spans_[:-1, 0]) | (spans_[1:, 1] > reach[:-1])]
    first = np.flatnonzero(new)
    return np.stack([spans_[first, 0], spans_[first, 1], reach[np.r_[first[1:] - 1, len(spans_) - 1]]], axis=1)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (first word, last word + 1 of what is to be removed), items (ids of the
    items hit, as strings in order)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shards = index_shards(docs, window, id_col, text)
    found = search(shards, phrases_of(items, window, item_col, item_text), window)
    by_shard = found.groupBy("shard").agg(F.collect_list(F.struct("spans", "texts", "items")).alias("found"))
    joined = shards.select("shard", "ids", "text_of", "n_words").join(by_shard, "shard", "left").select("ids", "text_of", "n_words", "found")
    span = T.StructType([T.StructField(c, T.LongType()) for c in ("begin", "end")])
    schema = T.StructType([T.StructField("doc_id", shards.schema["ids"].dataType.elementType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()), T.StructField("spans", T.ArrayType(span)),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    target = to_arrow_schema(schema)

    def tell(batches):
        new_stage()
        for b in batches:
            for k in range(b.num_rows):
                text_of, n = np.frombuffer(b.column(1)[k].as_py(), np.int32), np.frombuffer(b.column(2)[k].as_py(), np.int64)
                got = b.column(3)[k].as_py() or []
                hit = merged(np.concatenate([np.frombuffer(x["spans"], np.int64).reshape(-1, 3) for x in got])) if got else np.zeros((0, 3), np.int64)
                n_hit = np.zeros(len(n), np.int64)
                np.add.at(n_hit, hit[:, 0], hit[:, 2] - hit[:, 1])
                upto = np.searchsorted(hit[:, 0], np.arange(len(n) + 1))
                names: dict[int, set] = {}
                for x in got:
                    for t, item in zip(np.frombuffer(x["texts"], np.int64).tolist(), x["items"], strict=True):
                        names.setdefault(t, set()).add(item)
                ordered = {t: sorted(v, key=str.encode) for t, v in names.items()}
                size = upto[text_of + 1] - upto[text_of]
                rows = spans(upto[text_of], size)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(hit[rows, 1]), pa.array(hit[rows, 2])], names=["begin", "end"]))
                columns = [b.column(0)[k].values, pa.array(n[text_of]), pa.array(n_hit[text_of]), listed,
                           pa.array([ordered.get(t, []) for t in text_of.tolist()], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return joined.mapInArrow(tell, schema)
