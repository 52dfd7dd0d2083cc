"""Benchmark decontamination against a search of every window in every text, and the index against its definition."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import decontaminate as dc
from tidewater.llm.queries import op13_benchmark_decontamination

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def phrases(items, window=10):
    out = set()
    for item, text in items:
        w = words(text)
        out |= {("" if item is None else str(item), tuple(w[i:i + window])) for i in range(max(len(w) - window + 1, 1)) if w}
    return out


def brute(text, wanted):
    """(number of words, hit words, items)."""
    w, hit, items = words(text), set(), set()
    for item, p in wanted:
        for i in range(len(w) - len(p) + 1):
            if tuple(w[i:i + len(p)]) == p:
                hit |= set(range(i, i + len(p)))
                items.add(item)
    return len(w), hit, sorted(items, key=str.encode)


def some_texts(rng, n, alphabet):
    return [np.array([rng.randrange(1, alphabet + 1) for _ in range(rng.choice([1, 2, 30, 200]))], np.int64) for _ in range(n)]


def test_suffixes_ranks_and_places():
    rng = random.Random(5)
    for alphabet in (1, 2, 5, 300):
        for _ in range(12):
            texts = some_texts(rng, rng.randrange(1, 7), alphabet)
            whole = np.concatenate([x for t in texts for x in (t, [0])])
            order = dc.sorted_suffixes(whole, len(texts))
            number = np.cumsum(whole == 0) - (whole == 0)
            # an end sorts before all words, and by its text
            suffix = lambda i: [(0, number[j]) if whole[j] == 0 else (1, whole[j]) for j in range(i, len(whole))]  # noqa: E731, B023
            assert order.tolist() == sorted(range(len(whole)), key=suffix)
            zero = np.zeros(len(texts), np.int64)
            index = dc.FMIndex.build(texts, zero, zero, pa.array([b"%d" % k for k in range(alphabet)], pa.binary()))
            index = dc.FMIndex.load(index.dump()).open()
            assert index.dictionary().to_pylist() == [b"%d" % k for k in range(alphabet)]
            assert index.locate(np.arange(len(whole))).tolist() == order.tolist()
            for c in range(1, alphabet + 1):
                rank = np.cumsum(whole[order - 1] == c)
                at = np.arange(0, len(whole) + 1)
                assert (index.back(np.full(len(at), c), at) - index.head[c]).tolist() == [0, *rank.tolist()]


ITEMS = [(1, " ".join(f"w{i}" for i in range(25))), (2, "short item Here"), (3, None), (4, ""), (5, "!!! ..."), (None, "no id given at all"),
         (6, "Über-Größe 日本語 x9"), (10, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 and on"), (10, "the"), (2, "second text of item two"), (7, "a a")]


def planted():
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, "... \n!"), (3, "the" * 5000), (4, "x the y The z"), (4, "x the y The z"), (None, "short, ITEM\nhere"), (5, "short item"),
            (6, "über größe 日本語 x9 über größe 日本語 x9"), (7, "a a a a b a"), (8, "q " * 40_000 + "short item here " + "q " * 100)]
    for k in range(60):
        w = ["w%d" % rng.randrange(40) for _ in range(rng.randrange(1, 60))]
        if k % 3 == 0:
            at, a = rng.randrange(len(w)), rng.randrange(20)
            w[at:at] = [f"W{i}" for i in range(a, a + rng.randrange(8, 16))]
        rows.append((100 + k, rng.choice([" ", ", ", "\n"]).join(w)))
    return rows + [(200 + k, "copy of a text with the word") for k in range(20)]


def read(spark, tmp_path, rows, items):
    spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC).withColumn("item_id", F.lit(1)).withColumn("shard", F.lit("clash")) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").withColumn("phrase", F.lit(1)).withColumn("words", F.lit("clash")) \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    return sorted(map(tuple, op13_benchmark_decontamination(spark, str(tmp_path)).collect()), key=str)


def contract(rows, items):
    wanted, out = phrases(items), []
    for d, t in rows:
        n, hit, names = brute(t, wanted)
        out.append((d, n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0))
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows", "items"), [(planted(), ITEMS), ([], ITEMS), (planted(), []), (planted()[:12], [(1, None)])])
def test_query(spark, tmp_path, rows, items):
    assert read(spark, tmp_path, rows, items) == contract(rows, items)


def test_blocks_parts_and_chunks(spark, tmp_path, monkeypatch):
    """Phrases in many blocks, on spans of many shards: the same result. (Tasks see the smaller shards through the closure.)"""
    monkeypatch.setattr(dc, "BLOCK_PHRASES", 5)
    assert read(spark, tmp_path, planted(), ITEMS) == contract(planted(), ITEMS)


def test_small_indexes_in_one_process(monkeypatch):
    """Long texts in parts that overlap, and occurrences located few at a time."""
    monkeypatch.setattr(dc, "MOST_WORDS", 16)
    monkeypatch.setattr(dc, "CHUNK", 3)
    rows = [r for r in planted() if len(r[1] or "") < 3000]
    wanted = phrases(ITEMS)
    texts = [(t or "").encode() for _, t in rows]
    data = np.frombuffer(b"".join(texts), np.uint8)
    indexes, n = dc.indexes_of(data, np.cumsum([0] + [len(t) for t in texts]), 10)
    assert len(indexes) > 20
    table = pa.table({"item": [i for i, _ in wanted], "phrase": pa.array([list(p) for _, p in wanted], pa.list_(pa.string()))})
    block = dc.Phrases.of(table, 10)
    got = [block.find(dc.FMIndex.load(x)) for x in indexes]
    spans = dc.merged(np.concatenate([s for s, _ in got]))
    pairs = {(int(t), block.items[int(i)].as_py()) for _, p in got for t, i in p}
    for k, (_, text) in enumerate(rows):
        count, hit, names = brute(text, wanted)
        assert n[k] == count
        assert {w for t, a, b in spans.tolist() if t == k for w in range(a, b)} == hit
        assert sorted((i for t, i in pairs if t == k), key=str.encode) == names


def test_spans(spark):
    docs = spark.createDataFrame([(1, "a b The cat sat. c the cat SAT on")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "the cat sat"), ("y", "cat sat on")], "item_id string, text string")
    row = dc.decontaminate(docs, items).first()
    assert (row.n_words, row.n_hit, [tuple(s) for s in row.spans], row["items"]) == (10, 7, [(2, 5), (6, 10)], ["x", "y"])
