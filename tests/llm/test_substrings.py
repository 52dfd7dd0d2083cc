"""Both substring operators and their parts against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import anchors
from tidewater.llm.common import utf8_buffer, word_bounds
from tidewater.llm.fm_dedup import FMIndex, WaveletMatrix, remove_repeated_passages
from tidewater.llm.suffix_dedup import Hashed, remove_repeated_bytes, suffix_order

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\r\x0b\x0c"


def corpus(seed, n=60):
    """Copies, near copies, shared passages, repeats inside a text, periodic texts, white space of all kinds."""
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(300)] + ["é", "ß x", "日本", "."]
    prose = lambda k: [rng.choice(vocab) for _ in range(k)]
    shared = [prose(rng.randint(40, 130)) for _ in range(6)]
    texts = []
    for i in range(n):
        w = prose(rng.randint(0, 250))
        for _ in range(rng.randint(0, 3)):
            s, p = rng.choice(shared), rng.randint(0, len(w))
            cut = rng.randint(0, 20)
            w[p:p] = s[cut:] if rng.random() < .5 else s
        if texts and rng.random() < .25:
            w = list(rng.choice(texts))
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(w)
    texts += [["a"] * 400, ["a", "b"] * 200, ["a"] * 49, ["a"] * 50, ["a"] * 51, ["x", "y", "z"] * 120]
    rows = [(i, "".join(x + rng.choice(SPACES + "    ") for x in w), "en", "s", 1) for i, w in enumerate(texts)]
    return rows + [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, " \n ", "en", "s", 3)]


def brute_passages(rows, length=50):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    for d, w in split:
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(first.get(k, d), d)
    out = Counter()
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < d:
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(d, len(w), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def brute_bytes(rows, length=100):
    seen, out = set(), Counter()
    for d, t, *_ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            k = b[i:i + length]
            if k in seen:
                gone[i:i + length] = True
            seen.add(k)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[(d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, DOC).withColumns({"__g": F.lit("x"), "n_words": F.lit(1), "kept": F.lit(2)}).repartition(3)


def passages(df):
    got = remove_repeated_passages(df).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256))
    return Counter(map(tuple, got.collect()))


def cut_bytes(df):
    got = remove_repeated_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("seed,group", [(1, 4 << 20), (2, 3000), (3, 20000)])
def test_passages(spark, monkeypatch, seed, group):
    monkeypatch.setattr(anchors, "GROUP_BYTES", group)
    rows = corpus(seed)
    assert passages(frame(spark, rows)) == brute_passages(rows)


@pytest.mark.parametrize("seed,group", [(1, 4 << 20), (2, 3000), (3, 20000)])
def test_bytes(spark, monkeypatch, seed, group):
    monkeypatch.setattr(anchors, "GROUP_BYTES", group)
    rows = corpus(seed)
    assert cut_bytes(frame(spark, rows)) == brute_bytes(rows)


def test_one_id_on_several_rows(spark):
    rows = corpus(5, 20)
    twice = [(7, rows[3][1], "en", "s", 1), (7, rows[3][1], "en", "s", 1), (7, " ".join(["q%d" % i for i in range(90)]), "en", "s", 1)]
    assert passages(frame(spark, rows + twice)) == brute_passages(rows + twice)
    assert sum(cut_bytes(frame(spark, rows + twice)).values()) == len(rows) + 3


def test_null_id_and_empty_table(spark):
    long = " ".join("q%d" % i for i in range(90))
    got = passages(frame(spark, [(None, long, "en", "s", 1), (3, long, "en", "s", 1)]))
    assert {(k[0], k[2]) for k in got} == {(None, 90), (3, 0)}
    assert not passages(frame(spark, rows=[])) and not cut_bytes(frame(spark, rows=[]))


def test_very_long_text_in_pieces():
    rng = np.random.default_rng(0)
    a = rng.integers(97, 123, 5000).astype(np.uint8)
    values = anchors.BYTE_VALUE[a]
    whole = anchors.all_segments(values, np.array([0, 5000]), 100, 32)
    old, anchors.PLACE_BITS = anchors.PLACE_BITS, 11
    try:
        parts = anchors.all_segments(values, np.array([0, 5000]), 100, 32, most=700)
    finally:
        anchors.PLACE_BITS = old
    cover = lambda s: sorted(x for r in s for x in range(r["start"], r["start"] + r["windows"]))
    assert cover(whole) == cover(parts) == list(range(4901))


def test_word_hashes_tell_words_apart():
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"abc", "é".encode(), b"a", b"ab"]
    import pyarrow as pa
    data, off = utf8_buffer(pa.array([b" ".join(words).decode()]))
    s, e, _ = word_bounds(data, off)
    h = anchors.word_values(data, s, e)
    assert len(set(h.tolist())) == len(set(words)) and h[0] == h[7] and h[2] == h[8]


def test_wavelet_rank_and_backward_search():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 11, 3000)
    w = WaveletMatrix(seq, 11)
    sym, pos = rng.integers(0, 11, 500), rng.integers(0, 3001, 500)
    assert (w.rank(sym, pos) == [(seq[:p] == c).sum() for c, p in zip(sym, pos, strict=True)]).all()
    text = np.concatenate([rng.integers(1, 4, 400), [0]])
    index = FMIndex(text, 4, np.zeros(401, np.int64), 8)
    for _ in range(200):
        k = int(rng.integers(1, 8))
        p = rng.integers(1, 4, k)
        lo, hi = np.zeros(1, np.int64), np.array([401])
        for c in p[::-1]:
            lo, hi = index.back(np.array([c]), lo, hi)
        assert int(hi[0] - lo[0]) == sum((text[i:i + k] == p).all() for i in range(400 - k + 1))


def test_suffix_order():
    rng = np.random.default_rng(2)
    parts = [rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8) for _ in range(200)]
    group = np.sort(rng.integers(0, 5, 200))
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    got = suffix_order(Hashed(np.concatenate(parts), at), at[:-1], np.diff(at), group)
    want = sorted(range(200), key=lambda i: (group[i], parts[i].tobytes(), i))
    assert got.tolist() == want
