"""Periodic runs of words against an enumeration of all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import periodic_runs as pr
from tidewater.llm.queries import op12_periodic_runs

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6):
    """(start, length, period) of all runs, by start and period."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 4 * q):
                out.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


def some_text(rng, n, alphabet):
    w = [rng.randrange(alphabet) for _ in range(n)]
    if n > 3 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(3, 11)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def found(docs):
    off = np.cumsum([0] + [len(w) for w in docs])
    got = [[] for _ in docs]
    for t, *x in zip(*pr.runs_of_words(np.array(sum(docs, []), np.int64), off), strict=True):
        got[t].append(tuple(map(int, x)))
    return got


def test_cover():
    assert all((pr.MEMBER[d] + d) % pr.MODULUS in pr.COVER and pr.MEMBER[d] in pr.COVER for d in range(pr.MODULUS))


def test_extensions():
    rng = random.Random(2)
    for _ in range(60):
        docs = [some_text(rng, rng.choice([1, 40, 200]), rng.choice([1, 2, 30])) for _ in range(4)]
        off = np.cumsum([0] + [len(w) for w in docs])
        flat = sum(docs, [])
        ext = pr.Extensions(np.array(flat, np.int64), off)
        pairs = [(off[d] + i, off[d] + j, off[d + 1] - off[d] - j) for d, w in enumerate(docs) for i in range(len(w)) for j in range(i + 1, len(w))]
        pairs = rng.sample(pairs, min(300, len(pairs)))
        if not pairs:
            continue
        i, j, room = map(np.array, zip(*pairs, strict=True))
        want = [next((k for k in range(r) if flat[a + k] != flat[b + k]), r) for a, b, r in pairs]
        assert ext.common(i, j, room).tolist() == want


def test_runs(monkeypatch):
    rng = random.Random(1)
    for k in range(300):
        monkeypatch.setattr(pr, "CHUNK", rng.choice([1, 50, 1 << 19]))
        docs = [some_text(rng, rng.choice([0, 1, 5, 6, 20, 100, 300]), rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 6))]
        assert found(docs) == [brute(w) for w in docs]


def test_long_runs():
    fib = [0]
    nxt = [0, 1]
    while len(nxt) < 3000:
        fib, nxt = nxt, nxt + fib
    docs = [[0] * 5000, [0, 1, 2] * 1500 + [7] + [0, 1] * 900, nxt]
    assert found(docs) == [brute(w) for w in docs]


def contract(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


ODD = [(0, None), (1, ""), (2, " \n\t "), (3, "x" * 300_000), (4, "a b " * 40 + "c"), (4, "a b " * 40 + "c"), (5, "  " * 9), (None, "la la la la la la"),
       (6, "no repeats here at all"), (7, "é\x0bé\x0cé\ré\né é"), (-8, "one two " * 30)]


def many(n=150):
    rng = random.Random(9)
    return [(i, rng.choice([" ", "\n"]).join("w%d" % x for x in some_text(rng, rng.randrange(0, 120), rng.choice([1, 2, 40])))) for i in range(n)]


@pytest.mark.parametrize("rows", [ODD, many(), []])
def test_query(spark, tmp_path, rows):
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOC).withColumn("words", F.lit(1)).withColumn("g", F.lit("clash"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((contract(*r) for r in rows), key=str)


def test_very_long_text(spark):
    """One text of two million words: a piece of its own."""
    text = "a b c " * 500_000 + "x " + "d e " * 250_000
    row = pr.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_words == 2_000_001 and [tuple(r) for r in row.runs] == [(0, 1_500_000, 3), (1_500_001, 500_000, 2)]
    assert row.collapsed == "a b c x d e"
