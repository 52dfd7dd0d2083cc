"""The Jaccard join against all pairs, and its parts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import anchors, jaccard
from tidewater.llm.components import components
from tidewater.llm.jaccard import near_duplicates, occurrence_search, overlap_needed, pairs_of

DOC = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(UPPER).encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows, percent=75):
    """Each row's set size and the least id reachable by links."""
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows))


def corpus(seed, n=150, chain=12):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(500)] + ["É", "ß"]
    prose = lambda k: [rng.choice(vocab) for _ in range(k)]
    line, texts = prose(60), []
    for _ in range(n):
        if texts and rng.random() < .6:
            w = list(rng.choice(texts))
            for _ in range(rng.randint(0, 1 + len(w) // 25)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
        else:
            w = prose(rng.choice([0, 1, 3, 4, 5, 6, 30, 120]))
            if rng.random() < .5:
                w += line
        texts.append(w)
    w = prose(200)      # a chain: ends are far apart, neighbours link
    for _ in range(chain):
        w = list(w)
        p = rng.randrange(180)
        w[p:p + 8] = prose(8)
        texts.append(w)
    rows = [(i, " ".join(x.upper() if rng.random() < .1 else x for x in w), "en", "s", 1) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, DOC).withColumns({"__g": F.lit("x"), "key": F.lit(1), "n": F.lit(2)}).repartition(3)
    return Counter(map(tuple, near_duplicates(df, **kw).collect()))


@pytest.mark.parametrize("seed,group", [(1, 4 << 20), (2, 5000)])
def test_against_all_pairs(spark, monkeypatch, seed, group):
    monkeypatch.setattr(anchors, "GROUP_BYTES", group)
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, None, None, None, None), (1, "", "en", "s", 0), (2, " \n", "en", "s", 0), (3, "a b", "en", "s", 0), (4, "A  B", "en", "s", 0),
            (4, "A  B", "en", "s", 0), (5, "x " * 100_000, "en", "s", 0), (9, "x x x x x x", "en", "s", 0), (6, "a b c d e f", "en", "s", 0),
            (7, "a\tb\nc d e f", "en", "s", 0), (8, "a b c d e f g h", "en", "s", 0)]
    assert run(spark, rows) == brute(rows)
    assert not run(spark, [])


def test_occurrence_search_equals_intersection():
    rng = np.random.default_rng(0)
    for _ in range(50):
        c = np.unique(rng.integers(0, 300, rng.integers(5, 150)).astype(np.uint64))
        sets = [np.unique(np.concatenate([rng.choice(c, rng.integers(1, len(c) + 1)), rng.integers(0, 300, rng.integers(0, 30)).astype(np.uint64)]))
                for _ in range(40)]
        got = occurrence_search(c, sets, 75)
        for s, g in zip(sets, got, strict=True):
            i = len(np.intersect1d(c, s))
            linked = 100 * i >= 75 * (len(c) + len(s) - i)
            assert g == (i if linked else 0)


def test_overlap_needed():
    for n in range(1, 60):
        for m in range(1, 60):
            t = overlap_needed(n, m, 75)
            assert 100 * t >= 75 * (n + m - t) and 100 * (t - 1) < 75 * (n + m - t + 1)


def test_pairs_skip_one_component():
    p = np.zeros(4, jaccard.POSTING)
    p["low"], p["uid"], p["n"], p["label"] = 1, [1, 2, 3, 4], 10, [1, 1, 1, 4]
    assert {tuple(x) for x in pairs_of(p, True, 75).tolist()} == {(1, 4), (2, 4), (3, 4)}
    p["label"] = 1
    assert len(pairs_of(p, True, 75)) == 0


def test_pairs_need_a_first_common_shingle_in_reach():
    p = np.zeros(2, jaccard.POSTING)
    p["low"], p["uid"], p["n"], p["label"] = 1, [1, 2], 100, [1, 2]
    for place, found in ((14, 1), (15, 0), (24, 0)):    # T is 86
        p["place"] = p["single"] = place
        assert len(pairs_of(p, True, 75)) == found
    p["place"], p["single"] = 24, 0     # the pair comes from an earlier list, if it links
    assert not len(pairs_of(p, True, 75))


@pytest.mark.parametrize("most", [1, 1000, 1 << 40])
def test_parts_hold_every_pair_once(most):
    rng = np.random.default_rng(1)
    p = np.zeros(3000, jaccard.PAIR)
    p["a"], p["b"] = rng.integers(0, 5, 3000), rng.integers(10, 400, 3000)
    size = rng.integers(80, 100, 400)
    got = jaccard.parts_of(p, size[p["b"]], 75, most)
    assert Counter(x for part in got for x in part.tolist()) == Counter(set(p.tolist()))
    assert all(size[part["b"]].sum() <= most + 300 for part in got)
    assert (len(got) == 1) == (most == 1 << 40)


def test_large_group_in_parts(spark, monkeypatch):
    """Near copies of one text, many of which link with none: the sets that one task gets at once are bounded."""
    rng = random.Random(7)
    base = ["b%d" % i for i in range(120)]
    rows = []
    for i in range(160):
        w = list(base)
        for p in rng.sample(range(120), rng.randint(0, 6)):
            w[p] = "x%d_%d" % (p, rng.randrange(3))
        rows.append((i, " ".join(w), "en", "s", 1))
    assert run(spark, rows) == brute(rows)
    held = spark.sparkContext.accumulator(0)
    decide = jaccard.decide

    def measured(pairs, sets, percent):
        if sum(len(x) // 8 for x in sets.column("hashes").to_pylist()) > 4500:
            held.add(1)
        return decide(pairs, sets, percent)
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 4000, raising=False)
    monkeypatch.setattr(jaccard, "decide", measured)
    assert run(spark, rows) == brute(rows)
    assert held.value == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(300, 301), (301, 300), (302, 302)]
    root = {v: v for e in links for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.v: r.label for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {v: find(v) for v in root}
