"""Brute-force checks of sharding, mixing, token counts, top-k and URL filter on small fixtures."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm.common import word_counts
from tidewater.llm.mixing import mix
from tidewater.llm.sharding import shard
from tidewater.llm.token_counts import count_tokens
from tidewater.llm.topk import top_inner_products
from tidewater.llm.url_filter import default_suffixes, host_reputation, judge_urls, named_hosts, read_suffixes

DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", "a", 4), (3, "x" * 200_000, "en", "b", 1),
       (4, "ein zwei  drei ", "de", "b", 1), (4, "ein zwei  drei ", "de", "b", 1), (5, "über\u00a0alles é", None, "b", 1),
       (None, "kein Schlüssel", "de", None, 1), (6, "<s> </s> <unk> ▁ x", "en", "c", 1)]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).withColumn("size", F.lit("clash")).withColumn("__h", F.lit(1)).withColumn("rank", F.lit(2))


def many(n=400):
    rng = np.random.default_rng(7)
    return [(i, " ".join(["w"] * int(rng.integers(1, 300))), "en", ["a", "b", "c", None, "zz"][min(4, int(rng.integers(0, 9)))], 1)
            for i in range(n)]


def test_word_counts(spark):
    got = {(r[0], r[1]) for r in word_counts(docs(spark, ODD), "text", ["doc_id"], "n").collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 3), (5, 2), (None, 2), (6, 5)}


@pytest.mark.parametrize("rows", [ODD, many(), []])
def test_shards(spark, rows):
    got = shard(docs(spark, rows), n_shards=7).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(rows) >= 7:
        assert len(slots) == 7 and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shards_in_the_order_of_fractional_ranks(spark):
    """Every row's place against its definition: (2 r - 1) / 2 n of its rank by seeded hash among the n rows of its source."""
    from fractions import Fraction
    rows = [r for r in many(500) if r[0] != 3] + [(3, "three", "en", None, 1)]
    df = docs(spark, rows)
    hashed = df.select("doc_id", "source", F.xxhash64(F.lit(20), F.col("doc_id"), F.crc32(F.col("text").cast("binary"))).alias("h")).collect()
    by_source = defaultdict(list)
    for r in sorted(hashed, key=lambda r: r.h & ((1 << 64) - 1)):       # by the top bits first: as unsigned
        by_source[r.source].append(r.doc_id)
    key = lambda s: "n" if s is None else "s" + s
    order = sorted((Fraction(2 * k + 1, 2 * len(ids)), key(s), k, d) for s, ids in by_source.items() for k, d in enumerate(ids))
    place = {d: g for g, (*_, d) in enumerate(order)}
    n, got = len(rows), shard(df, n_shards=7).collect()
    for r in got:
        assert r.shard == place[r.doc_id] * 7 // n
    for k in range(7):
        assert [r.doc_id for r in sorted((r for r in got if r.shard == k), key=lambda r: r.slot)] == [d for *_, d in order if place[d] * 7 // n == k]


def test_shards_hold_the_mixture(spark):
    rows = many(2000)
    source = {r[0]: r[3] for r in rows}
    whole = Counter(source.values())
    got = defaultdict(Counter)
    for r in shard(docs(spark, rows), n_shards=8).collect():
        got[r.shard][source[r.doc_id]] += 1
    assert all(abs(c[s] - whole[s] / 8) <= 1.5 for c in got.values() for s in whole)


def wanted(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) > 2 * sizes[s]]
        if not over:
            return out | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        for s in over:
            out[s] = 2 * sizes[s]
            free.discard(s)
        left = 1.5 * sum(sizes.values()) - sum(out.values())
    return out


@pytest.mark.parametrize("rows", [many(), ODD, []])
def test_mix(spark, rows):
    got = mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").encode().split())
    target = wanted(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        taken[r.source] += r.taken
    if len(rows) > 100:
        assert all(abs(taken[s] - target[s]) <= max(3, 0.002 * target[s]) for s in sizes), (taken, target)
    again = mix(docs(spark, rows)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_token_counts(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = ODD + [(10, "The cat,\nthe  hat", "en", "a", 1), (11, " lead", "en", "a", 1), (12, "tail ", "en", "a", 1),
                  (13, "日本語 テキスト 🙂\u2028x", "ja", "a", 1), (14, "a\tb\r\nc " * 50, "en", "a", 1)]
    want = Counter((d, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4) for d, t, *_ in rows)
    cache = str(tmp_path / "cache")
    for _ in range(2):      # the second run finds every count
        got = count_tokens(docs(spark, rows), path, cache=cache, limit=4).collect()
        assert Counter(map(tuple, got)) == want
    cached = spark.read.parquet(cache)
    assert cached.count() == cached.select("digest").distinct().count() == len({t or "" for _, t, *_ in rows})
    assert count_tokens(docs(spark, []), path).count() == 0


def test_a_filled_cache_serves_whole_tables(spark, tmp_path):
    """Half of the table first, then all of it twice: only what is missing is encoded, and the counts are those of a cold cache."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path, cache = public_tokenizers.path("piece_bpe_32k.model"), str(tmp_path / "cache")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    contents = df.select("text").distinct().count()
    sizes = []
    for part in (df.filter("doc_id % 2 = 0"), df, df):
        got = sorted(map(tuple, count_tokens(part, path, cache=cache).collect()))
        sizes.append(spark.read.parquet(cache).count())
    assert sizes[0] < sizes[1] == sizes[2] == contents
    assert got == sorted(map(tuple, count_tokens(df, path).collect())) and len(got) == df.count()


def test_word_by_word_counts_add_up(spark):
    """Real texts: counting between spaces equals encoding whole texts."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    from tidewater.llm.token_counts import counter
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    c = counter(path)
    assert c.additive and c.count(texts) == [len(x) for x in sp.encode(texts)]


VEC = "vec_id long, embedding array<float>, label int, score string"


def brute_top(rows, k=10):
    ok = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in ok if c != q and len(w) == len(v))[:k]
            out |= {(q, r, c, -x) for r, (x, c) in enumerate(s, 1)}
    return out


def test_top_inner_products(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, rng.uniform(0.05, 2), 24).astype(np.float32).tolist(), 0, "x") for i in range(900)]
    rows += [(1000 + i, rows[100][1], 0, "x") for i in range(60)]               # ties
    rows += [(2000, None, 0, "x"), (2100, [None] * 24, 0, "x"), (2200, [float("nan")] * 24, 0, "x"), (2300, [0.0] * 24, 0, "x"),
             (2400, [1.0, 2.0], 0, "x"), (2401, [3.0, 1.0], 0, "x"), (None, [1.0] * 24, 0, "x"), (2500, [float("inf")] * 24, 0, "x")]
    df = spark.createDataFrame(rows, VEC).repartition(5)
    for head, block in ((2048, 2048), (16, 50)):
        got = {tuple(r) for r in top_inner_products(df, F.col("vec_id") % 100 == 0, head=head, block=block, group=4).collect()}
        assert got == brute_top(rows)
    assert top_inner_products(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_inner_products_of_repeated_ids(spark):
    """Rows are told apart by their place: twins are candidates of each other and each is asked."""
    rows = [(0, [1.0, 0.0], 0, "x"), (0, [2.0, 0.0], 0, "x"), (1, [3.0, 1.0], 0, "x")]
    got = sorted(tuple(r) for r in top_inner_products(spark.createDataFrame(rows, VEC), F.col("vec_id") % 100 == 0).collect())
    one, two, three = 1024, 2048, 3072
    assert got == sorted([(0, 1, 1, one * three), (0, 2, 0, one * two), (0, 1, 1, two * three), (0, 2, 0, one * two)])
    same = [(100 * (i % 3), [1.0, 1.0], 0, "x") for i in range(9)]
    got = [tuple(r) for r in top_inner_products(spark.createDataFrame(same, VEC), F.col("vec_id") % 100 == 0, k=4, block=2, group=2).collect()]
    assert Counter(got) == Counter((q, r, 0 if q or r < 3 else 100, 2 << 20) for q in (0, 0, 0, 100, 100, 100, 200, 200, 200) for r in (1, 2, 3, 4)
                                   if not (q and r == 4)) + Counter((q, 4, 100, 2 << 20) for q in (100, 200) for _ in range(3))


def test_long_vectors_at_the_ends_of_a_long(spark):
    rows = [(i, [float(x), float(-x)], 0, "x") for i, x in enumerate([3e12, 3e12, -3e12, 1.0, 0.0, 2e13, -2e13])]
    got = sorted(tuple(r) for r in top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string"),
                                                      F.col("vec_id") % 100 == 0, k=6).collect())
    v = [[int(np.floor(1024 * x)) for x in r[1]] for r in rows]
    ends = np.iinfo(np.int64)
    want = sorted((-max(min(sum(a * b for a, b in zip(v[0], w, strict=True)), ends.max), ends.min), c) for c, w in enumerate(v) if c)
    assert got == [(0, r, c, -x) for r, (x, c) in enumerate(want, 1)]


@pytest.mark.parametrize("spread", [3.0, 0.0])
def test_blocks_meet_only_groups_they_can_matter_to(spark, spread):
    """Of vectors of very different lengths few blocks are sent; of equally long ones all are, and the result is right."""
    from tidewater.llm import topk
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 1, 16) * np.exp(spread * rng.normal())).astype(np.float32).tolist(), 0, "x") for i in range(1500)]
    df = spark.createDataFrame(rows, VEC)
    out = top_inner_products(df, F.col("vec_id") % 100 == 0, head=64, block=32, group=8)
    assert {tuple(r) for r in out.collect()} == brute_top(rows)
    g = topk.Group(np.arange(4), np.eye(4, 16, dtype=np.int64) * 1000, np.full(4, -np.inf), np.zeros((16, 0)), 2)
    far = np.zeros((6, 16), np.int64)
    far[:, 0] = [900, 800, 700, 3, 2, 1]
    g.read(np.arange(10, 16), np.arange(10, 16), far, np.sqrt((far ** 2.0).sum(1)), step=1)
    assert g.scored < 24 and g.kept[2][:2].tolist() == [10, 11]


def test_urls(spark):
    urls = ["http://a.example.net/en/1", "http://EXAMPLE.net/de/", "http://example.net", "https://x.example.com/de/?q", "http://b.org/fr/x#y",
            "http://notexample.com/de/1", "no url", None, "", "ftp://net/", "http://h?x://y/z", "http://a.example.com/de"]
    df = spark.createDataFrame([(i, u, "h", "b") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, spark.createDataFrame([], "page_id long, bad int")).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.net", "/de/", "net/", "block"),
        2: ("example.net", "", None, "allow"), 3: ("x.example.com", "/de/", "example.com/de/", "block"),
        4: ("b.org", "/fr/x", "org/fr/", "allow"), 5: ("notexample.com", "/de/1", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("net", "/", "net/", "block"), 10: ("h", "", None, "allow"),
        11: ("a.example.com", "/de", None, "allow")}


def test_reputation_shrinks(spark):
    rows = [(f"h{i}.good.com", 40, 2 + i % 3) for i in range(30)] + [("bad.evil.com", 60, 55), ("new.evil.com", 1, 1), ("one.good.com", 1, 1)]
    got = {r.host: r for r in host_reputation(spark.createDataFrame(rows, "host string, n long, bad long")).collect()}
    assert got["bad.evil.com"].lower > 0.5 and got["one.good.com"].lower < 0.3
    assert got["new.evil.com"].mean > got["one.good.com"].mean       # the domain's record counts for a new host
    assert all(r.lower <= r.mean for r in got.values())


def test_named_hosts(spark, tmp_path):
    hosts = ["a.b.co.uk", "co.uk", "x.y.example.org", "localhost", "shop.example.co.il", "example.com:8080", "me:pw@www.example.com", "1.2.3.4",
             "1.2.3.4:80", "[::1]:80", "a.b.c.ck", "x.www.ck", "www.ck", "ck", "a..com", "com."]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("__labels", F.lit(1)).drop("__labels")
    names = lambda rules: {r.host: (r.domain, r.suffix) for r in named_hosts(df, rules).collect()}
    got = names(default_suffixes(spark))
    assert [got[h] for h in hosts[:4]] == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.org", "org"), ("localhost", "localhost")]
    assert got["example.com:8080"] == got["me:pw@www.example.com"] == ("example.com", "com")
    assert got["1.2.3.4"] == got["1.2.3.4:80"] == ("1.2.3.4", "1.2.3.4") and got["[::1]:80"] == ("[::1]", "[::1]")
    (tmp_path / "list.dat").write_text("// comment\n\nco.il  and more\n*.ck\n!www.ck\ncom\n")
    got = names(read_suffixes(spark, str(tmp_path / "list.dat")))
    assert got["shop.example.co.il"] == ("example.co.il", "co.il") and got["a.b.c.ck"] == ("b.c.ck", "c.ck")
    assert got["x.www.ck"] == got["www.ck"] == ("www.ck", "ck") and got["ck"] == ("ck", "ck") and got["a.b.co.uk"] == ("co.uk", "uk")


def test_urls_of_odd_tables(spark):
    """Empty tables, repeated pages, very long urls, labels without a value."""
    none = spark.createDataFrame([], "page_id long, bad int")
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), none).count() == 0
    long = "http://" + "a" * 100_000 + ".com/" + "b" * 100_000
    rows = [(1, long), (1, long), (None, "http://x.com/"), (2, "http://u@x.com:80/"), (3, None)]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame([(2, None), (None, 1)], "page_id long, bad int"))
    assert Counter((r.page_id, len(r.host), len(r.path), r.verdict) for r in got.collect()) == Counter(
        {(1, 100_004, 100_001, "allow"): 2, (None, 5, 1, "allow"): 1, (2, 10, 1, "allow"): 1, (3, 0, 0, "allow"): 1})

def tilted_rate(sizes, tilts, target, cap):
    """min(cap, exp(x * tilt)) with tokens that add up to the target, by halving."""
    lo, hi = -60.0, 60.0
    for _ in range(200):
        x = (lo + hi) / 2
        if sum(n * min(cap, np.exp(x * t)) for n, t in zip(sizes, tilts, strict=True)) < target:
            lo = x
        else:
            hi = x
    return [min(cap, np.exp(hi * t)) for t in tilts]


def test_mix_with_tilts(spark):
    """Rates of documents that move differently: they meet the targets, and copies follow the running sums of rates."""
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))), "abbbb"[i % 5], float(rng.choice([0.25, 0.5, 1.0, 2.0, 3.7]))) for i in range(600)]
    rows += [(7, "w w w", "a", 0.5)] * 5 + [(8, "w w", "b", None), (9, "w", "b", -1.0), (10, "w", "b", float("nan")), (11, "w w", "b", float("inf"))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tilt double")
    got = mix(df, weights=(1, 2), tilt="tilt").collect()
    assert len(got) == len(rows)
    size = lambda t: len(t.split())
    totals = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in "ab"}
    for s in "ab":
        mine = [r for r in rows if r[2] == s]
        tilts = [t if t is not None and 0 < t < float("inf") else 1.0 for *_, t in mine]
        out = [r for r in got if r.source == s]
        target = out[0].target
        want = tilted_rate([size(r[1]) for r in mine], tilts, target, 2.0)
        assert sorted((r.doc_id, r.size, round(r.rate, 6)) for r in out) == sorted((r[0], size(r[1]), round(float(x), 6)) for r, x in zip(mine, want, strict=True))
        assert all(r.copies in (int(r.rate), int(r.rate) + 1) and r.taken == r.copies * r.size for r in out)
        assert abs(sum(r.taken for r in out) - target) <= max(3, 0.004 * target) and target <= 2 * totals[s]


def test_a_source_at_its_cap(spark):
    """A tiny source of great weight gives all it may, the others share the rest; a target is never above the cap."""
    rows = [(i, "w " * 7, "en", "tiny" if i < 3 else "a big one", 1) for i in range(100)]
    got = mix(spark.createDataFrame(rows, DOC), weights=(1, 3)).collect()
    assert {(r.source, r.target, r.copies) for r in got if r.source == "tiny"} == {("tiny", 42.0, 2)}
    assert sum(r.taken for r in got) == pytest.approx(1050, abs=7)


def test_unreached_targets_are_an_error(spark, monkeypatch):
    from tidewater.llm import mixing
    monkeypatch.setattr(mixing, "MAX_ITERATIONS", 1)
    with pytest.raises(RuntimeError, match="misses its target"):
        mix(spark.createDataFrame(many(40), DOC))
