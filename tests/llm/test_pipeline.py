"""The pipeline's stages against brute force on a small corpus, and on odd rows."""

import os
import random
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline as P  # noqa: E402
from test_jaccard import brute as near_brute  # noqa: E402
from test_packing import check  # noqa: E402
from test_quality import brute as quality_brute  # noqa: E402
from test_small_ops import wanted  # noqa: E402
from test_substrings import brute_passages  # noqa: E402

pytest.importorskip("public_tokenizers")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(9)
    vocab = ["w%d" % i for i in range(400)]
    prose = lambda k: [rng.choice(vocab) for _ in range(k)]
    passage, out = prose(70), []
    for i in range(160):
        w = prose(rng.randint(5, 150))
        if out and rng.random() < .2:
            w = list(out[rng.randrange(len(out))][1].split())
            w[rng.randrange(len(w))] = rng.choice(vocab)
        elif rng.random() < .3:
            w += passage
        out.append((i, " ".join(w), "en", "s%d" % rng.randrange(4), 1))
    return [(d, t, a, b, len(t)) for d, t, a, b, _ in out]


def write(spark, path, rows):
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_stages(spark, tmp_path):
    rows = corpus()
    sf = str(tmp_path)
    write(spark, sf, rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    kept = [tuple(r) for r in P.quality(spark, docs, sf).collect()]
    assert Counter(kept) == Counter(r for r in rows if not quality_brute(r[1])[-1])

    one = P.near_duplicate_groups(spark, spark.createDataFrame(kept, DOC), sf).collect()
    heads = {c for _, _, c in near_brute(kept)}
    assert Counter(map(tuple, one)) == Counter(r for r in kept if r[0] in heads)

    one = [tuple(r) for r in one]
    cut = [tuple(r) for r in P.substrings(spark, spark.createDataFrame(one, DOC), sf).collect()]
    want = {d: (n - gone) for d, n, gone, _ in brute_passages(one)}
    before = {r[0]: r for r in one}
    assert {r[0] for r in cut} == set(before) and sum(want.values()) < sum(len(r[1].split()) for r in one)
    for d, t, a, b, n in cut:
        assert len(t.split()) == want[d] and (a, b) == before[d][2:4] and n == len(t)

    mixed = [tuple(r) for r in P.mixture(spark, spark.createDataFrame(cut, DOC), sf).collect()]
    assert set(mixed) <= set(cut) and max(Counter(mixed).values()) <= 2
    size, got = Counter(), Counter()
    for r in cut:
        size[r[3]] += len(r[1].split())
    for r in mixed:
        got[r[3]] += len(r[1].split())
    target = wanted(dict(size))
    assert all(abs(got[s] - target[s]) <= 0.02 * target[s] for s in size)

    alone = [r for r, n in Counter(mixed).items() if n == 1]
    pieces = P.packing(spark, spark.createDataFrame(alone, DOC), sf).collect()
    check(pieces, alone, 4096)


def test_run(spark, tmp_path):
    sf = str(tmp_path)
    write(spark, sf, corpus())
    out = P.run(spark, sf)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word " * 30_000, "en", "s", 9), (None, "a b c", "en", None, 5),
       (None, "a b c", "en", None, 5), (4, "x y z", "en", "s", 5), (4, "x y z", "en", "s", 5), (4, "x y w", "en", "s", 5)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows_pass_every_stage(spark, tmp_path, rows):
    sf = str(tmp_path)
    write(spark, sf, rows)
    for _, stage in P.STAGES:
        out = stage(spark, spark.createDataFrame(rows, DOC), sf)
        out.collect()
        if stage is not P.packing:
            assert out.columns == P.COLUMNS
    P.run(spark, sf).collect()


def test_clashing_columns_and_no_labels(spark, tmp_path):
    """Columns named like the stages' own are not read, and labels may be empty."""
    sf, rows = str(tmp_path), corpus()[:40]
    plain = spark.createDataFrame(rows, DOC)
    odd = plain.withColumns({c: F.lit(7) for c in ("row", "copies", "rows", "kept", "label", "key", "size", "words", "n_removed", "block", "__g", "copy")})
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for name, stage in P.STAGES[:-1]:
        assert Counter(stage(spark, odd, sf).collect()) == Counter(stage(spark, plain, sf).collect()), name
    columns = ["doc_id", "start", "length", "sequence_id", "offset"]
    assert Counter(P.packing(spark, odd, sf).select(columns).collect()) == Counter(P.packing(spark, plain, sf).select(columns).collect())


def test_one_row_of_each_group_stays(spark):
    """Ids are repeated over different texts, or null: groups are of rows."""
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    a, b, c, d = map(text, "bacd")
    rows = [(0, a), (1, a + " more"), (1, b), (1, c), (2, c), (None, a), (None, d), (None, d), (None, ""), (3, None), (3, " ")]
    got = P.near_duplicate_groups(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOC).repartition(3), "").collect()
    want = [(0, a), (1, b), (1, c), (None, d), (None, ""), (3, None), (3, " ")]
    assert Counter(tuple(r)[:2] for r in got) == Counter(want)
