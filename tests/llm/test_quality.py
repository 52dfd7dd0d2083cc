"""Statistics against brute force, and the classifier on rows held out."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import quality
from tidewater.llm.quality import judge_quality, platt

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LABEL = "doc_id long, quality int, toxic int"
SPACE = " \t\n\r\x0b\x0c"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed


def rows(n=120):
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(60)] + ["é", "日本語", "a#b", "$5", "<x>", "|", " ", " "]
    out = [(0, None), (1, ""), (2, " \n\n "), (3, "\n"), (4, "a\na\n a\na"), (5, "x y " * 30_000), (6, "ü" * 50_000), (7, "a\r\na\r\n"), (7, "a\r\na\r\n")]
    for i in range(10, n):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(0, 12))]
        if lines and rng.random() < .5:
            lines += [rng.choice(lines) for _ in range(rng.randint(1, 4))]
        out.append((i, "".join(x + rng.choice(["\n", "\n\n", " "]) for x in lines)))
    return [(i, t, "en", "s", 1) for i, t in out]


def test_statistics(spark):
    data = rows()
    df = spark.createDataFrame(data, DOC).withColumns({"n_words": F.lit("clash"), "kept": F.lit(1)}).repartition(3)
    got = judge_quality(df, spark.createDataFrame([], LABEL)).collect()
    assert Counter((r[0], *r[1:7]) for r in got) == Counter((d, *brute(t)) for d, t, *_ in data)
    assert all(r.kept != r.base_failed and r.p_low is None for r in got)       # nothing learnt, nothing more rejected
    assert judge_quality(df.limit(0), spark.createDataFrame([], LABEL)).count() == 0


def test_held_out_accuracy(spark):
    """Odd labelled ids train, even ones are judged."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = judge_quality(spark.read.parquet(f"{sf}/documents.parquet"), labels.filter("doc_id % 2 = 1"))
    seen = got.filter("p_low IS NOT NULL").select("doc_id", "p_low").join(labels.filter("doc_id % 2 = 0"), "doc_id").collect()
    low = np.array([r.quality == 0 for r in seen])
    p = np.array([r.p_low for r in seen])
    assert 0.03 < low.mean() < 0.5
    order = p.argsort().argsort()
    auc = (order[low].mean() - order[~low].mean()) / len(p) + 0.5
    assert auc > 0.95, auc
    assert (p[~low] >= 0.5).mean() < 0.02 and (p[low] >= 0.5).mean() > 0.8, ((p[~low] >= 0.5).mean(), (p[low] >= 0.5).mean())
    assert abs(p.mean() - low.mean()) < 0.03       # calibrated in the large


def test_null_and_repeated_labels(spark):
    data = [(i, "good words here and there " * 9 + str(i) if i % 3 else "BUY!! NOW!! " * 20 + str(i), "en", "s", 1) for i in range(200)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 0, 0), (5, None, None), (7, 1, 1)]
    got = judge_quality(spark.createDataFrame(data, DOC), spark.createDataFrame(labels, LABEL)).collect()
    assert len(got) == 200 and all(0 <= r.p_low <= 1 for r in got)
    assert {r.p_low >= 0.5 for r in got if r.doc_id % 3} == {False} and {r.p_low >= 0.5 for r in got if r.doc_id % 3 == 0} == {True}


def test_platt_recovers_a_logistic():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 3, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.7 * z - 1)))).astype(float)
    a, b = platt(z, y)
    assert a == pytest.approx(0.7, abs=0.05) and b == pytest.approx(-1, abs=0.08)


def test_every_label_up_to_4000_is_used(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.training_rows(spark.read.parquet(f"{sf}/documents.parquet"), labels, "doc_id", "text", "doc_id", "quality")
    n = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id").distinct().count()
    assert 2000 < n < 4000 and len(rows) == n


def test_blocks_do_not_change_the_model(spark, monkeypatch):
    data = [(i, " ".join("w%d" % (i * j % 97) for j in range(60)) + (" buy now" if i % 3 == 0 else ""), "en", "s", 1) for i in range(200)]
    args = (spark.createDataFrame(data, DOC), spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], LABEL),
            "doc_id", "text", "doc_id", "quality")
    whole = quality.train(quality.training_rows(*args))
    monkeypatch.setattr(quality, "BLOCK", 1000)
    assert len(quality.blocks(quality.training_rows(*args))) > 10
    parts = quality.train(quality.training_rows(*args))
    assert np.allclose(whole["weights"], parts["weights"], atol=1e-4) and parts["slope"] == pytest.approx(whole["slope"], rel=1e-3)


def test_a_rare_class_is_seen(spark, monkeypatch):
    """Of 900 labels 6 are low and the 50 of least hash hold none: the classifier still learns them, at their share."""
    monkeypatch.setattr(quality, "SAMPLE", 50)
    monkeypatch.setattr(quality, "LEAST_OF_A_CLASS", 40)
    ids = spark.range(900).select("id", F.xxhash64("id").alias("h")).orderBy("h").collect()
    low = {r.id for r in ids[-6:]}
    data = [(i, ("BUY!! NOW!! " * 20 if i in low else "good words here and there " * 9) + str(i), "en", "s", 1) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i not in low), 0) for i in range(900)] + [(9999, 0, 0)], LABEL)
    rows = quality.training_rows(spark.createDataFrame(data, DOC), labels, "doc_id", "text", "doc_id", "quality")
    assert sum(r.y == 0 for r in rows) == 6 and 50 <= len(rows) <= 130 and {(r.y, r["of"]) for r in rows} == {(0, 6), (1, 894)}
    got = judge_quality(spark.createDataFrame(data, DOC), labels).collect()
    p = {r.doc_id: r.p_low for r in got}
    assert min(p[i] for i in low) > max(p[i] for i in range(900) if i not in low)


def test_characters_not_bytes():
    """Runs of four characters of any script; equal characters have equal values."""
    texts = ["aéa", "日本語日本語", "🙂🙂", "", "abcd"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    v, at = quality.characters(data, off)
    assert np.diff(at).tolist() == [len(t) for t in texts]
    chars = "".join(texts)
    assert all((v[i] == v[j]) == (chars[i] == chars[j]) for i in range(len(chars)) for j in range(len(chars)))
    broken = np.array([0x80, 0x80, 0x61, 0xFF], np.uint8)
    assert np.diff(quality.characters(broken, np.array([0, 2, 4]))[1]).tolist() == [1, 2]
