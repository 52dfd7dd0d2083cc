"""Packing: tokens come back whole and in order, windows hold the mixture, ranks are a bijection."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm.common import utf8_buffer
from tidewater.llm.packing import Service, cut, pack, tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def reference_tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def check(got, rows, length):
    """Every id in exactly one piece; windows gapless and full but the last."""
    ids = reference_tokenizer()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {r[0] for r in rows}
    for d, text, *_ in rows:
        want, at = ids(text), 0
        ps = sorted(by_doc[d], key=lambda r: r.start)
        for p in ps:
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want)
            part = np.array(want[at:at + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes())
            if "ids" in p:
                assert p.ids == part.tolist()
            at += p.length
        assert at == len(want)
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for j, w in windows.items():
        at = 0
        for o, n in sorted(w):
            assert o == at
            at += n
        assert at == length if j < len(windows) - 1 else 0 < at <= length


def corpus(n=300):
    rng = np.random.default_rng(1)
    out = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, "word " * 30_000, "en", "b", 1),
           (3, "<|endoftext|> Ünï<|startoftext|>x  <|END", "en", "c", 1), (4, "a b C\x1cd 日本 'S it's", "en", "c", 1)]
    out += [(i, " ".join("w%d" % x for x in rng.integers(0, 50, rng.integers(0, 200))), "en", ["a", "b", "b", "b", None][rng.integers(0, 5)], 1)
            for i in range(10, n)]
    return out


def test_pack(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, DOC).withColumns({"ids": F.lit(1), "block": F.lit(2), "sizes": F.lit("x")}).repartition(5)
    got = pack(df, PATH, length=256).collect()
    check(got, rows, 256)
    assert pack(df.limit(0), PATH).count() == 0
    # every window holds every source's share
    total, share = 0, defaultdict(int)
    for r in got:
        share[r.source] += r.length
        total += r.length
    last = max(r.sequence_id for r in got)
    have = defaultdict(int)
    for r in got:
        have[r.sequence_id, r.source] += r.length
    for j in range(last):
        for s, n in share.items():
            assert abs(have[j, s] - 256 * n / total) <= len(share)


def test_pack_to_targets(spark):
    rows = [r for r in corpus(200) if r[3] in ("a", "b")]
    got = pack(spark.createDataFrame(rows, DOC), PATH, length=128, targets={"a": 3, "b": 1}).collect()
    check(got, rows, 128)
    have = defaultdict(int)
    for r in got:
        have[r.sequence_id, r.source] += r.length
    full = sum(n for (_, s), n in have.items() if s == "a") // 96 - 1
    assert full > 3 and all(abs(have[j, "a"] - 96) <= 2 for j in range(full))


def test_repeated_rows(spark):
    rows = [(5, "one two three", "en", "a", 1)] * 3 + [(None, "four", "en", "a", 1)]
    got = pack(spark.createDataFrame(rows, DOC), PATH).collect()
    assert sorted((r.doc_id or -1, r.start, r.length) for r in got) == [(-1, 0, 2)] + [(5, 0, 4)] * 3


def test_whole_texts_equal_words(spark):
    ids = reference_tokenizer()
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    got, off = tokenizer(PATH).encode(*utf8_buffer(pa.array(texts)), 2)
    assert all(got[off[i]:off[i + 1]].tolist() == ids(t) for i, t in enumerate(texts))


@pytest.mark.parametrize("totals,weights", [([5, 1, 0, 9], None), ([100, 3, 57], None), ([40, 30, 50], [1.0, 2.0, 0.5]), ([7], None)])
def test_service_is_a_bijection(totals, weights):
    s = Service(totals, weights)
    src = np.repeat(np.arange(len(totals)), totals)
    t = np.concatenate([np.arange(n) for n in totals])
    rank = s.rank(src, t)
    assert sorted(rank.tolist()) == list(range(sum(totals)))
    served = s.served(np.arange(sum(totals) + 3))
    for j in range(sum(totals) + 3):
        assert served[j].tolist() == [int(((src == k) & (rank < j)).sum()) for k in range(len(totals))]


def test_service_beyond_64_bits():
    """10^13 tokens: ranks next to each other are told apart."""
    totals = [7_000_000_000_003, 3_000_000_000_019, 999_999_999_989]
    s = Service(totals)
    first = np.array([6_999_999_000_000, 2_999_999_000_000, 999_999_000_000])
    src = np.repeat(np.arange(3), 1000)
    t = np.concatenate([f + np.arange(1000) for f in first])
    rank = s.rank(src, t)
    assert len(set(rank.tolist())) == 3000

    def exact(a, b):
        c = 0
        for o, n in enumerate(totals):
            x = (2 * b + 1) * n - totals[a]
            c += b if o == a else (x // (2 * totals[a]) + 1 if o < a else -(-x // (2 * totals[a])))
        return c
    assert all(exact(int(a), int(b)) == int(r) for a, b, r in list(zip(src, t, rank, strict=True))[::97])
    doc, start, size, window, offset = cut(s, np.array([0]), np.array([6_999_999_000_000]), np.array([9000]), 4096)
    assert size.sum() == 9000 and (np.diff(window) == 1).all() and (offset + size <= 4096).all()


def test_words_equal_whole_texts_on_odd_characters():
    import random
    rng = random.Random(3)
    ids = reference_tokenizer()
    alphabet = list("aAjJkK zZ09 ,.;:!?'\"<|>\t\n\x0b\x0c\x1c\x85\u00a0") + ["\u030c", "\u0301", "\u0338", "é", "É", "ß", "Σ", "ς", "İ", "K", "日",
                "\u3099", "🙂", "\u200d", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "a, b. ", "word,", "Word."]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    got, off = tokenizer(PATH).encode(*utf8_buffer(pa.array(texts)), 2)
    for i, t in enumerate(texts):
        assert got[off[i]:off[i + 1]].tolist() == ids(t), repr(t)


def odd_texts(n=1500):
    import random
    rng = random.Random(4)
    words = ["w%d" % i for i in range(300)] + ["été", "straße", "日本", "İx", "a.b", "ok,", "ok", "!!", "x!", "é,", "9.", "<b>", "don't", "ǅ", "ﬁn"]
    return [rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randint(0, 20))) for _ in range(n)]


def in_blocks(t, texts, size):
    return [x for k in range(0, len(texts), size) for x in t.encode(*utf8_buffer(pa.array(texts[k:k + size])), 2)[0].tolist()]


@pytest.mark.parametrize("cache", [0, 5, 60, 10_000])
def test_word_table_forgets_without_a_trace(monkeypatch, cache):
    from tidewater.llm import packing
    monkeypatch.setattr(packing, "WORD_CACHE", cache)
    ids, texts = reference_tokenizer(), odd_texts()
    t = packing.WordTokenizer(PATH)
    assert in_blocks(t, texts, 40) == [i for x in texts for i in ids(x)]
    assert len(t.table) <= cache + 400


def test_words_of_one_hash_are_told_apart(monkeypatch):
    """Hashes cut to four bits: every word meets others of its hash."""
    from tidewater.llm import packing
    whole = packing.word_values
    monkeypatch.setattr(packing, "word_values", lambda *a: whole(*a) & np.uint64(15))
    ids, texts = reference_tokenizer(), odd_texts(300)
    t = packing.WordTokenizer(PATH)
    assert in_blocks(t, texts, 20) == [i for x in texts for i in ids(x)]
    assert len(t.table) <= 16


def test_windows_in_order_of_service(spark):
    """The windows of the query's path, sources in many blocks and repeated, against tokens sorted by their virtual times."""
    from fractions import Fraction
    rows = [(i, "tok " * (i % 7 + 1), "en", "abca"[i % 4], 1) for i in range(60)]
    got = pack(spark.createDataFrame(rows, DOC).repartition(7), PATH, length=16).collect()
    total = defaultdict(int)
    for r in got:
        total[r.source] += r.length
    order = sorted((Fraction(2 * t + 1, 2 * n), s) for s, n in total.items() for t in range(n))
    want = defaultdict(int)
    for k, (_, s) in enumerate(order):
        want[k // 16, s] += 1
    have = defaultdict(int)
    for r in got:
        have[r.sequence_id, r.source] += r.length
    assert have == want
