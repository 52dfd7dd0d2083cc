"""N-gram Jaccard join by T-occurrence search.

Two texts link when the Jaccard similarity of their sets of 5-word shingles is at least ``percent``
/ 100. The links that are found are those that make the components: of a group of near copies, whose links are
as many as the square of its texts, enough to join it. Copies are never expanded into pairs.

1. Equal texts are one class, reduced in every Arrow batch before the shuffle. Classes are dealt by
   hash into groups of a few MB; everything below is on classes.
2. Document frequencies: groups send their distinct shingles (bucket and 32 bits of the hash) to
   buckets, which return the frequencies above 1. A text links only if it shares ``percent`` of its own
   shingles, so a text with more unique ones is done: clean prose ends here. Shingle hashes that fall
   together only make frequencies larger, which drops nothing.
3. What remains is ordered by (frequency, hash). Two linked texts share a shingle in their prefixes of
   n - ceil(n * percent / 100) + 1; prefixes go to buckets as inverted lists. Round one takes from each list only the
   pairs of one centre (the text with fewest unique shingles among those of compatible size) with the
   others; after the components of its links are known, round two takes all pairs of a list that are
   still in different components, if sizes admit it and, were this their first common shingle, what
   follows it in both reaches T. (Linked texts do have a first one.)
4. Pairs are dealt to shards, where each is kept once, and a shard is cut into parts whose sets have about
   PART_SHINGLES shingles: parts are as many as the pairs need, whatever the size of a group of near copies.
   In its part a pair meets its shingle sets and is decided exactly by T-occurrence search over the centre's shingles: the inverted lists of its candidates are cut by
   DivideSkip into long ones and short ones, the short lists are merged and counted, and only candidates that
   reach T less the number of long lists are probed in those by binary search. (The lists of step 3 give the candidates:
   lists of whole sets in one place would shuffle every set once for each of its shingles.)

A link's text may be any of its class; component ids are the least document id of all classes joined.

Defined results: a null text or one without words has an empty set, links with nothing and is its own
component; fewer than five words make one shingle; a null id counts as the largest in a component;
rows with one id and different texts each belong to their text's component; an empty table gives no
rows. Worst case: a list whose texts share frequent shingles only and never link costs all its pairs, in time and
shuffle; memory is bounded by the group, the bucket and the part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .anchors import STEP_FACTORS, U, mixed, ranges, spans, word_values
from .common import WORD, materialise, new_stage, pieces, ready, utf8_buffer, word_bounds
from .components import components

SHINGLE = 5
BUCKET_SHINGLES = 2_000_000
PART_SHINGLES = 4_000_000
PENDING_PAIRS = 1_000_000
SALT = 4
MU = 0.01
POSTING = np.dtype([("low", "<u4"), ("n", "<i4"), ("place", "<i4"), ("single", "<i4"), ("uid", "<i8"), ("label", "<i8")])
PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOW = U(0xFFFFFFFF)


def need(n, percent: int):
    """Least overlap of a text of n shingles with any it links with."""
    return -(-n * percent // 100)


def overlap_needed(n, m, percent: int):
    """T: the least intersection of linked sets of n and m shingles; 100 i >= percent (n + m - i)."""
    return -(-(n + m) * percent // (100 + percent))


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and the n+1 offsets."""
    data = LOWER[data]
    starts, ends, word_off = word_bounds(data, off)
    w = word_values(data, starts, ends)
    n = len(w)
    h = np.zeros(n, U)
    for i in range(size):
        h[:n - i] += w[i:] * STEP_FACTORS[3 + i]
    h = mixed(h)
    out, sizes = [], np.zeros(len(off) - 1, np.int64)
    for d, (a, b) in enumerate(zip(word_off[:-1].tolist(), word_off[1:].tolist(), strict=True)):
        if b - a >= size:
            s = np.sort(h[a:b - size + 1])
            s = s[np.r_[True, s[1:] != s[:-1]]]
        elif b > a:     # the whole sequence as one shingle, unlike any of full size
            s = mixed(np.array([sum(int(x) * int(STEP_FACTORS[8 + i]) for i, x in enumerate(w[a:b])) + b - a & (1 << 64) - 1], U))
        else:
            continue
        out.append(s)
        sizes[d] = len(s)
    return np.concatenate(out) if out else np.zeros(0, U), np.concatenate([[0], np.cumsum(sizes)])


def bucketed(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket (high half) and 32 bits of the hash (low half): how shingles are counted and listed."""
    return ((h >> U(32)) % U(n_buckets) << U(32)) | (h & LOW)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """__g, key, text of every text that is not null, once per Arrow batch."""
    def reduce(batches):
        new_stage()
        for b in batches:
            first = {k: i for i, k in zip(range(b.num_rows - 1, -1, -1), reversed(b.column(1).to_pylist()), strict=True)}
            yield b.take(pa.array(sorted(first.values()), pa.int64()))

    rows = docs.filter("text IS NOT NULL").select("__g", "key", "text")
    return rows.mapInArrow(reduce, "__g int, key binary, text string")


def group_sets(t: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Keys in order, and the shingle sets of a group's distinct texts."""
    new_stage()
    keys = t.column("key").to_pylist()
    first = {k: i for i, k in zip(range(len(keys) - 1, -1, -1), reversed(keys), strict=True)}
    order = sorted(first)
    data, off = utf8_buffer(t.column("text").take(pa.array([first[k] for k in order], pa.int64())))
    parts, sizes = [], [np.zeros(1, np.int64)]
    for i, j in pieces(data, off):
        h, o = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
        parts.append(h)
        sizes.append(np.diff(o))
    return order, np.concatenate([np.zeros(0, U), *parts]), np.cumsum(np.concatenate(sizes))


def rows_of(names: str, rows: list[tuple]) -> pa.Table:
    """A table of the DDL schema ``names``."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    cols = [x.split() for x in names.split(",")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(cols)], names=[n for n, _ in cols])


COUNTED = "to int, g int, lows binary, counts binary"
FREQUENT = "__g int, bucket int, lows binary, counts binary"
SETS = "key binary, uid long, n long, single int, prefix binary, hashes binary"
DEALT = "to int, pairs binary, sizes binary"
PARTS = "part long, pairs binary"


def count_in_group(t: pa.Table, n_buckets: int) -> pa.Table:
    _, h, _ = group_sets(t)
    k, c = np.unique(bucketed(h, n_buckets), return_counts=True)
    to = (k >> U(32)).astype(np.int64)
    return rows_of(COUNTED, [(int(to[a]), t.column(0)[0].as_py(), (k[a:b] & LOW).astype("<u4").tobytes(),
                              b"" if c[a:b].max() == 1 else c[a:b].astype("<u4").tobytes()) for a, b in ranges(to)])


def count_in_bucket(t: pa.Table) -> pa.Table:
    lows = [np.frombuffer(x, "<u4") for x in t.column("lows").to_pylist()]
    counts = [np.frombuffer(x, "<u4") if x else np.ones(len(low), "<u4") for x, low in
              zip(t.column("counts").to_pylist(), lows, strict=True)]
    g, low = np.repeat(np.array(t.column("g").to_pylist(), np.int64), [len(x) for x in lows]), np.concatenate(lows)
    n, bucket = np.concatenate(counts).astype(np.int64), t.column("to")[0].as_py()
    order = np.argsort(low, kind="stable")
    cut = np.flatnonzero(np.r_[True, low[order][1:] != low[order][:-1]])
    total = np.add.reduceat(n[order], cut)
    df = np.empty(len(low), np.int64)
    df[order] = np.repeat(total, np.diff(np.r_[cut, len(low)]))
    keep = np.flatnonzero(df > 1)
    keep = keep[np.lexsort((low[keep], g[keep]))]
    return rows_of(FREQUENT, [(int(g[keep[a]]), bucket, low[keep[a:b]].tobytes(), df[keep[a:b]].astype("<i8").tobytes())
                              for a, b in ranges(g[keep])])


def ordered_sets(t: pa.Table, back: pa.Table, n_buckets: int, percent: int) -> pa.Table:
    """One row per distinct text; shingles only where enough of them occur elsewhere."""
    if not t.num_rows:
        return rows_of(SETS, [])
    keys, h, off = group_sets(t)
    known = sorted(zip(back.column("bucket").to_pylist(), back.column("lows").to_pylist(), back.column("counts").to_pylist(), strict=True))
    table = np.concatenate([np.zeros(0, U)] + [np.frombuffer(x, "<u4").astype(U) | U(b << 32) for b, x, _ in known])
    often = np.concatenate([np.zeros(0, np.int64)] + [np.frombuffer(c, "<i8") for _, _, c in known])
    df = np.ones(len(h), np.int64)
    if len(table):
        k = bucketed(h, n_buckets)
        at = np.minimum(np.searchsorted(table, k), len(table) - 1)
        df[table[at] == k] = often[at[table[at] == k]]
    shared = np.concatenate([[0], np.cumsum(df > 1)])
    base, rows = t.column(0)[0].as_py() << 32, []
    for i, key in enumerate(keys):
        a, b = int(off[i]), int(off[i + 1])
        n, m = b - a, int(shared[b] - shared[a])
        if n and m >= need(n, percent):
            order = np.lexsort((h[a:b], df[a:b]))
            s = h[a:b][order]
            rows.append((key, base + i, n, n - m, s[n - m:n - need(n, percent) + 1].tobytes(), s.tobytes()))
        else:
            rows.append((key, base + i, n, n - m, None, None))
    return rows_of(SETS, rows)


def listed(batches, n_buckets: int):
    """Prefixes to inverted lists, packed by bucket. Columns: uid, n, single, prefix, label."""
    for b in batches:
        uid, n, single, label = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4))
        pre = [np.frombuffer(x, U) for x in b.column(3).to_pylist()]
        size = np.array([len(x) for x in pre])
        k = bucketed(np.concatenate([np.zeros(0, U), *pre]), n_buckets)
        p = np.empty(len(k), POSTING)
        p["low"] = k & LOW
        for name, x in (("n", n), ("single", single), ("uid", uid), ("label", label)):
            p[name] = np.repeat(x, size)
        p["place"] = spans(single.astype(np.int64), size)
        to = (k >> U(32)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        yield from rows_of("to int, postings binary", [(int(to[order[x]]), p[order[x:y]].tobytes()) for x, y in ranges(to[order])]).to_batches()


def pairs_of(p: np.ndarray, everything: bool, percent: int) -> np.ndarray:
    """Candidate pairs of one bucket's lists."""
    if not len(p):
        return np.zeros(0, PAIR)
    p = p[np.lexsort((p["uid"], p["single"], p["low"]))]
    out, pending = [], 0
    for a, b in ranges(p["low"]):
        if pending > PENDING_PAIRS:     # pairs of several lists are kept once
            out, pending = [distinct_pairs(np.concatenate(out))], 0
        one = p[a:b]
        if b - a < 2 or (one["label"] == one["label"][0]).all():
            continue
        if everything:
            for i in range(len(one) - 1):
                x, y = one[i], one[i + 1:]
                lo, hi = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
                reach = np.minimum(x["n"] - x["place"], y["n"] - y["place"])    # as if this were the first shingle they share
                ok = (y["label"] != x["label"]) & (100 * lo >= percent * hi) & (reach >= overlap_needed(x["n"].astype(np.int64), y["n"], percent))
                out.append(joined(x["uid"], y["uid"][ok]))
                pending += len(out[-1])
        else:
            left = one
            while len(left) > 1:        # the first is the centre of all whose sizes admit a link with it
                x, y = left[0], left[1:]
                lo, hi = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
                ok = 100 * lo >= percent * hi
                out.append(joined(x["uid"], y["uid"][ok]))
                pending += len(out[-1])
                left = y[~ok]
    if not out:
        return np.zeros(0, PAIR)
    return distinct_pairs(np.concatenate(out))


def distinct_pairs(p: np.ndarray) -> np.ndarray:
    p = p[np.lexsort((p["b"], p["a"]))]
    return p[np.r_[True, (p["a"][1:] != p["a"][:-1]) | (p["b"][1:] != p["b"][:-1])]] if len(p) else p


def joined(a, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(b), PAIR)
    out["a"], out["b"] = a, b
    return out


def shard_of(pairs: np.ndarray, n_shards: int) -> np.ndarray:
    salt = mixed(pairs["b"].astype(U)) % U(SALT)
    return (mixed(pairs["a"].astype(U) * U(SALT) + salt) % U(n_shards)).astype(np.int64)


def parts_of(p: np.ndarray, n: np.ndarray, percent: int, most: int) -> list[np.ndarray]:
    """The distinct pairs of a shard, by centre, in parts whose sets have about ``most`` shingles; ``n``: sizes of the sets of b."""
    order = np.lexsort((p["b"], p["a"]))
    p, n = p[order], n[order].astype(np.int64)
    new = np.r_[True, p["a"][1:] != p["a"][:-1]]
    keep = new | np.r_[True, p["b"][1:] != p["b"][:-1]]
    p, n, new = p[keep], n[keep], new[keep]
    load = np.cumsum(n + np.where(new, 100 * n // max(1, percent), 0))      # a centre's set is larger than b's by that at most
    return [p[x:y] for x, y in ranges((load - n) // most)]


def occurrence_search(centre: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Overlap of the sorted set ``centre`` with each sorted set that reaches its T; 0 for the others."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    t = overlap_needed(len(centre), sizes, percent)
    text = np.repeat(np.arange(m), sizes)
    flat = np.concatenate(sets)
    at = np.minimum(np.searchsorted(centre, flat), len(centre) - 1)
    ok = centre[at] == flat
    lists = np.argsort(at[ok], kind="stable")       # inverted lists, ordered by shingle and text
    which, who = at[ok][lists], text[ok][lists]
    length = np.bincount(which, minlength=len(centre))
    # DivideSkip: so many of the longest lists are only probed, for texts that the short ones bring within reach
    n_long = max(0, min(int(t.min() / (MU * np.log2(max(2, length.max(initial=1))) + 1)), int(t.min()) - 1, len(centre)))
    long = np.argsort(-length, kind="stable")[:n_long]
    is_long = np.zeros(len(centre), bool)
    is_long[long] = True
    merged = np.sort(who[~is_long[which]], kind="stable")           # ascending runs: a merge of the short lists
    first = np.flatnonzero(np.r_[True, merged[1:] != merged[:-1]]) if len(merged) else np.zeros(0, np.int64)
    count = np.zeros(m, np.int64)
    count[merged[first]] = np.diff(np.r_[first, len(merged)])
    near = merged[first]
    near = near[count[near] >= t[near] - n_long]
    if len(near) and n_long:
        place = which * m + who                                     # ascending: a list is a range of it, probed by halving
        probes = long[:, None] * m + near[None, :]
        found = np.minimum(np.searchsorted(place, probes), len(place) - 1)
        count[near] += (place[found] == probes).sum(0)
    out = np.zeros(m, np.int64)
    out[near] = np.where(count[near] >= t[near], count[near], 0)
    return out


def decide(pairs: pa.Table, sets: pa.Table, percent: int) -> pa.Table:
    if not pairs.num_rows:
        return rows_of("a long, b long", [])
    p = np.concatenate([np.frombuffer(x, PAIR) for x in pairs.column("pairs").to_pylist()])
    have = {u: np.sort(np.frombuffer(x, U)) for u, x in zip(sets.column("uid").to_pylist(), sets.column("hashes").to_pylist(), strict=True)}
    a, b = [], []
    for x, y in ranges(p["a"]):
        for c in range(x, y, 2048):
            others = p["b"][c:min(y, c + 2048)]
            ok = others[occurrence_search(have[int(p["a"][x])], [have[int(o)] for o in others], percent) > 0]
            a.append(np.full(len(ok), p["a"][x], np.int64))
            b.append(ok)
    return pa.Table.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def linked(sets: DataFrame, labels: DataFrame | None, n_buckets: int, percent: int) -> DataFrame:
    """One round: verified links (a, b) between texts of different labels."""
    again, most = labels is not None, PART_SHINGLES
    src = sets.filter("prefix IS NOT NULL AND octet_length(prefix) > 0").select("uid", "n", "single", "prefix")
    if not again:
        src = src.withColumn("label", F.col("uid"))
    else:
        src = src.join(labels.select(F.col("v").alias("uid"), "label"), "uid", "left") \
                 .withColumn("label", F.coalesce("label", "uid"))
    lists = src.select("uid", "n", "single", "prefix", "label").mapInArrow(
        lambda b: listed(b, n_buckets), "to int, postings binary")

    def candidates(t: pa.Table) -> pa.Table:
        postings = np.concatenate([np.frombuffer(x, POSTING) for x in t.column("postings").to_pylist()])
        p = pairs_of(postings, again, percent)
        uids, first = np.unique(postings["uid"], return_index=True)
        n = postings["n"][first][np.searchsorted(uids, p["b"])]
        to = shard_of(p, n_buckets)
        order = np.argsort(to, kind="stable")
        return rows_of(DEALT, [(int(to[order[x]]), p[order[x:y]].tobytes(), n[order[x:y]].tobytes()) for x, y in ranges(to[order])])

    def cut(t: pa.Table) -> pa.Table:
        p, n = (np.concatenate([np.frombuffer(x, kind) for x in t.column(c).to_pylist()]) for c, kind in (("pairs", PAIR), ("sizes", "<i4")))
        base = t.column("to")[0].as_py() << 32
        return rows_of(PARTS, [(base + i, x.tobytes()) for i, x in enumerate(parts_of(p, n, percent, most))])

    def wanted(batches):
        for b in batches:
            for part, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = np.frombuffer(x, PAIR)
                u = np.unique(np.concatenate([p["a"], p["b"]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), part)), pa.array(u)], names=["part", "uid"])

    dealt = lists.groupBy("to").applyInArrow(candidates, DEALT)
    pairs = materialise(dealt.groupBy("to").applyInArrow(cut, PARTS), "jaccard-pairs")
    asked = pairs.mapInArrow(wanted, "part long, uid long")
    sent = asked.join(sets.select("uid", "hashes").filter("hashes IS NOT NULL"), "uid").select("part", "uid", "hashes")
    return materialise(pairs.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(
        lambda p, s: decide(p, s, percent), "a long, b long"), "jaccard-links")


def text_classes(docs: DataFrame, percent: int) -> DataFrame:
    """key, n, label of every distinct text with words: its number of shingles and its component. ``docs``: text, key."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_groups, n_buckets = max(1, -(-total // anchors.GROUP_BYTES)), max(8, int(total // 6 // BUCKET_SHINGLES))
    by_group = distinct_texts(docs.withColumn("__g", F.pmod(F.xxhash64("key"), F.lit(n_groups)).cast("int"))).groupBy("__g")
    counted = by_group.applyInArrow(lambda t: count_in_group(t, n_buckets), COUNTED)
    frequent = counted.groupBy("to").applyInArrow(count_in_bucket, FREQUENT)
    sets = materialise(by_group.cogroup(frequent.groupBy("__g")).applyInArrow(
        lambda t, back: ordered_sets(t, back, n_buckets, percent), SETS), "jaccard-sets")

    links = linked(sets, None, n_buckets, percent)
    labels = components(links, "a", "b")
    more = linked(sets, labels, n_buckets, percent)
    labels = components(links.unionByName(more), "a", "b")

    texts = sets.filter("n > 0").select("key", "uid", "n")
    return texts.join(labels.select(F.col("v").alias("uid"), "label"), "uid", "left") \
                .select("key", "n", F.coalesce("label", "uid").alias("label"))


def keyed_by_text(docs: DataFrame, id_col: str, text: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), *carry, F.unhex(F.md5(F.col(text).cast("binary"))).alias("key"))


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    ready(docs.sparkSession)
    keyed = keyed_by_text(docs, id_col, text)
    texts = text_classes(keyed, percent)
    ids = keyed.select("doc_id", "key")
    least = ids.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least")).join(texts, "key")
    whole = least.groupBy("label").agg(F.min("least").alias("component"))
    by_key = least.join(whole, "label").select("key", "n", "component")
    return ids.join(by_key, "key", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def one_per_component(docs: DataFrame, carry: tuple[str, ...], percent: int = 75) -> DataFrame:
    """doc_id, text and ``carry`` of the least row of every component: least id (null the largest), then least text and ``carry``.
    Components are of rows, not of ids; rows without words are in none and all stay."""
    ready(docs.sparkSession)
    keyed = keyed_by_text(docs, "doc_id", "text", carry)
    texts = text_classes(keyed.select("text", "key"), percent)
    # the rows of every text that have its least id
    ids = keyed.filter("key IS NOT NULL").groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    first = ids.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rows")).alias("f")) \
        .select("key", "f.*").join(texts.select("key", "label"), "key")
    head = first.groupBy("label").agg(F.min("doc_id").alias("head"))
    heads = materialise(first.join(head, "label").filter("doc_id <=> head").select("key", "label", "head", "rows"), "jaccard-heads")
    several = heads.groupBy("label").agg(F.sum("rows").alias("n")).filter("n > 1").select("label")

    def rows(of: DataFrame) -> DataFrame:
        of = of.select(F.col("key").alias("k"), "head", "label")
        return keyed.join(of, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", *carry, "label")

    names = ["doc_id", "text", *carry]
    single = rows(heads.join(several, "label", "left_anti")).select(*names)
    least = rows(heads.join(several, "label", "left_semi")).groupBy("label").agg(F.min(F.struct(*names)).alias("r")).select("r.*")
    wordless = docs.filter(F.col("text").isNull() | ~F.col("text").rlike(WORD)).select(*names)
    return single.unionByName(least).unionByName(wordless)
