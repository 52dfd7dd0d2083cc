"""Quality rules: word and line statistics, then a hashed n-gram classifier.

The classifier is a logistic regression over hashed features: words, pairs of words and runs of four
characters (code points), each kind as its mean over the text, so that a text's length has no weight. It is trained on a
bounded sample of labelled rows, whose features are made by the executors: the ``SAMPLE`` of least id hash and, so that a rare
class is seen, the ``LEAST_OF_A_CLASS`` of least id hash of each class; a row weighs what brings its class back to its share
of all labels. The last ``HELD_OUT`` share of each class calibrates the score to a probability (Platt). Texts are
scored in Arrow batches; a text is rejected where the probability of low quality reaches
``REJECT_FROM``. Statistics and scores cover every whole text.

Words and lines are compared by 64-bit hashes.

Defined results: a null or empty text has no words and fails the base rules; an unlabelled table, or one with fewer than two
labelled documents of a class, rejects nothing beyond the base rules; a document labelled more than
once counts with its lowest label; rows are judged each on its own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BYTE_VALUE, STEP_FACTORS, U, mixed, prefix_hashes, powers, ranges, spans, word_values
from .common import IS_SPACE, materialise, new_stage, pieces, ready, utf8_buffer, word_bounds

#: Labelled rows that the classifier sees at most, and the share of them kept for calibration.
SAMPLE, HELD_OUT = 4000, 0.25
#: Labelled rows of each class that are taken at least, where there are as many.
LEAST_OF_A_CLASS = 500
#: Features that one step of the training on the driver holds in wide numbers.
BLOCK = 1 << 20
#: A text is rejected from this probability of low quality on.
REJECT_FROM = 0.5
BITS = 16
KINDS = 3
#: Means of hashed features are small; this brings them to the scale of the bias.
GAIN = 30.0

MIN_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True


def by_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of true elements of every text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def statistics(data: np.ndarray, off: np.ndarray, starts, ends, word_off, words) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every text."""
    n_words = np.diff(word_off)
    chars = by_text(((data & 0xC0) != 0x80) & ~IS_SPACE[data], off)
    symbols = by_text(IS_SYMBOL[data], off)

    # lines: each newline ends one, and so does the end of the text
    ends_line = np.concatenate([np.flatnonzero(data == 0x0A), off[1:]])
    doc = np.concatenate([np.searchsorted(off, ends_line[:-len(n_words) or None], side="right") - 1, np.arange(len(n_words))]) \
        if len(n_words) else np.zeros(0, np.int64)
    order = np.lexsort((ends_line, doc))
    ends_line, doc = ends_line[order], doc[order]
    first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
    begin = np.where(first, off[doc], np.r_[0, ends_line[:-1] + 1]) if len(doc) else ends_line
    has_word = np.searchsorted(starts, ends_line) > np.searchsorted(starts, begin)
    begin, ends_line, doc = begin[has_word], ends_line[has_word], doc[has_word]
    sums = prefix_hashes(BYTE_VALUE[data])
    line = (sums[ends_line] - sums[begin]) * powers(max(1, len(data)))[1][np.minimum(begin, max(0, len(data) - 1))]
    key = mixed(line + (ends_line - begin).astype(U) * STEP_FACTORS[1] + doc.astype(U) * STEP_FACTORS[2])
    different = np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=len(n_words)) if len(doc) else 0
    dup_lines = np.bincount(doc, minlength=len(n_words)) - different if len(doc) else np.zeros(len(n_words), np.int64)

    repeated = np.zeros(len(words), bool)
    k = len(words) - REPEAT_WINDOW + 1
    if k > 0:
        h = np.zeros(k, U)
        for i in range(REPEAT_WINDOW):
            h += words[i:i + k] * STEP_FACTORS[i]
        text = np.searchsorted(word_off, np.arange(len(words)), side="right") - 1
        whole = np.flatnonzero(text[:k] == text[REPEAT_WINDOW - 1:])
        key = mixed(h[whole] + text[whole].astype(U) * STEP_FACTORS[9])
        _, at, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = whole[count[at] > 1]
        delta = np.zeros(len(words) + 1, np.int64)
        delta[twice] += 1
        delta[twice + REPEAT_WINDOW] -= 1
        repeated = np.cumsum(delta[:-1]) > 0
    return [n_words, chars, symbols, dup_lines, by_text(repeated, word_off)]


def features(data: np.ndarray, off: np.ndarray, word_off, words) -> list[tuple[np.ndarray, np.ndarray]]:
    """By kind: the hashed feature at every place, and the n+1 offsets by text (a feature across two texts is left out)."""
    mask = U((1 << BITS) - 1)
    out = [((words & mask).astype(np.int64), word_off)]
    pair = ((mixed(words[:-1] * STEP_FACTORS[4] + words[1:]) & mask).astype(np.int64) + (1 << BITS)) if len(words) > 1 else np.zeros(0, np.int64)
    out.append(without_crossing(pair, word_off, 2))
    v, char_off = characters(data, off)
    if len(v) >= 4:
        two = v[:-1] * STEP_FACTORS[5] + v[1:]
        four = (mixed(two[:-2] * STEP_FACTORS[6] + two[2:]) & mask).astype(np.int64) + (2 << BITS)
    else:
        four = np.zeros(0, np.int64)
    out.append(without_crossing(four, char_off, 4))
    return out


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A value for every character (its bytes as a number, hashed), and the n+1 character offsets by text."""
    begin = (data & 0xC0) != 0x80
    begin[off[:-1][off[:-1] < len(data)]] = True        # a text begins with a character whatever its bytes
    starts = np.flatnonzero(begin)
    wide = BYTE_VALUE[data[starts]]
    size = np.diff(starts, append=len(data))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        wide[more] = wide[more] * STEP_FACTORS[7] + BYTE_VALUE[data[starts[more] + k]]
    return wide, np.searchsorted(starts, off)


def without_crossing(at: np.ndarray, off: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.maximum(0, np.diff(off) - span + 1)
    return at[spans(off[:-1], size)], np.concatenate([[0], np.cumsum(size)])


def mean_weights(weights: np.ndarray, kinds) -> np.ndarray:
    """The linear part of the score of every text."""
    score = 0.0
    for at, off in kinds:
        total = np.concatenate([[0.0], np.cumsum(weights[at])])
        n = np.diff(off)
        score = score + (total[off[1:]] - total[off[:-1]]) / np.maximum(1, n)
    return GAIN * score


def analysed(batch_text):
    """Pieces of a batch: (first text, last + 1, data, offsets, word bounds and hashes)."""
    data, off = utf8_buffer(batch_text)
    for i, j in pieces(data, off, 1 << 19):
        part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, word_off = word_bounds(part, o)
        yield part, o, starts, ends, word_off, word_values(part, starts, ends)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label_id: str, label: str) -> list:
    """Label, size of the label's class (``of``) and sparse features of the sampled labelled documents; bounded by ``SAMPLE`` and two
    times ``LEAST_OF_A_CLASS``. The executors write them, the driver reads one partition at a time."""
    known = labels.filter(F.col(label).isNotNull() & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id")) \
        .agg(F.min(label).cast("int").alias("y")).join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    known = materialise(known.withColumn("y", (F.col("y") != 0).cast("int")).withColumn("h", F.xxhash64("id")), "quality-labels")
    least = [known.filter(F.col("y") == y).orderBy("h", "id").limit(LEAST_OF_A_CLASS) for y in (0, 1)]
    sample = known.orderBy("h", "id").limit(SAMPLE).unionByName(least[0]).unionByName(least[1]).distinct()
    sample = sample.join(F.broadcast(known.groupBy("y").agg(F.count(F.lit(1)).alias("of"))), "y").select("id", "y", "h", "of")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")

    def made(batches):
        new_stage()
        for b in batches:
            ys, hs, ofs, n = b.column(1), b.column(2), b.column(3), 0
            for part, o, _, _, word_off, words in analysed(b.column(4)):
                kinds = features(part, o, word_off, words)
                index, value = [], []
                for d in range(len(o) - 1):
                    uni = [np.unique(at[f[d]:f[d + 1]], return_counts=True) for at, f in kinds]
                    index.append(np.concatenate([u for u, _ in uni]).astype(np.int32).tobytes())
                    value.append(np.concatenate([c / max(1, c.sum()) for _, c in uni]).astype(np.float32).tobytes())
                k = len(o) - 1
                yield pa.RecordBatch.from_arrays([ys.slice(n, k), hs.slice(n, k), ofs.slice(n, k), pa.array(index, pa.binary()),
                                                  pa.array(value, pa.binary())], names=["y", "h", "of", "at", "value"])
                n += k

    rows = materialise(texts.select("id", "y", "h", "of", "text").mapInArrow(made, "y int, h long, of long, at binary, value binary"), "quality-features")
    return sorted(rows.toLocalIterator(), key=lambda r: (r.h, r.y, r.at))


def blocks(rows: list) -> list[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``BLOCK`` features: (rows, their sizes, columns, values). ``rows`` is emptied on the way."""
    size = np.array([len(r.at) // 4 for r in rows], np.int64)
    out = []
    for a, b in ranges((np.cumsum(size) - size) // BLOCK):
        col = np.concatenate([np.frombuffer(r.at, np.int32) for r in rows[a:b]])
        val = np.concatenate([np.frombuffer(r.value, np.float32) for r in rows[a:b]]) * np.float32(GAIN)
        rows[a:b] = [None] * (b - a)
        out.append((slice(a, b), size[a:b], col, val))
    return out


def scores(part: list, n: int, w: np.ndarray) -> np.ndarray:
    """The linear part of the score of the ``n`` rows of some blocks."""
    z = np.zeros(n)
    for at, size, col, val in part:
        total = np.concatenate([[0.0], np.cumsum(val * w[col], dtype=np.float64)])
        end = np.cumsum(size)
        z[at] = total[end] - total[end - size]
    return z


def train(rows: list, rounds: int = 120, ridge: float = 1e-4) -> dict | None:
    """Logistic regression of low quality (label 0) by full-batch adaptive gradients, then Platt calibration on the rows held out."""
    classes = [[i for i, r in enumerate(rows) if (r.y == 0) == is_low] for is_low in (True, False)]
    if min(map(len, classes)) < 2:
        return None
    kept = sorted(i for c in classes for i in c[:len(c) - max(1, int(len(c) * HELD_OUT))])
    cut, chosen = len(kept), set(kept)
    order = kept + [i for i in range(len(rows)) if i not in chosen]
    rows[:] = [rows[i] for i in order]
    low = np.array([r.y == 0 for r in rows], np.float64)
    # a row weighs the share of its class among all labels over that among the sampled ones
    of = {y: next(r["of"] for r in rows if (r.y == 0) == y) for y in (True, False)}
    n = {True: len(classes[0]), False: len(classes[1])}
    weight = np.array([of[x] / (of[True] + of[False]) * len(rows) / n[x] for x in (low > 0).tolist()])
    held = rows[cut:]
    del rows[cut:]
    train_on, calibrate_on = blocks(rows), blocks(held)
    w, bias = np.zeros(KINDS << BITS), 0.0
    m1, m2, b1, b2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = scores(train_on, cut, w) + bias
        gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - low[:cut]) * weight[:cut] / weight[:cut].sum()
        g, gb = ridge * w, gap.sum()
        for at, size, col, val in train_on:
            g += np.bincount(col, val * np.repeat(gap[at].astype(np.float32), size), minlength=len(w))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
        fix1, fix2, rate = 1 - 0.9 ** t, 1 - 0.999 ** t, 0.05
        w -= rate * (m1 / fix1) / (np.sqrt(m2 / fix2) + 1e-8)
        bias -= rate * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
    z = scores(calibrate_on, len(low) - cut, w) + bias
    slope, shift = platt(z, low[cut:], weight[cut:])
    return {"weights": w.astype(np.float32), "bias": bias, "slope": slope, "shift": shift}


def platt(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and shift of the logistic that fits the weighted outcomes, by Newton's method on smoothed targets."""
    w = np.ones(len(y)) if weight is None else weight
    pos, neg = (w * y).sum(), (w * (1 - y)).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        d, h = w * (p - target), w * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (d * score).sum() + 1e-6 * a, d.sum()
        haa, hab, hbb = (h * score * score).sum() + 1e-6, (h * score).sum(), h.sum() + 1e-6
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_low double"


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label_id: str = "doc_id",
                  label: str = "quality", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept, p_low (null where not trained), then ``carry``."""
    spark = docs.sparkSession
    ready(spark)
    model = train(training_rows(docs, labels, id_col, text, label_id, label))
    keep = docs.select(F.col(id_col).alias("doc_id"), *carry)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep.schema) + ", " + COLUMNS
    names = [*keep.columns, *[x.split()[0] for x in COLUMNS.split(", ")]]

    def judge(batches):
        new_stage()
        for b in batches:
            n = 0
            for part, o, starts, ends, word_off, words in analysed(b.column(b.num_columns - 1)):
                k = len(o) - 1
                stats = statistics(part, o, starts, ends, word_off, words)
                failed = (stats[0] < MIN_WORDS) | (100 * stats[4] > MOST_REPEATED * stats[0])
                if model is None:
                    p = pa.nulls(k, pa.float64())
                    kept = ~failed
                else:
                    z = mean_weights(model["weights"], features(part, o, word_off, words)) + model["bias"]
                    p = 1 / (1 + np.exp(-np.clip(model["slope"] * z + model["shift"], -30, 30)))
                    kept = ~failed & (p < REJECT_FROM)
                    p = pa.array(p)
                yield pa.RecordBatch.from_arrays([*[c.slice(n, k) for c in b.columns[:-1]], *[pa.array(s.astype(np.int64)) for s in stats],
                                                  pa.array(failed), pa.array(kept), p], names=names)
                n += k

    return docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text).alias("__text")).mapInArrow(judge, schema)
