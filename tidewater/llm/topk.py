"""Exact top-k inner products over norm-sorted blocks.

Candidates are range-partitioned and sorted by descending length and written as blocks. Queries are put in groups
of similar reach: a query's threshold is the length a candidate needs, by Cauchy-Schwarz, to reach the k-th best score
that the query has among the ``head`` longest vectors, and a group's is the least of its queries'. A block goes to the
groups whose threshold its longest vector reaches and to no others, before anything is joined. A task reads one
group and its share of the blocks, the longest vectors first, as a stream, and keeps the k best of every query:

* where |q| |c| of a block's longest vector falls below the k-th best, the query is done with it;
* what remains is rotated by the leading right singular vectors of the head; the partial sum over these directions plus
  the product of the residual lengths bounds the score;
* only pairs whose bound reaches the k-th best are scored, exactly, in integers.

A task holds one group (``group`` queries) and one block. Shuffled are the blocks times the groups they can matter
to, of at most ``group`` queries each, and k rows per query and share. The head (at most ``HEAD_BYTES``), its leading
directions (``LEADING`` a dimension) and one number per group come to the driver. The result is exact whatever
the groups and blocks.

Defined results: vectors that are null or hold null or non-finite components take no part, as query
or as candidate; vectors are scored against those of their own dimension only; ties go to the smaller
vec_id; rows are told apart by their place, not by id: of rows with one vec_id each is a query, each answered, and each is a
candidate of the others; components and scores beyond the range of a long stop at its ends; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, new_stage, ready, shuffle_width

LEADING = 16
EXACT = float(1 << 53)
#: Most bytes of the longest vectors that are sent to all tasks.
HEAD_BYTES = 16 << 20
#: Blocks that a task reads for one group.
BLOCKS_PER_TASK = 64
#: What a bound may lose to rounding, of the product of the lengths.
SLACK = 1e-7


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id, v (array of long), norm (double); rows that take no part are left out."""
    v = F.col(vec_col)
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & fit).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def matrix(rows: list) -> np.ndarray:
    return np.array(rows, np.int64).reshape(len(rows), -1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products, clipped to the range of a long."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    largest = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(c.astype(np.float64)).max()) * q.shape[1]
    if largest < EXACT:     # sums of integers below 2^53 are exact in doubles
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    full = q.astype(object) @ c.astype(object).T
    return np.clip(full, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every row as double; minus infinity where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k].astype(np.float64)


def leading_directions(head: np.ndarray) -> np.ndarray:
    """The right singular vectors of the greatest singular values, as columns."""
    return np.linalg.svd(head.astype(np.float64), full_matrices=False)[2][:LEADING].T if head.size else np.zeros((head.shape[1], 0))


class Group:
    """The queries of one group and the k best of each so far."""

    def __init__(self, uid: np.ndarray, q: np.ndarray, start: np.ndarray, turn: np.ndarray, k: int):
        self.uid, self.q, self.k, self.turn = uid, q, k, turn
        self.best = start.copy()        # scores that the k-th best is known to reach
        wide = q.astype(np.float64)
        self.norm = np.sqrt((wide ** 2).sum(1))
        self.lead = wide @ turn
        self.rest = np.sqrt(np.maximum(0, self.norm ** 2 - (self.lead ** 2).sum(1)))
        none = np.zeros(0, np.int64)
        self.kept = (none, none, none, none)            # query, score, vec_id, uid of the candidate
        self.scored = 0

    def read(self, cuid: np.ndarray, cid: np.ndarray, c: np.ndarray, norm: np.ndarray, step: int = 256) -> None:
        """One block, by descending norm."""
        found = [self.kept]
        for a in range(0, len(c), step):
            reach = self.norm * norm[a]
            live = np.flatnonzero(reach + SLACK * (1 + reach) >= self.best)
            if not len(live):
                break
            part = c[a:a + step]
            wide = part.astype(np.float64)
            lead = wide @ self.turn
            rest = np.sqrt(np.maximum(0, norm[a:a + step] ** 2 - (lead ** 2).sum(1)))
            bound = self.lead[live] @ lead.T + self.rest[live, None] * rest[None, :] + SLACK * (1 + reach[live, None])
            bound = np.maximum(bound, -float(1 << 63))      # where the least scores stop
            near = (bound >= self.best[live, None]) & (self.uid[live, None] != cuid[None, a:a + step])
            rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(rows):
                continue
            self.scored += len(rows) * len(cols)
            score = products(self.q[live[rows]], part[cols])
            # the k-th best is a double: of scores beyond 2^53 what ties with it as a double stays
            i, j = np.nonzero(near[np.ix_(rows, cols)] & (score.astype(np.float64) >= self.best[live[rows], None]))
            found.append((live[rows[i]], score[i, j], cid[a + cols[j]], cuid[a + cols[j]]))
            if sum(len(x[0]) for x in found[1:]) >= self.k * len(self.q):
                self.kept = self.keep(found)
                found = [self.kept]
        self.kept = self.keep(found)

    def keep(self, found: list) -> tuple:
        """The k best of every query, ties to the smaller vec_id and uid."""
        i, s, c, u = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((u, c, ~s, i))               # ~s falls as s rises, also at the ends of a long
        i, s, c, u = i[order], s[order], c[order], u[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        last = place == self.k - 1
        self.best[i[last]] = np.maximum(self.best[i[last]], s[last].astype(np.float64))
        ok = place < self.k
        return i[ok], s[ok], c[ok], u[ok]


BLOCK = "dim int, ids binary, n_asks int, asks binary, block binary, norms binary, longest double"


def packed_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one dimension, in the order of the partition; ``asks``: which are queries."""
    def packed(batches):
        new_stage()
        for b in batches:
            ids, norms, asks = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            v = b.column(1)
            dims = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(dims)])
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                for i in range(0, len(mine), size):
                    m = mine[i:i + size]
                    block = flat[at[m][:, None] + np.arange(d)[None, :]].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d)], pa.int32()), pa.array([ids[m].astype(np.int64).tobytes()]), pa.array([int(asks[m].sum())], pa.int32()),
                         pa.array([asks[m].astype(bool).tobytes()]), pa.array([block.tobytes()]), pa.array([norms[m].astype(np.float64).tobytes()]), pa.array([float(norms[m[0]])])],
                        names=[x.split()[0] for x in BLOCK.split(", ")])

    return rows.select("vec_id", "v", "norm", "asks").mapInArrow(packed, BLOCK)


#: Rows are known by their block's number and their place in it. A number is the task that wrote the block (below 2^21) and
#: which of its blocks it is (below 2^22).
PLACE_BITS, TASK_BLOCK_BITS = 20, 22
QUERIES = "dim int, uid long, vec_id long, v binary, start double, reach double"
GROUPS = "dim int, reach double, uids binary, ids binary, block binary, starts binary"
FOUND = "q_uid long, query_id long, score long, vec_id long, uid long"


def uids(number: int, n: int) -> np.ndarray:
    return (number << PLACE_BITS) + np.arange(n)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
                       vec_col: str = "embedding", head: int = 2048, block: int = 2048, group: int = 8192) -> DataFrame:
    """Per query its k best: query_id, rank, vec_id, score. ``is_query`` is over the column ``vec_id``."""
    spark = vectors.sparkSession
    ready(spark)
    if block >= 1 << PLACE_BITS:
        raise ValueError(f"a block holds fewer than {1 << PLACE_BITS} vectors")
    rows = integer_vectors(vectors, id_col, vec_col, scale).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    ordered = rows.repartitionByRange(shuffle_width(spark), F.desc("norm")).sortWithinPartitions(F.desc("norm"))
    number = F.monotonically_increasing_id()        # the task in the bits from 33 on
    blocks = packed_blocks(ordered, block).withColumn("number", F.shiftleft(F.shiftright(number, 33), TASK_BLOCK_BITS) + number.bitwiseAND((1 << 33) - 1))
    blocks = materialise(blocks, "topk-blocks")

    widest, n_blocks, n_asked = blocks.agg(F.max("dim"), F.count(F.lit(1)), F.sum("n_asks")).first()
    head = max(1, min(head, HEAD_BYTES // (8 * max(1, widest or 1))))
    heads = spark.sparkContext.broadcast(longest_vectors(blocks, head))
    turns = spark.sparkContext.broadcast({d: leading_directions(v) for d, (_, v) in heads.value.items()})

    def asked(batches):
        new_stage()
        schema = pa.schema([("dim", pa.int32()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("v", pa.binary()), ("start", pa.float64()),
                            ("reach", pa.float64())])
        for b in batches:
            for r in b.to_pylist():
                asks, dim = np.frombuffer(r["asks"], bool), r["dim"]
                q = np.frombuffer(r["block"], np.int64).reshape(len(asks), dim)[asks]
                uid, norm = uids(r["number"], len(asks))[asks], np.frombuffer(r["norms"], np.float64)[asks]
                hid, hv = heads.value.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
                score = products(q, hv).astype(np.float64)
                score[uid[:, None] == hid[None, :]] = -np.inf
                start = kth_best(score, k)
                with np.errstate(divide="ignore", invalid="ignore"):    # the length a candidate needs
                    reach = np.where((start > 0) & (norm > 0), (start * (1 - SLACK) - 1) / norm / (1 + SLACK), -np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), dim, np.int32)), pa.array(uid), pa.array(np.frombuffer(r["ids"], np.int64)[asks]),
                     pa.array([x.tobytes() for x in q], pa.binary()), pa.array(start), pa.array(reach)], schema=schema)

    def grouped(batches):
        new_stage()
        for b in batches:
            dims = b.column(0).to_numpy()
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                for i in range(0, len(mine), group):
                    m = pa.array(mine[i:i + group])
                    col = lambda n: b.column(n).take(m).to_numpy(zero_copy_only=False)  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d)], pa.int32()), pa.array([float(col(5).min())]), pa.array([col(1).tobytes()]), pa.array([col(2).tobytes()]),
                         pa.array([b"".join(b.column(3).take(m).to_pylist())]), pa.array([col(4).tobytes()])], names=[x.split()[0] for x in GROUPS.split(", ")])

    wanted = blocks.filter("n_asks > 0").select("number", "dim", "ids", "asks", "block", "norms").mapInArrow(asked, QUERIES)
    alike = wanted.repartitionByRange(max(1, -(-int(n_asked or 0) // group)), "dim", "reach").sortWithinPartitions("dim", "reach")
    groups = materialise(alike.mapInArrow(grouped, GROUPS).withColumn("g", F.monotonically_increasing_id()), "topk-groups")

    shares = max(1, -(-int(n_blocks) // BLOCKS_PER_TASK))
    known = {}
    for r in groups.select("dim", "reach", "g").orderBy("dim", "reach", "g").collect():
        known.setdefault(r.dim, []).append((r.reach, r.g))
    none = [F.lit(None).cast("binary")]
    sent = None
    for dim, mine in known.items():
        reached = F.array_size(F.filter(F.array(*[F.lit(x) for x, _ in mine]), lambda x: x <= F.col("longest")))
        to = F.explode(F.slice(F.array(*[F.lit(g) for _, g in mine]), F.lit(1), reached)).alias("g")
        one = blocks.filter(F.col("dim") == dim).select("dim", F.pmod(F.xxhash64("number"), F.lit(shares)).cast("int").alias("share"), "number",
                                                        "longest", "ids", "block", "norms", to)
        sent = one if sent is None else sent.unionByName(one)
    queries = groups.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(
        "g", "share", "dim", F.lit(float("inf")).alias("longest"), F.lit(-1).cast("long").alias("number"), "ids", "block", "uids", "starts",
        none[0].alias("norms"))
    if sent is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sent = sent.withColumn("uids", none[0]).withColumn("starts", none[0]).select(*queries.columns)
    stream = queries.unionByName(sent).repartition(shuffle_width(spark), "g", "share").sortWithinPartitions("g", "share", F.desc("longest"), "number")

    def search(batches):
        new_stage()
        now, at = None, None

        def result():
            i, s, c, u = now.kept
            return pa.RecordBatch.from_arrays([pa.array(now.uid[i]), pa.array(now.ids[i]), pa.array(s), pa.array(c), pa.array(u)],
                                              names=[x.split()[0] for x in FOUND.split(", ")])

        for b in batches:
            for r in range(b.num_rows):
                g, share, dim, _, number, ids, body, uid, starts, norms = (x[r].as_py() for x in b.columns)
                if uid is not None:
                    if now is not None:
                        yield result()
                    uid = np.frombuffer(uid, np.int64)
                    now, at = Group(uid, np.frombuffer(body, np.int64).reshape(len(uid), dim), np.frombuffer(starts, np.float64),
                                    turns.value.get(dim, np.zeros((dim, 0))), k), (g, share)
                    now.ids = np.frombuffer(ids, np.int64)
                else:
                    assert at == (g, share)
                    ids = np.frombuffer(ids, np.int64)
                    now.read(uids(number, len(ids)), ids, np.frombuffer(body, np.int64).reshape(len(ids), dim), np.frombuffer(norms, np.float64))
        if now is not None:
            yield result()

    found = stream.mapInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("q_uid").orderBy(F.desc("score"), "vec_id", "uid"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def longest_vectors(blocks: DataFrame, head: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(uids, vectors) of the ``head`` longest vectors, by dimension: found by the lengths alone, then read from their blocks."""
    def lengths(batches):
        new_stage()
        for b in batches:
            for number, norms in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                norms = np.frombuffer(norms, np.float64)[:head]         # a block's longest come first
                yield pa.RecordBatch.from_arrays([pa.array(uids(number, len(norms))), pa.array(norms)], names=["uid", "norm"])

    best = blocks.select("number", "norms").mapInArrow(lengths, "uid long, norm double").orderBy(F.desc("norm"), "uid").limit(head)
    wanted = np.sort(np.array([r.uid for r in best.collect()], np.int64))

    def vectors(batches):
        new_stage()
        for b in batches:
            for number, dim, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                mine = wanted[wanted >> PLACE_BITS == number]
                v = np.frombuffer(body, np.int64).reshape(-1, dim)[mine & ((1 << PLACE_BITS) - 1)] if dim else np.zeros((len(mine), 0), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), dim, np.int32)), pa.array(mine), pa.array([x.tobytes() for x in v], pa.binary())],
                                                 names=["dim", "uid", "v"])

    few = blocks.filter(F.col("number").isin(np.unique(wanted >> PLACE_BITS).tolist())).select("number", "dim", "block")
    out = {}
    for r in few.mapInArrow(vectors, "dim int, uid long, v binary").collect():
        out.setdefault(r.dim, []).append(r)
    return {d: (np.array([r.uid for r in x], np.int64), np.stack([np.frombuffer(r.v, np.int64) for r in x]).reshape(len(x), d)) for d, x in out.items()}
