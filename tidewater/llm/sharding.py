"""Sharding by proportional stratified interleaving (DataFrame operations only).

Rows of each source are put in a seeded random order; a row of rank r among the n rows of its
source stands at the fraction (2r - 1) / 2n. Sorting all rows by that fraction interleaves the
sources in proportion, so any cut of the sorted order holds the mixture up to one row per source.
The sorted order is cut into shards whose row counts differ by at most one.

Both ranks are counted without a hot task: a row's rank is its row number inside a bucket of the
order (top bits of the hash, slices of the fraction) plus the rows of the buckets before it, which
come from a small table of bucket counts. A source that holds a third of all rows spreads over all
its buckets.

Defined results: null sources are a source of their own; a null text has no bytes (checksum 0);
repeated rows are all placed, each once; equal keys are told apart by hash, id and checksum, and
whole equal rows are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interleave(rows: DataFrame, source: str, order: list[str], rank: str, total: str,
               seed: int, rank_bits: int = 10, slices: int = 4096) -> DataFrame:
    """Add the 0-based place ``rank`` of each row in the interleaved order, and the number of rows
    as ``total``. ``order``: columns that tell rows of a source apart, hashed with ``seed``."""
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    h = F.xxhash64(F.lit(seed), *order)
    r = rows.withColumn("__h", h).withColumn("__b", F.shiftrightunsigned("__h", 64 - rank_bits).cast("int"))
    r = r.withColumn("__s", F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")))
    sizes = r.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select(
        "__s", "__b", F.coalesce(F.sum("__n").over(before("__s").orderBy("__b")), F.lit(0)).alias("__off"),
        F.sum("__n").over(Window.partitionBy("__s")).alias("__all"))
    in_bucket = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__h", *order))
    r = r.withColumn("__i", in_bucket).join(starts, ["__s", "__b"])
    r = r.withColumn("__f", (2 * (F.col("__off") + F.col("__i")) - 1) / (2 * F.col("__all")))
    r = r.withColumn("__k", F.least(F.floor(F.col("__f") * slices), F.lit(slices - 1)).cast("int"))
    cuts = r.groupBy("__k").agg(F.count(F.lit(1)).alias("__m"))
    cuts = cuts.select(     # at most `slices` rows: one task
        "__k", F.coalesce(F.sum("__m").over(before().orderBy("__k")), F.lit(0)).alias("__before"),
        F.sum("__m").over(Window.partitionBy()).alias(total))
    place = F.row_number().over(Window.partitionBy("__k").orderBy("__f", "__s", "__h", *order))
    r = r.withColumn("__j", place).join(cuts, "__k")
    return r.withColumn(rank, F.col("__before") + F.col("__j") - 1) \
            .drop("__h", "__b", "__s", "__off", "__all", "__i", "__f", "__k", "__before", "__j")


def shard(docs: DataFrame, n_shards: int = 24, seed: int = 20, id_col: str = "doc_id", source: str = "source",
          text: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                       (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    placed = interleave(rows, "source", ["doc_id", "text_crc32"], "__g", "__total", seed)
    k = F.expr(f"CAST((__g * {n_shards}L) DIV __total AS INT)")
    first = F.expr(f"((__shard * __total) + {n_shards - 1}L) DIV {n_shards}L")
    return placed.withColumn("__shard", k).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("__shard").alias("shard"),
        (F.col("__g") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
