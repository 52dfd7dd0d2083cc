"""Relational building blocks shared by the models.

Design rules (100 TB, 1000 executors):
* "first row per key" is an aggregation (``min_by`` on a NULLS-LAST order struct), never a window:
  partial aggregation runs map-side, so a key holding a third of all rows costs no hot task.
* exact ranks (``row_number``) that are output columns use ``row_number_skew_safe``: slices of the
  order spread a hot key over many tasks, offsets come from counts per (key, slice).
* outer joins on a nullable key spread the NULL keys (which can never match) over all partitions
  instead of hashing them all into one task.
* nothing is broadcast unless its size is bounded by construction; everything else is left to
  AQE's runtime size check (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_
from ..session import write_table

NULL_KEY_PREFIX = "\u0000null:"


def order_struct(order: Sequence) -> Column:
    """Ascending NULLS LAST sort key as one orderable struct (T4: Postgres sorts NULLs last)."""
    parts = []
    for i, o in enumerate(order):
        c = col_(o)
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str]) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order) = 1`` as one aggregation.

    ``order`` must end with a unique tie-breaker for a deterministic answer. NULL keys form one
    group, as in a window. Output: keys + cols.
    """
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), order_struct(order)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols])


#: Slices that the order of all rows is cut into; a task of the ranking sees about this part of one key at most.
MOST_SLICES = 1024


def as_number(df: DataFrame, name: str) -> Column:
    """A number that rises with the column: microseconds, the number itself, or the first seven bytes of a text."""
    kind, c = df.schema[name].dataType.typeName(), F.col(name)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        zero = F.lit("1970-01-01").cast("date" if kind == "date" else kind)
        return F.date_diff(c, zero).cast("long") if kind == "date" else F.timestamp_diff("MICROSECOND", zero, c)
    if kind == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long")
    return c.cast("double")


def bounds_below(value: Column, bounds: list) -> Column:
    """How many of the ascending bounds are at most the value, by halving."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    held = F.array(*[F.lit(b) for b in bounds])
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(held, at + step - 1) <= value), at + step).otherwise(at))


def quantiles(df: DataFrame, value: Column, n: int) -> list:
    """About n - 1 values that cut the rows into n equal parts, from a sketch; a value that holds several parts comes several times."""
    parts = [i / n for i in range(1, n)]
    return df.select(value.alias("v")).agg(F.percentile_approx("v", F.array(*[F.lit(x) for x in parts]), 10 * n)).first()[0] or []


def order_slice(df: DataFrame, order: Sequence[str], n: int) -> Column:
    """A coarse, monotone function of the order, from the data: quantiles of the first order column, and inside single values of it
    that hold more than a part of all rows, quantiles of the second. The quantiles, 2 n numbers, come to the driver."""
    first = as_number(df, order[0])
    bounds = quantiles(df, first, n)
    hot = sorted({x for x, y in zip(bounds, bounds[1:], strict=False) if x == y})
    inner = F.lit(0)
    if hot and len(order) > 1:
        second = as_number(df, order[1])
        is_hot = F.array_contains(F.array(*[F.lit(x) for x in hot]), first)
        inside = quantiles(df.filter(is_hot), second, n)
        # what follows a hot value in its slice comes behind it; NULLs of the second column come last
        inner = F.when(is_hot, F.coalesce(bounds_below(second, inside), F.lit(len(inside) + 1))).otherwise(len(inside) + 2)
    return F.when(first.isNotNull(), F.struct(bounds_below(first, bounds).alias("i"), F.coalesce(inner, F.lit(0)).alias("j")))


def row_number_skew_safe(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int | None = None,
                         written: bool = False) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY keys ORDER BY order NULLS LAST)`` (bigint) without a hot task.

    One path for all sizes. The order is cut into slices of about equally many rows (see ``order_slice``; NULLs of the
    first column last). A row's number is its number inside (key, slice), plus the rows of the key's earlier slices, which
    come from an aggregation reduced map-side. A key that holds a third of all rows is spread over its
    slices, also where these rows fall into one hour or one instant; a window over a key only ever sees one row per slice.
    The frame is written once, unless the caller has (``written``), and the ranked frame is shuffled once: the window and
    the join share their key. ``order`` must end with a unique tie-breaker (ties are arbitrary in the reference).
    """
    df = df if written else write_table(df, "ranked-input")
    n = slices or max(2, min(MOST_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    piece = order_slice(df, order, n)
    ord_sort = [col_(o).asc_nulls_last() for o in order]
    # a struct compares NULL fields as equal, so a NULL key is one group in the window and in the join alike
    cells = df.withColumn("_cell", F.struct(*[F.col(k) for k in keys], piece.isNull().alias("_late"), piece.alias("_slice")))
    counts = cells.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*[F.col(f"_cell.{k}") for k in keys]).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_cell").orderBy(*ord_sort))
    out = cells.withColumn("_i", inside).join(offsets, "_cell")
    return out.withColumn(name, F.col("_off") + F.col("_i")).drop("_cell", "_i", "_off")


def as_of(asked: DataFrame, known: DataFrame, key: str, at: str, since: str, value: str) -> DataFrame:
    """``asked`` with ``value``: of its key's ``known`` rows the one of greatest ``since`` <= ``at`` (of equal ones the greatest value);
    NULL where there is none, or where key or time is NULL.

    A row meets the values of its own day, not the key's history: known rows are reduced to the last of each (key, day),
    which a window over the days of a key - as many as the calendar has - carries to the days that are asked. What changes inside
    an asked day becomes intervals of validity. So the rows that the join reads do not grow with the history, a
    key that a third of all rows ask for is a join key (which AQE splits) and nowhere a window of its rows."""
    day = lambda c: F.date_trunc("day", F.col(c)).cast("date")
    rows = asked.withColumn("_day", day(at))
    known = known.filter(F.col(key).isNotNull() & F.col(since).isNotNull()).select(key, F.col(since).alias("_from"), F.col(value).alias("_v"))
    known = known.groupBy(key, "_from").agg(F.max("_v").alias("_v")).withColumn("_day", day("_from"))
    days = rows.filter(F.col(key).isNotNull() & F.col("_day").isNotNull()).select(key, "_day").distinct()
    last = known.groupBy(key, "_day").agg(F.max(F.struct("_from", "_v")).alias("_last"))
    both = last.withColumn("_is", F.lit(False)).unionByName(days.withColumn("_is", F.lit(True)), allowMissingColumns=True) \
        .groupBy(key, "_day").agg(F.max("_last").alias("_last"), F.max("_is").alias("_is"))
    before = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_c", F.last("_last", ignorenulls=True).over(before)).filter("_is AND _c IS NOT NULL") \
        .select(key, "_day", F.col("_c._from").alias("_from"), F.col("_c._v").alias("_v"))
    inside = known.join(days, [key, "_day"], "left_semi").select(key, "_day", "_from", "_v")
    slices = carried.unionByName(inside)
    ends = F.lead("_from").over(Window.partitionBy(key, "_day").orderBy("_from"))
    valid = slices.withColumn("_until", ends).withColumnsRenamed({key: "_k", "_day": "_d"})
    meets = (F.col(key) == F.col("_k")) & (F.col("_day") == F.col("_d")) & (F.col(at) >= F.col("_from")) \
        & (F.col("_until").isNull() | (F.col(at) < F.col("_until")))
    return rows.join(valid, meets, "left").select(*asked.columns, F.col("_v").alias(value))


def spread_null_key(key, salt) -> Column:
    """Join key for an outer join whose NULL keys never match: NULLs get a unique, never-matching
    value so they hash over all partitions instead of one. ``salt`` must be unique-ish per row."""
    return F.coalesce(col_(key).cast("string"),
                      F.concat(F.lit(NULL_KEY_PREFIX), col_(salt).cast("string")))


def left_join_nullable(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       salt: str) -> DataFrame:
    """``left LEFT JOIN right ON left.left_key = right.right_key`` where ``left_key`` is often NULL.

    The right key column is dropped (its value equals the left key wherever a row matched)."""
    r = right.withColumn("_jk", F.col(right_key).cast("string")).drop(right_key)
    return left.withColumn("_jk", spread_null_key(left_key, salt)).join(r, "_jk", "left").drop("_jk")


def anti_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``df LEFT JOIN other ON key WHERE other.key IS NULL``: rows with a NULL key survive.

    Catalyst keeps the outer join + filter of the SQL form; ``left_anti`` is written explicitly.
    The key set is deduplicated first (partial aggregation shrinks the shuffle)."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def left_join_or_keys(left: DataFrame, dim: DataFrame, left_key: str, dim_keys: Sequence[str]) -> DataFrame:
    """``LEFT JOIN dim ON left.k = dim.a OR left.k = dim.b`` as a hash equi-join.

    Each dimension row is exploded into its distinct keys, so it matches a left row at most once,
    exactly like the disjunction; a nested-loop join is avoided."""
    keyed = dim.withColumn("_dk", F.explode(F.array_distinct(F.array(*[F.col(k) for k in dim_keys]))))
    keyed = keyed.filter(F.col("_dk").isNotNull())
    return left.join(keyed, left[left_key] == keyed["_dk"], "left").drop("_dk")


def least_chain(cols: Sequence) -> list[Column]:
    """Monotone back-fill: stage i becomes ``least(stage_i, ..., stage_n)``."""
    cs = [col_(c) for c in cols]
    return [F.least(*cs[i:]) if len(cs[i:]) > 1 else cs[i] for i in range(len(cs))]
