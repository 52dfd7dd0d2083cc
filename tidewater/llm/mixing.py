"""Mixing sources to target weights by entropy balancing.

Targets: sources in code point order (null last) get the weights in turn and share ``share`` of all
sizes; a target stops at ``cap`` times its source's size and the excess is shared again by weight,
which is water-filling: target = min(cap * size, level * weight).

Rates: every document has a tilt (1 unless a column is named), which says how readily its rate moves. The rates closest
to 1 in relative entropy, a document weighing its tokens over its tilt, that give every source its target and
stay below the cap are exponentially tilted, rate = min(cap, exp(lambda_source * tilt)), and lambda solves the convex
dual. Newton's method runs on the dual, between bounds that every iteration narrows (a step that leaves them goes to the bound or halves them): each
iteration is one distributed aggregation of tilted mass and curvature over the histogram of (source, tilt), and
only the largest remaining error comes to the driver. An error is raised if that has not fallen below ``TOLERANCE`` after
``MAX_ITERATIONS``. With the default tilt every document of a source has the same rate, log lambda = target / size.

Copies: rates are rounded systematically. In every source documents stand from the largest to the
smallest; a document's copies are the integers that the running sum of rates passes in it, shifted
by a phase. Running sums of rates and of copies never differ by 1, so a source's words differ from
its target by less than the largest document; of ``phases`` phases the one nearest to the target is
taken. Copies never exceed the cap. Running sums are whole numbers of 2^-40, so they do not depend on the order of
addition, and reruns agree.

Running sums are counted in cells - slices of the order (by size, and by hash where a size holds many rows) of
about equally many documents, found by quantiles - plus the sums of the cells before, so a source or a size
that holds a third of all rows is spread; rows that are equal are one row with a count until the end.

Defined results: a null text or one without words has size 0 and is taken 0 times; a null source is a
source of its own; repeated rows are mixed each on its own; a tilt that is null, not finite or not above 0 counts as 1; an empty
table gives no rows; a target of 0 takes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.relational import order_slice
from .common import materialise, shuffle_width, word_counts

MAX_ITERATIONS = 100
TOLERANCE = 1e-10
#: One, in the running sums of rates.
ONE = 1 << 40


def water_levels(sources: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """``sources``: __s (sortable key), source_size. Adds target. One row per source, ranked in one task."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy("__s")) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("ceiling", cap * F.col("source_size"))
    s = s.withColumn("ratio", F.col("ceiling") / F.col("w"))
    order = Window.orderBy("ratio", "__s")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (share * F.sum("source_size").over(Window.partitionBy())
                               - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # the first source, by ratio, whose ceiling is not reached sets the level
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "__s", "level"))).over(Window.partitionBy())
    s = s.withColumn("target", F.least(F.col("ceiling"), level["level"] * F.col("w")))
    return s.withColumn("target", F.coalesce("target", F.col("ceiling"))).select("__s", "source_size", "target")


def entropy_rates(histogram: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Newton on the dual. ``histogram``: __s, tilt, tokens; ``targets``: __s, target (at most cap * tokens). Returns __s, lam."""
    sums = histogram.groupBy("__s").agg(F.sum("tokens").alias("size"), F.min("tilt").alias("least"))
    state = targets.filter("target > 0").join(sums, "__s").select(
        "__s", "target", F.lit(0.0).alias("lam"), F.least(F.lit(0.0), F.log(F.col("target") / F.col("size")) / F.col("least")).alias("lo"),
        (F.log(F.lit(float(cap))) / F.col("least")).alias("hi"))
    state = materialise(state, "entropy-dual")
    lam, hi, lo = F.col("lam"), F.col("hi"), F.col("lo")
    for _ in range(MAX_ITERATIONS):
        rate = F.exp(lam * F.col("tilt"))
        open_ = rate < cap
        sums = histogram.join(state, "__s").groupBy("__s", "target", "lam", "lo", "hi").agg(
            F.sum(F.col("tokens") * F.least(rate, F.lit(float(cap)))).alias("mass"),
            F.sum(F.when(open_, F.col("tokens") * F.col("tilt") * rate).otherwise(0.0)).alias("slope"))
        gap = F.col("target") - F.col("mass")
        error = F.when(hi - lo <= 1e-15 * (1 + F.abs(hi)), 0.0).otherwise(F.abs(gap / F.col("target")))
        sums = sums.withColumn("error", error).withColumn("lo", F.when(gap > 0, lam).otherwise(lo)).withColumn("hi", F.when(gap > 0, hi).otherwise(lam))
        step = lam + F.try_divide(gap, F.col("slope"))      # all capped: no slope
        # a step beyond the upper bound, where all rates are capped or which was too far before, stops there
        inner = F.when((step > F.col("lo")) & (step < F.col("hi")), step) \
            .when((step >= F.col("hi")) & (lam < F.col("hi")), F.col("hi")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = materialise(sums.select("__s", "target", F.when(F.col("error") <= TOLERANCE, lam).otherwise(inner).alias("lam"), "lo", "hi", "error"),
                            "entropy-dual")
        left = state.agg(F.max("error")).first()[0] or 0.0
        if left <= TOLERANCE:
            return state.select("__s", F.round("lam", 9).alias("lam"))
    raise RuntimeError(f"entropy balancing: a source misses its target by {left:.3g} of it after {MAX_ITERATIONS} iterations")


def copies_at(phase: Column) -> Column:
    """Integers that the running sum of rates passes in a row: ``whole`` and ``part`` are the sum up to it, ``whole0``, ``part0`` before."""
    passed = lambda whole, part: F.col(whole) + (F.col(part) + phase >= ONE).cast("long")
    return passed("whole", "part") - passed("whole0", "part0")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, phases: int = 64,
        seed: int = 3, id_col: str = "doc_id", source: str = "source", text: str = "text", tilt: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken (= copies * size). ``tilt``: a column."""
    key = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))     # null last
    moves = F.col(tilt).cast("double") if tilt else F.lit(1.0)
    moves = F.when((moves > 0) & (moves < float("inf")), moves).otherwise(1.0)
    sized = word_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), moves.alias("tilt"), F.col(text).alias("text")),
                        "text", ["doc_id", "source", "tilt"], "size").withColumn("__s", key)
    classes = sized.groupBy("doc_id", "source", "tilt", "size", "__s").agg(F.count(F.lit(1)).alias("n"))
    classes = materialise(classes.withColumn("__h", F.xxhash64(F.lit(seed), "doc_id", "size", "tilt")).withColumn("fall", -F.col("size")), "mix-sizes")

    histogram = classes.groupBy("__s", "tilt").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"))
    histogram = materialise(histogram.withColumn("tokens", F.col("tokens").cast("double")), "mix-histogram")
    totals = classes.groupBy("__s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialise(water_levels(totals, list(weights), share, cap), "mix-targets")
    rates = entropy_rates(histogram.filter("tokens > 0"), targets, cap)
    plan = materialise(targets.join(rates, "__s", "left"), "mix-rates")

    rate = F.coalesce(F.least(F.exp(F.col("lam") * F.col("tilt")), F.lit(float(cap))), F.lit(0.0))
    rows = classes.join(plan, "__s").withColumn("rate", rate).withColumn("step", F.round(F.col("rate") * ONE).cast("decimal(38,0)"))
    rows = rows.withColumn("_cell", F.struct("__s", order_slice(classes, ["fall", "__h"], shuffle_width(docs.sparkSession)).alias("slice")))
    sums = rows.groupBy("_cell").agg(F.sum(F.col("step") * F.col("n")).cast("decimal(38,0)").alias("sum"))
    earlier = Window.partitionBy("_cell.__s").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    skip = sums.select("_cell", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).cast("decimal(38,0)").alias("skip"))
    inside = Window.partitionBy("_cell").orderBy("fall", "__h", "doc_id", "tilt").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum((F.col("step") * F.col("n")).cast("decimal(38,0)")).over(inside), F.lit(0)).cast("decimal(38,0)")
    placed = rows.withColumn("inside", before).join(skip, "_cell").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    upto = (F.col("skip") + F.col("inside") + F.col("step") * F.col("k").cast("decimal(20,0)")).cast("decimal(38,0)")
    whole = lambda c: F.floor(c / F.lit(ONE).cast("decimal(20,0)")).cast("long")
    part = lambda c, w: (c - F.col(w).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(20,0)")).cast("long")
    placed = placed.withColumn("r0", upto).withColumn("r1", (F.col("r0") + F.col("step")).cast("decimal(38,0)")) \
        .withColumn("whole0", whole(F.col("r0"))).withColumn("whole", whole(F.col("r1"))) \
        .withColumn("part0", part(F.col("r0"), "whole0")).withColumn("part", part(F.col("r1"), "whole"))
    placed = materialise(placed.select("doc_id", "source", "__s", "size", "source_size", "target", "rate", "whole0", "whole", "part0", "part"), "mix-placed")

    at = [(2 * j + 1) * ONE // (2 * phases) for j in range(phases)]
    tried = placed.groupBy("__s", "target").agg(*[F.sum(F.col("size") * copies_at(F.lit(x))).alias(f"w{j}") for j, x in enumerate(at)])
    misses = F.array(*[F.struct(F.abs(F.col(f"w{j}") - F.col("target")).alias("miss"), F.lit(x).alias("phase")) for j, x in enumerate(at)])
    best = tried.select("__s", F.array_min(misses)["phase"].alias("phase"))
    copies = F.greatest(F.lit(0), F.least(F.lit(int(cap)), copies_at(F.col("phase"))))
    return placed.join(best, "__s").withColumn("copies", copies.cast("int")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
