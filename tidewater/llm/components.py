"""Connected components of a link table by minimum labels with pointer jumping.

Each round takes, for every vertex, the least label among itself and its neighbours, hooks its old
label to that too, and replaces labels by their labels' labels. Labels only fall, so the rounds end
when nothing changes; jumping makes that logarithmic in practice, also on long chains. Minima are
aggregated map-side, so a vertex linked to a third of all others is no hot key; one count a round
comes to the driver, and every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(v, label): the least vertex of every linked vertex's component."""
    both = links.select(F.col(a).alias("v"), F.col(b).alias("u")).unionByName(links.select(F.col(b).alias("v"), F.col(a).alias("u")))
    both = materialise(both.distinct(), "component-links")
    labels = materialise(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("label")), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "u"), "u").groupBy("v").agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("low"))
        # a vertex's old label is a vertex of the same component: it takes the lower one too
        hooks = step.filter("low < label").select(F.col("label").alias("v"), "low")
        low = step.select("v", "low").unionByName(hooks).groupBy("v").agg(F.min("low").alias("low"))
        jump = low.alias("x").join(low.select(F.col("v").alias("low"), F.col("low").alias("far")), "low", "left") \
            .select("v", F.least("low", F.coalesce("far", "low")).alias("label"))
        new = materialise(jump, "component-labels")
        changed = new.join(labels.withColumnRenamed("label", "old"), "v").filter("label <> old").limit(1).count()
        labels = new
        if not changed:
            return labels
