"""Competitor price-plan model (D20–D26): union of price lists, location lookup, CPU vendor,
family, model number and generation.

Inputs: any number of price-list frames with the staging columns (FIXTURES.md §1) and a
countries dimension (iso_2_code, country, region).

Plan shape: a single narrow stage. The OR-join on the country dimension is rewritten to a hash
equi-join on exploded keys (no nested loop, R13); the dimension is broadcast where Spark measures it
small. The classification layers stay separate projections so each costly regex column is computed once (R14).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.text import md5_key
from ..operators.relational import left_join_or_keys

PLAN_COLS = ["extracted_date", "company", "product_type", "plan_name", "plan_id", "cpu_model", "cpu_count",
             "cores_count", "frequency", "ram", "storage", "gpu", "bandwidth", "traffic", "location",
             "availability", "setup_fee", "price_monthly", "price_hourly", "currency"]
MODEL_COLS = ["extracted_date", "company", "product_type", "plan_name", "plan_id", "plan_by_loc_id", "cpu_model",
              "cpu_count", "cores_count", "frequency", "ram", "storage", "gpu", "bandwidth", "traffic", "location",
              "region", "availability", "setup_fee", "price_monthly", "price_hourly", "currency", "cpu_vendor",
              "custom_region", "cpu_family", "cpu_model_number", "cpu_generation"]


def union_price_lists(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` of the price lists (U2), by column name: upstream column order is not known."""
    return reduce(DataFrame.unionByName, [f.select(*PLAN_COLS) for f in frames])


def normalise_plans(all_plans: DataFrame, countries: DataFrame) -> DataFrame:
    """Location lookup by ISO code or country name, cleanup and ``plan_by_loc_id`` (D20). Spark broadcasts the countries
    where it measures them small."""
    dim = countries.select("iso_2_code", F.col("country").alias("c_country"), F.col("region").alias("c_region"))
    j = left_join_or_keys(all_plans, dim, "location", ["iso_2_code", "c_country"])
    return j.select(
        "extracted_date", "company", "product_type", "plan_name", "plan_id",
        md5_key("plan_id", "c_country").alias("plan_by_loc_id"),
        "cpu_model", F.coalesce(F.col("cpu_count"), F.lit(1)).alias("cpu_count"), "cores_count",
        "frequency", "ram", "storage", "gpu", F.replace(F.col("bandwidth"), F.lit(" "), F.lit("")).alias("bandwidth"),
        "traffic", F.col("c_country").alias("location"), F.col("c_region").alias("region"), "availability",
        "setup_fee", "price_monthly", "price_hourly", "currency")


def classify_cpus(df: DataFrame) -> DataFrame:
    """Vendor → region/family/number → generation, as layered projections."""
    return (df.withColumn("cpu_vendor", C.cpu_vendor())
              .withColumns({"custom_region": C.custom_region(),
                            "cpu_family": C.cpu_family(),
                            "cpu_model_number": C.cpu_model_number()})
              .withColumn("cpu_generation", C.cpu_generation()))


def price_plan_model(frames: Sequence[DataFrame], countries: DataFrame) -> DataFrame:
    return classify_cpus(normalise_plans(union_price_lists(frames), countries)).select(*MODEL_COLS)
