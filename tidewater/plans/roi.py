"""Monthly return on ad and affiliate spend, cohorted by the customer's first-order month.

Inputs (contracts, FIXTURES.md §1): sales(partner_id, attribution_id, amount, invoice_state),
teams(odoo_partner_id, first_order_date), attribution(attribution_id, medium, default_channel_grouping),
ad_cost(date, cost), affiliate_cost(date_invoice, commission_amt, state).

Money keeps the scale of its input: nothing is rounded before the ratio.

Plan shape at scale: the sales fact is pre-aggregated per (partner, attribution) before any join
(map-side partial sums, R3) and again per (month, attribution) before the attribution join, so neither
a hot partner nor a hot attribution meets a join; both cost facts collapse to one row per month first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import guarded_ratio, month_start, rx


def cohort_ltv(sales: DataFrame, teams: DataFrame, attribution: DataFrame) -> DataFrame:
    """LTV by first-order month of the customer, split into paid-search and affiliate revenue."""
    per_pair = (sales.filter(F.col("invoice_state").isin(*R.PAID_INVOICE_STATES))
                .groupBy("partner_id", "attribution_id")
                .agg(F.sum("amount").alias("amount")))
    cohort = teams.select(F.col("odoo_partner_id").alias("partner_id"),
                          month_start("first_order_date").alias("month"))
    attr = attribution.select("attribution_id", "medium", "default_channel_grouping")
    per_cohort = per_pair.join(cohort, "partner_id").groupBy("month", "attribution_id").agg(F.sum("amount").alias("amount"))
    joined = per_cohort.join(attr, "attribution_id")
    amount = F.col("amount")
    return joined.groupBy("month").agg(
        F.sum(F.when(rx("medium", R.ROI_PAID_MEDIUM), amount).otherwise(F.lit(0))).alias("gads_ltv"),
        F.sum(F.when(F.col("default_channel_grouping") == R.AFFILIATE_CHANNEL, amount)
              .otherwise(F.lit(0))).alias("affiliate_ltv"),
    )


def monthly_sum(df: DataFrame, date_col: str, amount_col: str, out: str, condition=None) -> DataFrame:
    """``SELECT date_trunc('month', date_col), sum(amount_col) ... GROUP BY 1``."""
    if condition is not None:
        df = df.filter(condition)
    return df.groupBy(month_start(date_col).alias("month")).agg(F.sum(amount_col).alias(out))


def roi_model(sales: DataFrame, teams: DataFrame, attribution: DataFrame, ad_cost: DataFrame,
              affiliate_cost: DataFrame, since: str = R.ROI_SINCE) -> DataFrame:
    """Months are driven by LTV (months with cost only vanish), zeros filled, ratio NULL unless cost > 0."""
    ltv = cohort_ltv(sales, teams, attribution)
    ads = monthly_sum(ad_cost, "date", "cost", "total_ad_costs")
    aff = monthly_sum(affiliate_cost, "date_invoice", "commission_amt", "total_affiliate_costs",
                      F.col("state").isin(*R.PAID_INVOICE_STATES))
    monthly = (ltv.join(ads, "month", "left").join(aff, "month", "left")
               .select("month", *[F.coalesce(F.col(src), F.lit(0)).alias(out) for src, out in (
                   ("gads_ltv", "gads_ltv"), ("total_ad_costs", "total_gads_costs"), ("affiliate_ltv", "affiliate_ltv"),
                   ("total_affiliate_costs", "total_affiliate_costs"))]))
    return (monthly
            .withColumn("gads_ROI", guarded_ratio("gads_ltv", "total_gads_costs"))
            .withColumn("affiliate_ROI", guarded_ratio("affiliate_ltv", "total_affiliate_costs"))
            .filter(F.col("month") >= F.lit(since).cast("timestamp_ntz"))
            .orderBy("month"))
