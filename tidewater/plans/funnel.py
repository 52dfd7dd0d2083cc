"""Lead funnel model (D10–D16): See → Think → Do → Care entry times and churn per lead.

Inputs (contracts, FIXTURES.md §1): sessions (the sessions model), clients (DimClients),
orders (FactWebOrders), forms (FactWebForms), sales (FactSales), resources (FactResources),
teams (DimTeams). ``clients`` may repeat a ``korys_client_id`` or hold NULL ones.

Plan shape at scale (R3, R16): every touch source is reduced to ONE row per key before any join:
* visitor touches: orders and forms are unioned and aggregated once per ``anonymous_id``
  (four conditional minima, partial aggregation map-side);
* client touches: sales and churn are unioned and aggregated once per client;
* churn: resources are reduced to one row per partner before meeting the teams dimension.
The See set has at most one row per visitor and per client; only contact rows that repeat a key
multiply it, as the reference does. The full outer join with clients is written as left join + anti
join (AQE can split a skewed left join, not a full one), and NULL client keys are spread instead of
hashed into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import add_months_ts, md5_key, rx, to_utc
from ..operators.relational import first_per_key, left_join_nullable, least_chain
from ..session import write_table

NTZ = "timestamp_ntz"


def see_stage(sessions: DataFrame) -> DataFrame:
    """First visit per visitor, kept when the visitor is anonymous or is the user's first.

    ``anonymous_step = 1`` and ``user_step = 1`` (W4–W6) are both "first row per key" and are
    computed as aggregations, both from one aggregation of the sessions to the first of every (visitor, client); the
    visit must be first in both rankings (same row)."""
    s = sessions.filter(F.col("anonymous_id").isNotNull()).select(
        "anonymous_id", "session_id", F.col("first_user_by_anonymous").alias("korys_client_id"),
        "attribution_id", "session_start_time")
    # the ad fan-out repeats a session with several attribution keys: they break the remaining ties
    order = ["session_start_time", "session_id", "attribution_id"]
    # both rankings begin with the first session of every (visitor, client): the sessions are read once
    firsts = write_table(first_per_key(s, ["anonymous_id", "korys_client_id"], order, order), "lead-firsts")
    by_visitor = first_per_key(firsts, ["anonymous_id"], [*order, "korys_client_id"],
                               ["session_id", "korys_client_id", "attribution_id", "session_start_time"])
    by_user = (first_per_key(firsts.filter(F.col("korys_client_id").isNotNull()), ["korys_client_id"],
                             ["session_start_time", "anonymous_id", "session_id", "attribution_id"],
                             ["anonymous_id", "session_id", "attribution_id"])
               .toDF("u_client", "u_anonymous_id", "u_session_id", "u_attribution_id"))
    j = left_join_nullable(by_visitor, by_user, "korys_client_id", "u_client", salt="anonymous_id")
    keep = F.col("korys_client_id").isNull() | (
        (F.col("u_anonymous_id") == F.col("anonymous_id")) & (F.col("u_session_id") == F.col("session_id"))
        & F.col("u_attribution_id").eqNullSafe(F.col("attribution_id")))
    return j.filter(keep).select("anonymous_id", "korys_client_id", "attribution_id",
                                 to_utc("session_start_time").alias("see_entered_at"))


def visitor_touches(orders: DataFrame, forms: DataFrame) -> DataFrame:
    """First order-page visit / order attempt / think form / do form per visitor (A8), one pass."""
    o = orders.filter(F.col("anonymous_id").isNotNull()).select(
        "anonymous_id", to_utc("original_timestamp").alias("ts"), "order_type",
        F.lit(None).cast("string").alias("form_name"))
    f = forms.filter(F.col("anonymous_id").isNotNull()).select(
        "anonymous_id", to_utc("original_timestamp").alias("ts"), F.lit(None).cast("string").alias("order_type"),
        "form_name")
    ts, ot, fn = F.col("ts"), F.col("order_type"), F.col("form_name")
    return o.unionByName(f).groupBy("anonymous_id").agg(
        F.min(F.when(~ot.isin(*R.DO_ORDER_TYPES), ts)).alias("order_page_at"),   # NULL type: neither
        F.min(F.when(ot.isin(*R.DO_ORDER_TYPES), ts)).alias("order_try_at"),
        F.min(F.when(rx(fn, R.THINK_FORM_PATTERN), ts)).alias("think_form_at"),
        F.min(F.when(fn.isin(*R.DO_FORMS), ts)).alias("do_form_at"),
    )


def churn_dates(resources: DataFrame, teams: DataFrame) -> DataFrame:
    """``max(least(date_cancel, value_date) + 6 months)`` per team owner (D14, A6), per partner before the join.

    The months are added first: with times of day, clamped month ends need not keep their order."""
    per_partner = (resources.groupBy("partner_id")
                   .agg(F.max(add_months_ts(F.least("date_cancel", "resource_value_date"), R.CHURN_GRACE_MONTHS)).alias("_end")))
    owners = teams.select(F.col("odoo_partner_id").alias("partner_id"),
                          F.col("team_owner_client_id").alias("korys_client_id"))
    return per_partner.join(owners, "partner_id").groupBy("korys_client_id").agg(F.max("_end").alias("churn_date"))


def client_touches(sales: DataFrame, resources: DataFrame, teams: DataFrame) -> DataFrame:
    """First new sale, first renewal and churn date per client, one aggregation."""
    null_ts, null_d, null_s = (F.lit(None).cast(NTZ), F.lit(None).cast("date"), F.lit(None).cast("string"))
    s = sales.filter(F.col("korys_client_id").isNotNull()).select(
        "korys_client_id", F.least("resource_date_start", "resource_value_date").alias("d"), "order_state", null_ts.alias("churn_date"))
    ch = churn_dates(resources, teams).filter(F.col("korys_client_id").isNotNull()).select(
        "korys_client_id", null_d.alias("d"), null_s.alias("order_state"), "churn_date")
    d, st = F.col("d"), F.col("order_state")
    return s.unionByName(ch).groupBy("korys_client_id").agg(
        F.min(F.when(st.isin(*R.DO_SALE_STATES), d)).alias("new_sale"),
        F.min(F.when(st.isin(*R.CARE_SALE_STATES), d)).alias("renewal"),
        F.max("churn_date").alias("churn_date"),
    )


def lead_stages(sessions: DataFrame, clients: DataFrame, orders: DataFrame, forms: DataFrame, sales: DataFrame,
                resources: DataFrame, teams: DataFrame) -> DataFrame:
    """Stage entry times before the back-fill (D11–D13): one row per lead."""
    see = write_table(see_stage(sessions), "lead-see")
    contacts = clients.filter(F.col("korys_contact_created_date").isNotNull()).select(
        "korys_client_id", to_utc("korys_contact_created_date").alias("contact_at"))

    # See FULL JOIN contact rows = (See LEFT JOIN contacts) UNION ALL (contacts without a See row). Contact rows are joined
    # as they are: a client stored twice makes two leads, one without a key is a lead of its own.
    see_side = left_join_nullable(see, contacts.withColumnRenamed("korys_client_id", "c_client"),
                                  "korys_client_id", "c_client", salt="anonymous_id")
    see_side = see_side.join(visitor_touches(orders, forms), "anonymous_id", "left")
    seen = see.select("korys_client_id").filter(F.col("korys_client_id").isNotNull())
    only_contacts = contacts.filter(F.col("korys_client_id").isNotNull()).join(seen, "korys_client_id", "left_anti")
    leads = see_side.withColumn("_salt", F.col("anonymous_id")).unionByName(only_contacts, allowMissingColumns=True)
    leads = left_join_nullable(leads, client_touches(sales, resources, teams).withColumnRenamed("korys_client_id", "t_client"),
                               "korys_client_id", "t_client", salt="_salt")
    # contacts without a key meet nothing: they are added behind the join, so that however many there are they are never shuffled
    leads = leads.unionByName(contacts.filter(F.col("korys_client_id").isNull()), allowMissingColumns=True)

    think = F.least("contact_at", "order_page_at", "think_form_at")
    do = F.least(F.col("new_sale").cast(NTZ), F.col("order_try_at"), F.col("do_form_at"))
    return leads.select("anonymous_id", "korys_client_id", "attribution_id", "see_entered_at",
                        think.alias("think_entered_at"), do.alias("do_entered_at"),
                        F.col("renewal").alias("care_entered_at"), "churn_date")


def backfill_funnel(staged: DataFrame) -> DataFrame:
    """Lead model columns (D15, D16): each stage is at most every later stage; exit only after Care."""
    see_, think_, do_ = least_chain([F.col("see_entered_at"), F.col("think_entered_at"), F.col("do_entered_at"),
                                     F.col("care_entered_at").cast(NTZ)])[:3]
    return staged.select(
        md5_key(F.coalesce("anonymous_id", F.lit("NULL")), F.coalesce("korys_client_id", F.lit("NULL"))).alias("lead_id"),
        "anonymous_id", "korys_client_id", "attribution_id",
        see_.alias("see_entered_at"), think_.alias("think_entered_at"), do_.alias("do_entered_at"),
        "care_entered_at",
        F.when(F.col("care_entered_at").isNotNull(), F.col("churn_date")).alias("care_exited_at"),
    )


def lead_model(sessions: DataFrame, clients: DataFrame, orders: DataFrame, forms: DataFrame, sales: DataFrame,
               resources: DataFrame, teams: DataFrame) -> DataFrame:
    return backfill_funnel(lead_stages(sessions, clients, orders, forms, sales, resources, teams))
