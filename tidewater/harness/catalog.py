"""

Every query reads the driver's tables (through the stand-ins) in full. ``QUERIES[name]`` is
``(callable(spark, sf_dir) -> DataFrame, oracle_sql or None)``; ``None`` marks operators that SQL
cannot express (the driver then checks row counts only, and a test compares against a brute-force
Python evaluation on a small fixture).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.funnel import lead_model
from ..plans.price_plans import normalise_plans, price_plan_model, union_price_lists
from ..plans.roi import roi_model
from ..plans.sessions import session_model
from . import oracle_models as O
from .standins import PRICE_LISTS, Inputs, duck_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}
TIEBREAK = ["event_id"]


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def with_inputs(inputs, *cte_blocks: str, final: str) -> str:
    blocks = duck_ctes(inputs) + [b.strip() for b in cte_blocks if b.strip()]
    return ("WITH " + ",\n".join(blocks) + "\n" + final) if blocks else final


# ------------------------------------------------------------------------------------------------
# models
# ------------------------------------------------------------------------------------------------
def sessions_df(i: Inputs) -> DataFrame:
    return session_model(i["pageviews"], i["interactions"], i["identifies"], i["gads"], i["clients"], TIEBREAK)


def leads_df(i: Inputs) -> DataFrame:
    return lead_model(sessions_df(i), i["dim_clients"], i["web_orders"], i["web_forms"], i["sales"],
                      i["resources"], i["teams"])


def roi_df(i: Inputs) -> DataFrame:
    return roi_model(i["sales"], i["teams"], i["attribution"], i["ad_cost"], i["affiliate_cost"],
                     since=O.ROI_SINCE_TEST)


def plans_df(i: Inputs) -> DataFrame:
    return price_plan_model([i[n] for n in PRICE_LISTS], i["countries"])


SESSIONS_SQL = with_inputs(O.SESSIONS_INPUTS, O.SESSIONS_CTES, final="SELECT * FROM model_sessions")
LEADS_SQL = with_inputs(O.FUNNEL_INPUTS, O.SESSIONS_CTES, O.FUNNEL_CTES, final="SELECT * FROM model_leads")
ROI_SQL = with_inputs(O.ROI_INPUTS, O.ROI_CTES, final="SELECT * FROM model_roi_monthly")
PLANS_SQL = with_inputs(O.PLANS_INPUTS, O.PLANS_CTES, final="SELECT * FROM model_price_plans")


@register("model_sessions", SESSIONS_SQL)
def model_sessions(spark, sf):
    return sessions_df(Inputs(spark, sf))


@register("model_leads", LEADS_SQL)
def model_leads(spark, sf):
    return leads_df(Inputs(spark, sf))


@register("funnel_leads", LEADS_SQL)
def funnel_leads(spark, sf):
    return leads_df(Inputs(spark, sf))


@register("model_roi_monthly", ROI_SQL)
def model_roi_monthly(spark, sf):
    return roi_df(Inputs(spark, sf))


@register("model_price_plans", PLANS_SQL)
def model_price_plans(spark, sf):
    return plans_df(Inputs(spark, sf))


@register("plans_location", with_inputs(O.PLANS_INPUTS, O.PLANS_LOCATION_CTES, final="SELECT * FROM plans_location"))
def plans_location(spark, sf):
    i = Inputs(spark, sf)
    return normalise_plans(union_price_lists([i[n] for n in PRICE_LISTS]), i["countries"])


from . import catalog_ops, catalog_pages  # noqa: E402,F401  (register the operator and page queries)


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql is not None}
