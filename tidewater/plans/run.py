"""Run the four models from named tables and materialise them.

    python -m tidewater.plans.run --tables tables.json --out /shared/models [--since 2024-01-01]

``tables.json`` maps the reference's model names to Parquet paths or catalog tables, e.g.
``{"int_rudder__pages": "s3://.../pages", "FactSales": "warehouse.fact_sales", ...}``; the six
price lists are listed under ``"price_lists"``. Each model is written with overwrite semantics; the
leads are built from the written sessions, which are thus computed once. Events need a unique
``event_id``: it breaks ties between equal timestamps, so a retried task gives the same firsts.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..functions import rules as R
from ..session import build_session, scratch
from ..sources.pages import Tables, write_model
from .funnel import lead_model
from .price_plans import price_plan_model
from .roi import roi_model
from .sessions import session_model

TIEBREAK = ["event_id"]
SESSION_INPUTS = ["int_rudder__pages", "stg_rudder__interactions", "stg_rudder__identifies", "stg_gads__clickviews",
                  "base_odoo__clients"]
FUNNEL_INPUTS = ["DimClients", "FactWebOrders", "FactWebForms", "FactSales", "FactResources", "DimTeams"]
ROI_INPUTS = ["FactSales", "DimTeams", "DimAttribution", "FactAdQuality", "FactAffiliateVisits"]


def run_models(spark: SparkSession, mapping: dict, out: str, since: str = R.ROI_SINCE) -> dict[str, str]:
    """Build and write every model; returns the folder of each."""
    t = Tables(spark, {k: v for k, v in mapping.items() if isinstance(v, str)})
    done: dict[str, str] = {}

    def write(name, df):
        done[name] = f"{out.rstrip('/')}/{name}"
        write_model(df, done[name])

    write("sessions", session_model(*[t[n] for n in SESSION_INPUTS], tiebreak=TIEBREAK))
    write("leads", lead_model(spark.read.parquet(done["sessions"]), *[t[n] for n in FUNNEL_INPUTS]))
    write("roi_monthly", roi_model(*[t[n] for n in ROI_INPUTS], since=since))
    if mapping.get("price_lists"):
        write("price_plans", price_plan_model([t[p] for p in mapping["price_lists"]], t["DimCountries"]))
    return done


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--since", default=R.ROI_SINCE)
    a = ap.parse_args(argv)
    spark = build_session(app="tidewater-models")
    with open(a.tables) as f, scratch(spark):
        run_models(spark, json.load(f), a.out, a.since)


if __name__ == "__main__":
    main()
