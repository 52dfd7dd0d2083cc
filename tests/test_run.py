"""The model runner on named tables, and the driver contract from another working directory."""
import os
import subprocess
import sys
import tempfile

from tidewater.harness.standins import PRICE_LISTS, Inputs
from tidewater.plans.run import run_models
from tidewater.sources.pages import write_model

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = {"int_rudder__pages": "pageviews", "stg_rudder__interactions": "interactions",
         "stg_rudder__identifies": "identifies", "stg_gads__clickviews": "gads", "base_odoo__clients": "clients",
         "DimClients": "dim_clients", "FactWebOrders": "web_orders", "FactWebForms": "web_forms", "FactSales": "sales",
         "FactResources": "resources", "DimTeams": "teams", "DimAttribution": "attribution", "FactAdQuality": "ad_cost",
         "FactAffiliateVisits": "affiliate_cost", "DimCountries": "countries"}


def test_models_from_named_tables(spark):
    root = tempfile.mkdtemp(prefix="tidewater-run-")
    i = Inputs(spark, "/root/testdata/sf0.001")
    mapping = {}
    for ref_name, standin in list(NAMES.items()) + [(p, p) for p in PRICE_LISTS]:
        path = os.path.join(root, "in", ref_name)
        write_model(i[standin], path)
        mapping[ref_name] = path
    mapping["price_lists"] = PRICE_LISTS
    done = run_models(spark, mapping, os.path.join(root, "out"), since="1997-01-01")
    out = {n: spark.read.parquet(path).count() for n, path in done.items()}
    assert set(out) == {"sessions", "leads", "roi_monthly", "price_plans"}
    assert out["sessions"] > 0 and out["price_plans"] == i["part"].count()


def test_entry_from_another_directory():
    code = (f"import sys; sys.path.insert(0, {REPO!r}); import __spark_entry__ as e;"
            "from pyspark.sql import SparkSession;"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate();"
            "print('ROWS', e.queries()['html_elements'](s, '/root/testdata/sf0.001').count(),"
            " e.entry(s).count())")
    cwd = tempfile.mkdtemp(prefix="tidewater-cwd-")
    r = subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=600,
                       env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ROWS" in r.stdout, r.stderr[-3000:]
