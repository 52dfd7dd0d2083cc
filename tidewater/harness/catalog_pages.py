"""Registered page-side queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.embedded_json import embedded_arrays, embedded_object, explode_payload, to_json_doc
from ..operators.html import ATTRIBUTES, card_rows, expand_cells_sql, html_elements, page_facts, read_pages
from ..plans.ingest import attach_prices, distinct_price_keys, ingest, ingest_results, matrix_cards, quarantine
from ..session import tables_dir
from ..sources.pages import (RAW_COLS, Tables, bucketed_raw_table, catalog_ok, page_ok, payload_rows, upsert_bucketed, upsert_latest,
                             upsert_raw_table, valid_pages, write_model)
from . import oracle_pages as P
from .catalog import register, with_inputs
from .standins import Inputs


def _facts(spark, sf):
    pages = Inputs(spark, sf)["matrix_pages"].select("page_id", "line", "html")
    return page_facts(read_pages(pages, "html", ["page_id", "line"]))


def _cards(spark, sf):
    return card_rows(_facts(spark, sf))


def matrix_sql(final: str, extra_inputs=()) -> str:
    return with_inputs(P.MATRIX_INPUTS + list(extra_inputs), P.MATRIX_CTES, final=final)


@register("html_cards", matrix_sql(P.CARDS_SQL_FINAL))
def html_cards(spark, sf):
    cards = _facts(spark, sf).select("page_id", F.posexplode("cards").alias("position", "c"))
    return cards.select("page_id", "position", "c.plan_name", "c.monthly_key", "c.hourly_key")


@register("html_cards_enriched", matrix_sql(P.ENRICHED_FINAL))
def html_cards_enriched(spark, sf):
    return matrix_cards(Inputs(spark, sf)["matrix_pages"].select("page_id", "line", "html"))


@register("array_positional_join", matrix_sql(P.POSITIONAL_FINAL))
def array_positional_join(spark, sf):
    return _cards(spark, sf).filter("has_table").select("page_id", "position", "cpu_model", "bandwidth")


@register("html_gpu_grid", matrix_sql(P.GPU_FINAL))
def html_gpu_grid(spark, sf):
    return _cards(spark, sf).filter("NOT has_table").select(
        "page_id", "position", "plan_name", "cpu_model", "cores_count", "cpu_cores_raw", "ram", "gpu", "gpu_vram", "gpu_tflops")


@register("join_last_wins", matrix_sql(P.LAST_WINS_FINAL))
def join_last_wins(spark, sf):
    return _cards(spark, sf).filter("NOT has_table").select("page_id", "position", "plan_name",
                                                            F.col("gpu").isNotNull().alias("enriched"))


@register("distinct_keys", matrix_sql(P.KEYS_FINAL))
def distinct_keys(spark, sf):
    return distinct_price_keys(_cards(spark, sf))


@register("join_two_roles", matrix_sql(P.TWO_ROLES_FINAL, ["prices"]))
def join_two_roles(spark, sf):
    fetched = _cards(spark, sf).select("page_id", "position", "monthly_key", "hourly_key", F.expr(
        "TIMESTAMP_NTZ '2026-05-04 06:00:00' + make_dt_interval(page_id % 3 - 1)").alias("fetched_at"))
    return attach_prices(fetched, Inputs(spark, sf)["prices"], "fetched_at").select(
        "page_id", "position", "monthly_key", "hourly_key", "monthly_prices", "hourly_prices")


@register("json_roundtrip", matrix_sql(P.JSON_ROUNDTRIP_FINAL))
def json_roundtrip(spark, sf):
    i = Inputs(spark, sf)
    cards = matrix_cards(i["matrix_pages"].select("page_id", "line", "html"))
    return cards.select("page_id", "position",
                        to_json_doc("plan_name", "monthly_key", "hourly_key", "cores_count", "cpu_model").alias("doc"))


@register("html_spec_rows", with_inputs(["matrix_parts"], final=P.SPEC_ROWS_FINAL))
def html_spec_rows(spark, sf):
    specs = _facts(spark, sf).select("page_id", "specs.*")
    items = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a)["label"].alias("label"),
                               F.size(F.col(a)["cells"]).alias("n_cells"),
                               F.try_element_at(F.col(a)["cells"], F.lit(1))["text"].alias("first_cell"))
                     for a in ATTRIBUTES])
    return specs.select("page_id", F.inline(items)).filter(F.col("label").isNotNull())


@register("array_expand_pad", matrix_sql(P.EXPAND_FINAL))
def array_expand_pad(spark, sf):
    facts = _facts(spark, sf).filter("has_table AND size(cards) > 0").withColumn("n", F.size("cards"))
    return facts.select("page_id", F.array_join(F.expr(expand_cells_sql("specs.traffic.cells", "n")), "|").alias("traffic_cells"))


@register("html_elements", with_inputs([], final=P.ELEMENTS_FINAL))
def html_elements_q(spark, sf):
    pages = Inputs(spark, sf)["pages"]
    return (html_elements(pages).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n_elements")))


@register("html_texts", with_inputs([], final=P.TEXTS_FINAL))
def html_texts(spark, sf):
    """Text and attributes of titles and links."""
    el = html_elements(Inputs(spark, sf)["pages"]).filter(F.col("tag").isin("title", "a"))
    return el.groupBy("page_id", "tag", F.try_element_at("attrs", F.lit("href")).alias("href"), "text") \
        .agg(F.count(F.lit(1)).cast("int").alias("n"))


@register("scan_named_model", "SELECT event_id, event_type FROM events WHERE event_type = 'click'")
def scan_named_model(spark, sf):
    """A table by its model name and one by its path, through the same door."""
    named = Tables(spark, {"FactEvents": f"{sf}/events.parquet"})["FactEvents"]
    direct = Tables(spark, {})[f"{sf}/events.parquet"]
    clicks = named.filter("event_type = 'click'").select("event_id", "event_type")
    return clicks.join(direct.select("event_id"), "event_id", "left_semi")


@register("write_partitioned", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def write_partitioned(spark, sf):
    """A partitioned model of which one partition is written again; the others stay."""
    orders = Inputs(spark, sf)["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = f"{tables_dir(spark)}/write-partitioned-{uuid.uuid4().hex}"
    write_model(orders, path, partition_by=["o_orderstatus"])
    again = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    write_model(again, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("scan_valid_pages", with_inputs([], final=P.VALID_PAGES_FINAL))
def scan_valid_pages(spark, sf):
    ok, rejected = valid_pages(Inputs(spark, sf)["pages"])
    return ok.unionByName(rejected).select("page_id", F.length("html").alias("n_chars"), page_ok("html").alias("ok"))


def _responses(i: Inputs, kind: str):
    return i["stored_responses"].filter(F.col("kind") == kind)


@register("scan_json_shape_guard", with_inputs(["stored_responses"], final=P.SHAPE_FINAL))
def scan_json_shape_guard(spark, sf):
    return _responses(Inputs(spark, sf), "catalog").select("response_id", catalog_ok("body").alias("ok"))


@register("payload_row_count", with_inputs(["stored_responses"], final=P.PAYLOAD_ROWS_FINAL))
def payload_row_count(spark, sf):
    return _responses(Inputs(spark, sf), "catalog").select("response_id", payload_rows("body").alias("n_rows"))


@register("json_explode_plans", with_inputs(["stored_responses"], final=P.EXPLODE_FINAL))
def json_explode_plans(spark, sf):
    cat = _responses(Inputs(spark, sf), "catalog").filter(catalog_ok("body"))
    plans = cat.select("response_id", F.get_json_object("body", "$.plans").alias("plans"))
    return explode_payload(plans, "plans").select("response_id", F.col("item_pos").cast("int").alias("item_pos"),
                                                  F.col("item")["k"].alias("k"))


@register("json_embedded_object", with_inputs(["stored_responses"], P.HOSTILE_CTE, P.GROUPS_CTE, final=P.GROUPS_FINAL))
def json_embedded_object(spark, sf):
    out = embedded_object(_responses(Inputs(spark, sf), "groups"), html="body")
    return out.select("response_id", F.col("error").isNull().alias("ok"), "payload")


def _arrays(spark, sf):
    out = embedded_arrays(_responses(Inputs(spark, sf), "arrays"), html="body")
    return out.select("response_id", F.col("error").isNull().alias("ok"), "payload")


ARRAYS_SQL = with_inputs(["stored_responses"], P.HOSTILE_CTE, P.ARRAYS_CTE, final=P.ARRAYS_FINAL)
register("json_embedded_arrays", ARRAYS_SQL)(_arrays)
register("array_concat", ARRAYS_SQL)(_arrays)


@register("upsert_latest", with_inputs(["raw_existing", "raw_incoming"], final=P.UPSERT_FINAL))
def upsert_latest_q(spark, sf):
    i = Inputs(spark, sf)
    return upsert_latest(i["raw_existing"], i["raw_incoming"])


@register("upsert_raw_rows", with_inputs(["raw_existing", "raw_incoming"], final=P.UPSERT_FINAL))
def upsert_raw_rows(spark, sf):
    """The table is written, upserted and read back."""
    i = Inputs(spark, sf)
    path = f"{tables_dir(spark)}/raw-responses-{uuid.uuid4().hex}"
    upsert_raw_table(spark, path, i["raw_existing"])
    upsert_raw_table(spark, path, i["raw_incoming"])
    return spark.read.parquet(path).select(*RAW_COLS)


@register("upsert_bucketed_rows", with_inputs(["raw_existing", "raw_incoming"], final=P.UPSERT_FINAL))
def upsert_bucketed_rows(spark, sf):
    """The same into a table in buckets."""
    i = Inputs(spark, sf)
    name = f"raw_responses_{uuid.uuid4().hex}"
    path = f"{tables_dir(spark)}/{name}"
    bucketed_raw_table(spark, name, path, 8)
    for part in ("raw_existing", "raw_incoming"):
        upsert_bucketed(spark, name, i[part].withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")))
    spark.sql(f"DROP TABLE {name}")         # the catalog's entry; the files go with the intermediate tables
    return spark.read.parquet(path).select(*RAW_COLS)


def ingest_sql(final: str) -> str:
    return with_inputs([*P.MATRIX_INPUTS, "stored_responses", "prices"], P.MATRIX_CTES, P.HOSTILE_CTE, P.GROUPS_CTE, P.ARRAYS_CTE, P.RESULTS_CTES, final=final)


def _ingest(spark, sf):
    i = Inputs(spark, sf)
    return ingest(i["stored_responses"], i["prices"])


@register("ingest_raw_rows", ingest_sql(P.RAW_ROWS_FINAL))
def ingest_raw_rows(spark, sf):
    return _ingest(spark, sf)[0]


@register("ingest_quarantine", ingest_sql(P.QUARANTINE_FINAL))
def ingest_quarantine(spark, sf):
    """The failed responses, by where they came from."""
    i = Inputs(spark, sf)
    return quarantine(ingest_results(i["stored_responses"], i["prices"])).select("provider", "source_url", "fetched_at")


@register("ingest_status", ingest_sql(P.STATUS_FINAL))
def ingest_status_q(spark, sf):
    return _ingest(spark, sf)[1]
