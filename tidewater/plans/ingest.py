"""Page ingest job (E2, H8): stored responses → extracted payloads → raw-response upsert + status.

Stored responses: provider, kind, source_url, fetched_at, body, plus ``line`` for matrix pages.
``kind`` selects the extractor:
  groups  – object after a script marker (H2)      catalog – JSON catalog object with ``plans`` (S4)
  arrays  – two escaped arrays in page data (H3)   matrix  – HTML product matrix → plan cards (H1, H4–H7)
HTML kinds pass the block-page guard first (S3). Each response is independent: a failure, whatever its body
does to a parser, becomes an error row with its kind, never a failed job, and so does a kind that is NULL
or unknown; ``quarantine`` lists them. A provider fails only when all of its responses failed (A9).

A response stored more than once (at-least-once landing) counts once: responses are reduced by a 128-bit
key over all their columns, which also spreads the bodies over the cores. Bodies are then read in one
pass and the extracted rows written once; prices, dates, the upsert and the status read that table.

Network fetching, pacing and scheduling are outside the data work: responses and prices arrive as
tables. A response belongs to the UTC day it was fetched on (``run_date`` overrides it), and a card gets
the latest price known at that time: prices (product_key, prices, priced_at).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import to_utc
from ..operators.embedded_json import embedded_payload
from ..operators.html import card_rows, page_facts, read_pages
from ..operators.relational import as_of
from ..session import write_table
from ..sources.pages import catalog_ok, ingest_status, page_ok

CARD_JSON_FIELDS = ["line", "plan_name", "plan_id", "cpu_count", "cpu_model", "cores_count", "cpu_arch",
                    "cpu_detail_raw", "frequency", "ram", "storage", "gpu", "gpu_vram", "gpu_tflops",
                    "cpu_cores_raw", "bandwidth", "traffic", "monthly_key", "hourly_key"]
RESPONSE_COLS = ["provider", "kind", "source_url", "line", "fetched_at"]
HTML_KINDS = ["groups", "arrays", "matrix"]
KINDS = [*HTML_KINDS, "catalog"]


def matrix_cards(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Plan cards of matrix pages (page_id, position, the 19 card fields)."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), "line", F.col(html_col).alias("html"))
    rows = card_rows(page_facts(read_pages(src, "html", ["page_id", "line"])))
    return rows.withColumns({"plan_id": F.col("monthly_key"), "cpu_count": F.lit(None).cast("int"),
                             "frequency": F.lit(None).cast("string")}).select("page_id", "position", *CARD_JSON_FIELDS)


def distinct_price_keys(cards: DataFrame) -> DataFrame:
    """A10: the distinct non-blank monthly and hourly keys (one price lookup each)."""
    k = F.explode(F.array("monthly_key", "hourly_key")).alias("product_key")
    return cards.select(k).filter(F.col("product_key").isNotNull() & (F.col("product_key") != "")).distinct()


def prices_at(asked: DataFrame, prices: DataFrame, at: str) -> DataFrame:
    """``asked`` (product_key, the time column ``at``, any others) with ``prices``: the key's latest price at that time."""
    return as_of(asked, prices.select("product_key", "prices", to_utc("priced_at").alias("priced_at")), "product_key", at, "priced_at", "prices")


def attach_prices(cards: DataFrame, prices: DataFrame, at: str) -> DataFrame:
    """One price table joined in two roles, as known at the cards' time ``at``; a key without a price gives NULL.

    The cards are read four times, and to make them pages are parsed, so they are written once. Prices are looked up once for each
    distinct (key, time) of the cards and written too, so both joins see a table no larger than that."""
    cards = write_table(cards, "priced-cards")
    asked = cards.select(F.explode(F.array("monthly_key", "hourly_key")).alias("product_key"), F.col(at).alias("at")) \
        .filter("product_key <> '' AND at IS NOT NULL").distinct()
    p = write_table(prices_at(asked, prices, "at").filter("prices IS NOT NULL"), "known-prices")
    role = lambda key, out: p.select(F.col("product_key").alias(key), F.col("at").alias(at), F.col("prices").alias(out))
    return cards.join(role("monthly_key", "monthly_prices"), ["monthly_key", at], "left") \
        .join(role("hourly_key", "hourly_prices"), ["hourly_key", at], "left")


def price_maps(pages: DataFrame, prices: DataFrame) -> DataFrame:
    """(rid, prices): for every page the latest price of each key of its cards, as known when it was fetched.

    The map is bounded by the page's cards."""
    keys = F.array_distinct(F.flatten(F.transform("cards", lambda c: F.array(c["monthly_key"], c["hourly_key"]))))
    asked = pages.select("rid", to_utc("fetched_at").alias("at"), F.explode(keys).alias("product_key")).filter("product_key <> ''")
    one = prices_at(asked, prices, "at").filter(F.col("prices").isNotNull())
    return one.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("product_key", "prices"))).alias("prices"))


def card_payloads(pages: DataFrame, prices: DataFrame) -> DataFrame:
    """(rid, payload): X8, the cards of every page that has some as one JSON array, in document order. A price is set in
    as the JSON text it is; text that is not JSON counts as no price. Cards, prices and arrays share their key."""
    def price(key):
        text = F.try_element_at("known", F.col(key))
        return F.coalesce(F.when(F.try_parse_json(text).isNotNull(), text), F.lit("null"))

    made = {"plan_id": F.col("monthly_key"), "cpu_count": F.lit(None).cast("int"), "frequency": F.lit(None).cast("string")}
    plain = F.to_json(F.struct(*[made.get(f, F.col(f)).alias(f) for f in CARD_JSON_FIELDS]), {"ignoreNullFields": "false"})
    cards = card_rows(pages.select("rid", "line", "has_table", "cards", "grids", "specs")).join(
        price_maps(pages, prices).withColumnRenamed("prices", "known"), "rid", "left").withColumn("plain", plain)
    whole = F.concat(F.expr("substring(plain, 1, length(plain) - 1)"), F.lit(',"monthly_prices":'), price("monthly_key"),
                     F.lit(',"hourly_prices":'), price("hourly_key"), F.lit("}"))
    per_page = cards.select("rid", "position", whole.alias("j")).groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("position", "j"))).alias("cards"))
    return per_page.select("rid", F.concat(F.lit("["), F.array_join("cards.j", ","), F.lit("]")).alias("payload"))


def distinct_responses(responses: DataFrame) -> DataFrame:
    """Every response once, with its 128-bit key ``rid``; NULLs differ from all texts."""
    text = [F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n")) for c in [*RESPONSE_COLS, "body"]]
    rid = F.md5(F.concat_ws("\u0001", *[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text]))
    return responses.select(rid.alias("rid"), *RESPONSE_COLS, "body").dropDuplicates(["rid"])


def extract_responses(responses: DataFrame, prices: DataFrame, run_date: str | None = None) -> DataFrame:
    """Every distinct response → (provider, kind, source_url, extracted_date, fetched_at, payload, ok, error)."""
    kind, body = F.col("kind"), F.col("body")
    guard = F.when(kind.isin(*HTML_KINDS) & ~page_ok("body"), F.lit("page shorter than the block-page limit"))
    bad_shape = F.when((kind == "catalog") & ~catalog_ok("body"), F.lit("unexpected payload shape"))
    unknown = F.when(~F.coalesce(kind.isin(*KINDS), F.lit(False)), F.lit("unknown response kind"))
    one = distinct_responses(responses).withColumn("error", F.coalesce(guard, bad_shape, unknown))
    fine = F.col("error").isNull()
    one = one.withColumn("_x", embedded_payload(one, "kind", F.when(fine, body)))
    one = one.select("rid", *RESPONSE_COLS, F.coalesce("error", F.col("_x.error")).alias("error"),
                     F.coalesce("_x.payload", F.when(fine & (kind == "catalog"), body)).alias("payload"),
                     F.when(fine & (kind == "matrix"), body).alias("html"))
    read = read_pages(one, "html", ["rid", *RESPONSE_COLS, "error", "payload"], spread=False)
    read = read.withColumn("error", F.coalesce("error", F.concat(F.lit("page cannot be read: "), "page_error"))).drop("page_error")
    rows = write_table(page_facts(read), "ingest-extracted")

    matrix = rows.filter((F.col("kind") == "matrix") & F.col("error").isNull())
    cards = matrix.drop("payload").join(card_payloads(matrix, prices), "rid", "left") \
        .withColumn("payload", F.coalesce("payload", F.lit("[]")))
    rest = rows.filter(~F.coalesce((F.col("kind") == "matrix") & F.col("error").isNull(), F.lit(False)))
    cols = ["provider", "kind", "source_url", "fetched_at", "payload", "error"]
    day = F.lit(run_date).cast("date") if run_date else to_utc("fetched_at").cast("date")
    return rest.select(*cols).unionByName(cards.select(*cols)).select(
        "provider", "kind", "source_url", day.alias("extracted_date"), "fetched_at",
        F.when(F.col("error").isNull(), F.col("payload")).alias("payload"), F.col("error").isNull().alias("ok"), "error")


def ingest_results(responses: DataFrame, prices: DataFrame, run_date: str | None = None) -> DataFrame:
    """The extracted rows, written once: the raw rows, the status and the quarantine all read them."""
    return write_table(extract_responses(responses, prices, run_date), "ingest-results")


def raw_rows(results: DataFrame) -> DataFrame:
    """What is to be upserted."""
    return results.filter("ok").select("provider", "extracted_date", "source_url", "payload", "fetched_at")


def quarantine(results: DataFrame) -> DataFrame:
    """The responses that failed, with the kind of the failure."""
    return results.filter("NOT ok").select("provider", "kind", "source_url", "extracted_date", "fetched_at", "error")


def ingest(responses: DataFrame, prices: DataFrame, run_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(raw rows to upsert, status per provider), both read from the extracted rows."""
    results = ingest_results(responses, prices, run_date)
    return raw_rows(results), ingest_status(results)
