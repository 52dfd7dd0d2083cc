"""Web sessions model (D1–D9): one row per session (before the ad fan-out) with first touch,
page count, start/end, device, channel, internal-traffic flag and attribution key.

Inputs (contracts, FIXTURES.md §1): pageviews, interactions, identifies, gads (click views), clients.
``tiebreak`` names columns that make "first by timestamp" deterministic (ties are arbitrary in
the reference, which orders by timestamp only).

Shuffles of event-sized data: one aggregation per event source (pages, interactions, identifies).
Everything after that is session-sized. No window runs over a raw key: firsts are aggregations
and the visit number is counted in slices of time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import rules as R
from ..functions.text import md5_key, rx, url_host_path
from ..operators.relational import (anti_join, first_per_key, left_join_nullable, order_struct,
                                    row_number_skew_safe, spread_null_key)
from ..session import write_table

LANDING = [("anonymous_id", "anonymous_id"), ("user_id", "user_id"), ("campaign_name", "campaign"),
           ("campaign_source", "source"), ("campaign_medium", "medium"), ("campaign_content", "content"),
           ("campaign_term", "term"), ("page_initial_referrer_domain", "referrer_domain"), ("gclid", "gclid"),
           ("affiliate_code", "affiliate_code"), ("page_full_path", "first_page_visited"),
           ("user_agent", "user_agent")]
SESSION_COLS = ["anonymous_id", "user_id", "session_id", "pageviews", "session_start_time", "session_end_time",
                "campaign", "source", "medium", "content", "term", "referrer_domain", "gclid", "affiliate_code",
                "first_page_visited", "user_agent"]
MODEL_COLS = ["anonymous_id", "session_id", "first_user_by_anonymous", "first_user_by_session", "attribution_id",
              "pageviews", "session_start_time", "session_end_time", "device", "is_cherry",
              "default_channel_grouping", "ad_group_id", "campaign", "source", "medium", "content", "keyword",
              "term", "referrer_domain", "gclid", "affiliate_code", "first_page_visited", "session_by_anonymous"]


def _landing_struct(cols):
    return F.struct(*[(F.col(src) if src else F.lit(None).cast("string")).alias(dst) for src, dst in cols])


def session_rollup(events: DataFrame, key: str = "session_id", ts: str = "original_timestamp",
                   distinct_col: str | None = None) -> DataFrame:
    """Count (or distinct count), first and last timestamp per session."""
    n = F.countDistinct(distinct_col) if distinct_col else F.count(F.lit(1))
    return events.groupBy(key).agg(n.alias("pageviews"), F.min(ts).alias("session_start_time"),
                                   F.max(ts).alias("session_end_time"))


def page_sessions(pageviews: DataFrame) -> DataFrame:
    """Landing row (``session_step = 1``) joined with the session rollup, in one aggregation.

    Every step-1 row is kept (collected, then exploded), so duplicate landing rows multiply and
    sessions without a step 1 vanish, exactly like the reference's join (R15)."""
    landing = F.when(F.col("session_step") == 1, _landing_struct(LANDING))
    agg = (pageviews.filter(F.col("session_id").isNotNull())
           .groupBy("session_id")
           .agg(F.count(F.lit(1)).alias("pageviews"),
                F.min("original_timestamp").alias("session_start_time"),
                F.max("original_timestamp").alias("session_end_time"),
                F.collect_list(landing).alias("_landing")))
    return agg.select("session_id", "pageviews", "session_start_time", "session_end_time",
                      F.explode("_landing").alias("l")).select("*", "l.*").drop("l")


def interaction_sessions(interactions: DataFrame, pageviews: DataFrame,
                         tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sessions that have interactions but no page view: anti-join (J4), then first interaction
    (``session_step = 1``, W3) and distinct-URL rollup in one aggregation."""
    inter = anti_join(interactions.filter(F.col("session_id").isNotNull()), pageviews, "session_id")
    inter = inter.withColumn("page_full_path", url_host_path("page_url", "page_path"))
    cols = [(s if s != "affiliate_code" else None, d) for s, d in LANDING]
    first = F.min_by(_landing_struct(cols), order_struct(["original_timestamp", *tiebreak]))
    agg = (inter.groupBy("session_id")
           .agg(F.countDistinct("page_url").alias("pageviews"),
                F.min("original_timestamp").alias("session_start_time"),
                F.max("original_timestamp").alias("session_end_time"),
                first.alias("l")))
    return agg.select("*", "l.*").drop("l")


def build_sessions(pageviews: DataFrame, interactions: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Pages first; interaction-only sessions appended with a typed NULL affiliate code."""
    p = page_sessions(pageviews).select(*SESSION_COLS)
    i = interaction_sessions(interactions, pageviews, tiebreak).select(*SESSION_COLS)
    return p.unionByName(i)


def first_identity(identifies: DataFrame, key: str, out: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First known user per visitor or per session (D4, W1/W2): ``row_number() = 1`` as an aggregation."""
    ident = identifies.filter(F.col("user_id").isNotNull() & F.col(key).isNotNull())
    return first_per_key(ident, [key], ["original_timestamp", *tiebreak], ["user_id"]).withColumnRenamed("user_id", out)


def internal_visitors(sessions: DataFrame, clients: DataFrame) -> DataFrame:
    """Visitors with a session from the internal host or by a partner client.

    Partners are met by a semi-join on (visitor, user) rows: where they are few it is a broadcast, where they are too many
    for one Spark filters the sessions by a Bloom filter of the partners' keys before they are shuffled. NULL users take no part."""
    partners = (clients.filter(F.col("is_company_partner").eqNullSafe(True) & F.col("korys_client_id").isNotNull())
                .select(F.col("korys_client_id").alias("user_id")))
    known = sessions.filter(F.col("anonymous_id").isNotNull())
    host = known.filter(rx("referrer_domain", R.INTERNAL_REFERRER)).select("anonymous_id")
    by_partner = known.filter(F.col("user_id").isNotNull()).select("anonymous_id", "user_id").join(partners, "user_id", "left_semi")
    return host.unionByName(by_partner.select("anonymous_id")).distinct()


def visitor_dimension(identifies: DataFrame, internal: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per visitor: first user and internal flag, so sessions need a single visitor join."""
    first = first_identity(identifies, "anonymous_id", "first_user_by_anonymous", tiebreak) \
        .withColumn("_internal", F.lit(False))
    flags = internal.select("anonymous_id", F.lit(None).cast("string").alias("first_user_by_anonymous"),
                            F.lit(True).alias("_internal"))
    return (first.unionByName(flags).groupBy("anonymous_id")
            .agg(F.max("first_user_by_anonymous").alias("first_user_by_anonymous"),
                 F.max("_internal").alias("is_cherry")))


def tag_sessions(sessions: DataFrame, identifies: DataFrame, clients: DataFrame,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sessions with their visit number (W4), first users, internal flag, device and channel. The number needs the
    sessions alone, so it is counted before the joins. ``sessions`` is read several times: write it first."""
    visitors = visitor_dimension(identifies, internal_visitors(sessions, clients), tiebreak)
    by_session = first_identity(identifies, "session_id", "first_user_by_session", tiebreak)
    s = row_number_skew_safe(sessions, ["anonymous_id"], ["session_start_time", "session_id"], "session_by_anonymous", written=True)
    s = s.join(by_session, "session_id", "left")
    s = left_join_nullable(s, visitors, "anonymous_id", "anonymous_id", salt="session_id")
    return (s.withColumn("is_cherry", F.coalesce(F.col("is_cherry"), F.lit(False)))
             .withColumn("device", C.device("user_agent"))
             .withColumn("default_channel_grouping", C.channel()))


def attribution_id(ad_group_id="ad_group_id", keyword="keyword") -> F.Column:
    """MD5 of ten ``|``-joined fields; NULL text → 'NULL', NULL ad group → -1."""
    nul = F.lit("NULL")
    return md5_key(F.coalesce(F.col(ad_group_id), F.lit(-1)),
                   *[F.coalesce(F.col(c), nul) for c in ("campaign", "source", "medium", "content", "term")],
                   F.coalesce(F.col(keyword), nul),
                   *[F.coalesce(F.col(c), nul) for c in ("referrer_domain", "affiliate_code",
                                                          "default_channel_grouping")])


def session_model(pageviews: DataFrame, interactions: DataFrame, identifies: DataFrame, gads: DataFrame,
                  clients: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The full sessions model (D9): tagged sessions fanned out by the distinct ad clicks (J9). The sessions are built and
    written once; the internal visitors, the slices of the ranking and the ranking itself read that table."""
    sessions = write_table(build_sessions(pageviews, interactions, tiebreak), "sessions-built")
    tagged = tag_sessions(sessions, identifies, clients, tiebreak)
    ads = (gads.select("gclid", "ad_group_id", F.col("keyword_info_text").alias("keyword")).distinct()
           .withColumnRenamed("gclid", "gclid_ad"))
    fanned = (tagged.withColumn("_gk", spread_null_key("gclid", "session_id"))
              .join(ads.withColumn("_gk", F.col("gclid_ad").cast("string")).drop("gclid_ad"), "_gk", "left")
              .drop("_gk"))
    return fanned.withColumn("attribution_id", attribution_id()).select(*MODEL_COLS)
