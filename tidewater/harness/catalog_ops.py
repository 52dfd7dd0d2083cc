"""
library on the stand-ins; its oracle selects from the CTEs of the model oracles
(or states the expected value where the input was built for it)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import rules as R
from ..functions.text import (before_optionally, clean_or_null, concat_skip_nulls, core_count, cpu_arch,
                              cut_upgradeable, gpu_core_count, join_nonblank, key_fallback, md5_key, regex_group, rx,
                              to_utc, url_host_path)
from ..operators.html import storage_part
from ..operators.relational import anti_join, row_number_skew_safe, spread_null_key
from ..plans import funnel as FN
from ..plans import roi as RO
from ..plans import sessions as SS
from ..plans.price_plans import union_price_lists
from . import oracle_models as O
from .catalog import TIEBREAK, leads_df, plans_df, register, sessions_df, with_inputs
from .standins import PRICE_LISTS, Inputs


def sess_sql(final: str, extra=()) -> str:
    return with_inputs(O.SESSIONS_INPUTS + list(extra), O.SESSIONS_CTES, final=final)


def funnel_sql(final: str) -> str:
    return with_inputs(O.FUNNEL_INPUTS, O.SESSIONS_CTES, O.FUNNEL_CTES, final=final)


def roi_sql(final: str) -> str:
    return with_inputs(O.ROI_INPUTS, O.ROI_CTES, final=final)


def plans_sql(final: str) -> str:
    return with_inputs(O.PLANS_INPUTS, O.PLANS_CTES, final=final)


def _sessions(i: Inputs):
    return SS.build_sessions(i["pageviews"], i["interactions"], TIEBREAK)


def _after_anti(i: Inputs):
    return anti_join(i["interactions"], i["pageviews"], "session_id")


# ------------------------------------------------------------------------------------------------
# sessions: projections, filters, aggregates, windows, joins
# ------------------------------------------------------------------------------------------------
@register("project_rename", with_inputs(["pageviews"], final="SELECT event_id, " + ", ".join(
    f"{s} AS {d}" for s, d in SS.LANDING) + " FROM pageviews"))
def project_rename(spark, sf):
    return Inputs(spark, sf)["pageviews"].select("event_id", *[F.col(s).alias(d) for s, d in SS.LANDING])


@register("project_star_plus", with_inputs(["pageviews"], final=f"SELECT *, {O.device_sql('user_agent')} AS device "
                                                                   "FROM pageviews"))
def project_star_plus(spark, sf):
    return Inputs(spark, sf)["pageviews"].withColumns({"device": C.device("user_agent")})


@register("filter_compare", with_inputs(["pageviews"], final="""SELECT event_id FROM pageviews
WHERE session_step = 1 AND campaign_medium = 'cpc' AND original_timestamp >= TIMESTAMP '2024-01-15 00:00:00'"""))
def filter_compare(spark, sf):
    pv = Inputs(spark, sf)["pageviews"]
    return pv.filter((F.col("session_step") == 1) & (F.col("campaign_medium") == "cpc")
                     & (F.col("original_timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))).select("event_id")


@register("filter_nulls", with_inputs(["web_events"], final="""SELECT event_id FROM web_events
WHERE user_id IS NULL AND session_id IS NOT NULL"""))
def filter_nulls(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    return w.filter(F.col("user_id").isNull() & F.col("session_id").isNotNull()).select("event_id")


_SOCIAL_FLAG = (f"({O.m('campaign_medium', R.SOCIAL_MEDIUM)}) OR (campaign_medium IS NOT NULL AND "
                f"{O.m('campaign_source', R.SOCIAL_SOURCE)})")


@register("filter_bool_3vl", with_inputs(["web_events"], final=f"SELECT event_id, {_SOCIAL_FLAG} AS flag FROM web_events"))
def filter_bool_3vl(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    me, so = F.col("campaign_medium"), F.col("campaign_source")
    return w.select("event_id", (rx(me, R.SOCIAL_MEDIUM) | (me.isNotNull() & rx(so, R.SOCIAL_SOURCE))).alias("flag"))


@register("case_searched", with_inputs(["web_events"], final=f"SELECT event_id, {O.device_sql('user_agent')} AS device "
                                                              "FROM web_events"))
def case_searched(spark, sf):
    return Inputs(spark, sf)["web_events"].select("event_id", C.device("user_agent").alias("device"))


register("classify_device", with_inputs(
    ["web_events"], final=f"SELECT event_id, {O.device_sql('user_agent')} AS device FROM web_events"))(case_searched)

_CH_EV = """ch_ev AS (SELECT event_id, campaign_name AS campaign, campaign_source AS source, campaign_medium AS medium,
  campaign_content AS content, campaign_term AS term, gclid, affiliate_code,
  page_initial_referrer_domain AS referrer_domain FROM web_events)"""


@register("classify_channel", with_inputs(["web_events"], _CH_EV,
                                          final=f"SELECT event_id, {O.channel_sql('e.')} AS channel FROM ch_ev e"))
def classify_channel(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    return w.select("event_id", C.channel("campaign_name", "campaign_source", "campaign_medium", "campaign_content",
                                          "campaign_term", "gclid", "affiliate_code",
                                          "page_initial_referrer_domain").alias("channel"))


@register("fn_url_host_path", with_inputs(["interactions"], final=(
    f"SELECT event_id, {O.url_host_path_sql('page_url', 'page_path')} AS page_full_path FROM interactions")))
def fn_url_host_path(spark, sf):
    return Inputs(spark, sf)["interactions"].select("event_id", url_host_path("page_url", "page_path")
                                                    .alias("page_full_path"))


@register("fn_concat_nulls", with_inputs(["web_events"], final="""SELECT event_id,
  CONCAT(campaign_name, campaign_source) AS skip_nulls, campaign_name || campaign_source AS propagate_nulls
FROM web_events"""))
def fn_concat_nulls(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    return w.select("event_id", concat_skip_nulls("campaign_name", "campaign_source").alias("skip_nulls"),
                    F.concat("campaign_name", "campaign_source").alias("propagate_nulls"))


@register("fn_surrogate_key", with_inputs(["web_events"], final="""SELECT event_id,
  MD5(CONCAT_WS('|', COALESCE(anonymous_id, 'NULL'), COALESCE(user_id, 'NULL'))) AS lead_key,
  MD5(CONCAT_WS('|', campaign_name, event_id % 3 - 1, campaign_source)) AS skip_key
FROM web_events"""))
def fn_surrogate_key(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    return w.select("event_id",
                    md5_key(F.coalesce("anonymous_id", F.lit("NULL")), F.coalesce("user_id", F.lit("NULL")))
                    .alias("lead_key"),
                    md5_key("campaign_name", F.col("event_id") % 3 - 1, "campaign_source").alias("skip_key"))


@register("fn_coalesce", with_inputs(["web_events"], final="""SELECT event_id,
  COALESCE(campaign_name, 'NULL') AS campaign, COALESCE(gclid, affiliate_code, campaign_source, 'none') AS first_set
FROM web_events"""))
def fn_coalesce(spark, sf):
    w = Inputs(spark, sf)["web_events"]
    return w.select("event_id", F.coalesce("campaign_name", F.lit("NULL")).alias("campaign"),
                    F.coalesce("gclid", "affiliate_code", "campaign_source", F.lit("none")).alias("first_set"))


@register("filter_is_true", with_inputs(["clients"], final="SELECT korys_client_id FROM clients "
                                                           "WHERE is_company_partner IS TRUE"))
def filter_is_true(spark, sf):
    c = Inputs(spark, sf)["clients"]
    return c.filter(F.col("is_company_partner").eqNullSafe(True)).select("korys_client_id")


@register("filter_regex", with_inputs(["web_forms"], final=f"SELECT * FROM web_forms "
                                                           f"WHERE {O.m('form_name', R.THINK_FORM_PATTERN)}"))
def filter_regex(spark, sf):
    return Inputs(spark, sf)["web_forms"].filter(rx("form_name", R.THINK_FORM_PATTERN))


@register("filter_not_in_null", with_inputs(["web_orders"], final=f"SELECT * FROM web_orders "
                                                                 f"WHERE order_type NOT IN {O.in_list(R.DO_ORDER_TYPES)}"))
def filter_not_in_null(spark, sf):
    return Inputs(spark, sf)["web_orders"].filter(~F.col("order_type").isin(*R.DO_ORDER_TYPES))


@register("filter_in", with_inputs(["sales"], final=f"SELECT partner_id, attribution_id, amount, invoice_state "
                                                    f"FROM sales WHERE invoice_state IN {O.in_list(R.PAID_INVOICE_STATES)}"))
def filter_in(spark, sf):
    s = Inputs(spark, sf)["sales"]
    return s.filter(F.col("invoice_state").isin(*R.PAID_INVOICE_STATES)).select(
        "partner_id", "attribution_id", "amount", "invoice_state")


def _rollup(spark, sf):
    return SS.session_rollup(Inputs(spark, sf)["pageviews"])


register("session_rollup", sess_sql("SELECT * FROM page_rollup"))(_rollup)


@register("agg_count", sess_sql("SELECT session_id, pageviews FROM page_rollup"))
def agg_count(spark, sf):
    return _rollup(spark, sf).select("session_id", "pageviews")


@register("agg_min_max", sess_sql("SELECT session_id, session_start_time, session_end_time FROM page_rollup"))
def agg_min_max(spark, sf):
    return _rollup(spark, sf).select("session_id", "session_start_time", "session_end_time")


@register("agg_count_distinct", sess_sql("SELECT * FROM pageless_rollup"))
def agg_count_distinct(spark, sf):
    return SS.session_rollup(_after_anti(Inputs(spark, sf)), distinct_col="page_url")


@register("join_left_anti", sess_sql("SELECT event_id FROM pageless"))
def join_left_anti(spark, sf):
    return _after_anti(Inputs(spark, sf)).select("event_id")


@register("window_session_step", sess_sql("SELECT event_id, session_id, session_step FROM pageless"))
def window_session_step(spark, sf):
    steps = row_number_skew_safe(_after_anti(Inputs(spark, sf)), ["session_id"], ["original_timestamp", "event_id"],
                                 "session_step")
    return steps.select("event_id", "session_id", "session_step")


@register("join_self_agg", sess_sql("""SELECT session_id, r.* EXCLUDE (session_id), campaign_name AS campaign, page_full_path AS first_page_visited
FROM page_rollup r JOIN pageviews USING (session_id) WHERE session_step = 1"""))
def join_self_agg(spark, sf):
    return SS.page_sessions(Inputs(spark, sf)["pageviews"]).select(
        "session_id", "pageviews", "session_start_time", "session_end_time", "campaign", "first_page_visited")


def _sessions_union(spark, sf):
    return _sessions(Inputs(spark, sf))


register("sessions_union", sess_sql("SELECT * FROM all_sessions"))(_sessions_union)
register("union_all_typed_null", sess_sql("SELECT * FROM all_sessions"))(_sessions_union)


def _first_by_visitor(spark, sf):
    return SS.first_identity(Inputs(spark, sf)["identifies"], "anonymous_id", "first_user_by_anonymous", TIEBREAK)


_FIRST_SQL = sess_sql("SELECT anonymous_id, user_id AS first_user_by_anonymous FROM known_visitors")
register("first_identity", _FIRST_SQL)(_first_by_visitor)
register("window_first_per_key", _FIRST_SQL)(_first_by_visitor)


@register("window_first_per_session", sess_sql("SELECT session_id, user_id AS first_user_by_session "
                                               "FROM known_sessions"))
def window_first_per_session(spark, sf):
    return SS.first_identity(Inputs(spark, sf)["identifies"], "session_id", "first_user_by_session", TIEBREAK)


@register("internal_traffic", sess_sql("SELECT anonymous_id FROM insiders"))
def internal_traffic(spark, sf):
    i = Inputs(spark, sf)
    return SS.internal_visitors(_sessions(i), i["clients"])


def _tagged(spark, sf):
    i = Inputs(spark, sf)
    return SS.tag_sessions(_sessions(i), i["identifies"], i["clients"], TIEBREAK)


@register("membership_flag", sess_sql("SELECT session_id, is_cherry FROM labelled_sessions"))
def membership_flag(spark, sf):
    return _tagged(spark, sf).select("session_id", "is_cherry")


@register("join_left", sess_sql("SELECT session_id, first_user_by_session FROM labelled_sessions"))
def join_left(spark, sf):
    i = Inputs(spark, sf)
    firsts = SS.first_identity(i["identifies"], "session_id", "first_user_by_session", TIEBREAK)
    return _sessions(i).join(firsts, "session_id", "left").select("session_id", "first_user_by_session")


@register("window_visit_number", sess_sql("SELECT session_id, session_by_anonymous FROM labelled_sessions"))
def window_visit_number(spark, sf):
    ranked = row_number_skew_safe(_sessions(Inputs(spark, sf)), ["anonymous_id"], ["session_start_time", "session_id"],
                                  "session_by_anonymous")
    return ranked.select("session_id", "session_by_anonymous")


@register("join_fanout", sess_sql("""SELECT session_id, gclid, ad_group_id, keyword_info_text AS keyword
FROM all_sessions LEFT JOIN ad_clicks USING (gclid)"""))
def join_fanout(spark, sf):
    i = Inputs(spark, sf)
    ads = i["gads"].select(F.col("gclid").alias("ad_gclid"), "ad_group_id",
                           F.col("keyword_info_text").alias("keyword")).distinct()
    s = _sessions(i).select("session_id", "gclid")
    return (s.withColumn("_gk", spread_null_key("gclid", "session_id"))
            .join(ads.withColumnRenamed("ad_gclid", "_gk"), "_gk", "left").drop("_gk"))


@register("distinct_rows", sess_sql("SELECT * FROM ad_clicks"))
def distinct_rows(spark, sf):
    return Inputs(spark, sf)["gads"].select("gclid", "ad_group_id", "keyword_info_text").distinct()


@register("attribution_key", sess_sql("SELECT session_id, ad_group_id, attribution_id FROM model_sessions"))
def attribution_key(spark, sf):
    return sessions_df(Inputs(spark, sf)).select("session_id", "ad_group_id", "attribution_id")


# ------------------------------------------------------------------------------------------------
# lead funnel
# ------------------------------------------------------------------------------------------------
def _stages(spark, sf):
    i = Inputs(spark, sf)
    return FN.lead_stages(sessions_df(i), i["dim_clients"], i["web_orders"], i["web_forms"], i["sales"],
                          i["resources"], i["teams"])


def _see(spark, sf):
    return FN.see_stage(sessions_df(Inputs(spark, sf)))


register("funnel_see", funnel_sql("SELECT * FROM first_visits"))(_see)
register("window_two_rank_filter", funnel_sql("SELECT * FROM first_visits"))(_see)


@register("window_user_step", funnel_sql("SELECT session_id, attribution_id, user_step FROM visit_steps"))
def window_user_step(spark, sf):
    s = sessions_df(Inputs(spark, sf)).filter(F.col("anonymous_id").isNotNull())
    ranked = row_number_skew_safe(s, ["first_user_by_anonymous"],
                                  ["session_start_time", "anonymous_id", "session_id", "attribution_id"], "user_step")
    return ranked.select("session_id", "attribution_id", "user_step")


_THINK_COLS = "anonymous_id, korys_client_id, attribution_id, see_entered_at, think_entered_at"


def _think(spark, sf):
    return _stages(spark, sf).select("anonymous_id", "korys_client_id", "attribution_id", "see_entered_at",
                                     "think_entered_at")


register("funnel_think", funnel_sql(f"SELECT {_THINK_COLS} FROM lead_stages"))(_think)
register("join_full_coalesce", funnel_sql(f"SELECT {_THINK_COLS} FROM lead_stages"))(_think)


@register("funnel_do", funnel_sql(f"SELECT {_THINK_COLS}, do_entered_at FROM lead_stages"))
def funnel_do(spark, sf):
    return _stages(spark, sf).select("anonymous_id", "korys_client_id", "attribution_id", "see_entered_at",
                                     "think_entered_at", "do_entered_at")


@register("funnel_care", funnel_sql(f"SELECT {_THINK_COLS}, do_entered_at, care_entered_at FROM lead_stages"))
def funnel_care(spark, sf):
    return _stages(spark, sf).select("anonymous_id", "korys_client_id", "attribution_id", "see_entered_at",
                                     "think_entered_at", "do_entered_at", "care_entered_at")


@register("fn_least_nulls", funnel_sql("SELECT anonymous_id, korys_client_id, think_entered_at, do_entered_at FROM lead_stages"))
def fn_least_nulls(spark, sf):
    return _stages(spark, sf).select("anonymous_id", "korys_client_id", "think_entered_at", "do_entered_at")


@register("funnel_backfill", funnel_sql("SELECT lead_id, see_entered_at, think_entered_at, do_entered_at, "
                                        "care_entered_at FROM model_leads"))
def funnel_backfill(spark, sf):
    return leads_df(Inputs(spark, sf)).select("lead_id", "see_entered_at", "think_entered_at", "do_entered_at",
                                              "care_entered_at")


@register("gated_column", funnel_sql("SELECT lead_id, care_entered_at, care_exited_at FROM model_leads"))
def gated_column(spark, sf):
    return leads_df(Inputs(spark, sf)).select("lead_id", "care_entered_at", "care_exited_at")


@register("agg_first_touch", funnel_sql("""SELECT * FROM visitor_firsts
WHERE coalesce(order_page_at, order_try_at, think_form_at, do_form_at) IS NOT NULL"""))
def agg_first_touch(spark, sf):
    i = Inputs(spark, sf)
    t = FN.visitor_touches(i["web_orders"], i["web_forms"])
    return t.filter(F.coalesce("order_page_at", "order_try_at", "think_form_at", "do_form_at").isNotNull())


@register("agg_churn_date", funnel_sql("SELECT korys_client_id, CAST(churn_date AS TIMESTAMP) AS churn_date FROM departures"))
def agg_churn_date(spark, sf):
    i = Inputs(spark, sf)
    return FN.churn_dates(i["resources"], i["teams"])


@register("join_inner", funnel_sql("""SELECT resource_id, team_owner_client_id,
  least(date_cancel, resource_value_date) AS date_end
FROM teams, resources WHERE odoo_partner_id = partner_id"""))
def join_inner(spark, sf):
    i = Inputs(spark, sf)
    owners = i["teams"].select(F.col("odoo_partner_id").alias("partner_id"), "team_owner_client_id")
    return (i["resources"].join(owners, "partner_id")
            .select("resource_id", "team_owner_client_id",
                    F.least("date_cancel", "resource_value_date").alias("date_end")))


@register("fn_to_utc", with_inputs(["web_orders"], final="""SELECT anonymous_id, order_type, original_timestamp AS ts_utc,
  CAST(timezone('UTC', timezone('America/New_York', original_timestamp)) AS TIMESTAMP) AS from_new_york
FROM web_orders"""))
def fn_to_utc(spark, sf):
    """An instant (whatever the session's zone), and a wall clock of another zone."""
    o = Inputs(spark, sf)["web_orders"]
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "original_timestamp"))
    return o.select("anonymous_id", "order_type", to_utc(instant).alias("ts_utc"),
                    to_utc("original_timestamp", "America/New_York").alias("from_new_york"))


# ------------------------------------------------------------------------------------------------
# ROI
# ------------------------------------------------------------------------------------------------
def _ltv(spark, sf):
    i = Inputs(spark, sf)
    ltv = RO.cohort_ltv(i["sales"], i["teams"], i["attribution"])
    return ltv.select("month", "gads_ltv", "affiliate_ltv")


_LTV_SQL = roi_sql("SELECT month, gads_ltv, affiliate_ltv FROM cohort_value")
register("cohort_ltv", _LTV_SQL)(_ltv)
register("agg_conditional_sum", _LTV_SQL)(_ltv)


@register("join_star", roi_sql(f"""SELECT partner_id, attribution_id, amount, first_order_date, medium, default_channel_grouping
FROM attribution JOIN sales USING (attribution_id), teams
WHERE odoo_partner_id = partner_id AND invoice_state IN {O.in_list(R.PAID_INVOICE_STATES)}"""))
def join_star(spark, sf):
    i = Inputs(spark, sf)
    s = i["sales"].filter(F.col("invoice_state").isin(*R.PAID_INVOICE_STATES))
    t = i["teams"].select(F.col("odoo_partner_id").alias("partner_id"), "first_order_date")
    a = i["attribution"].select("attribution_id", "medium", "default_channel_grouping")
    return s.join(t, "partner_id").join(a, "attribution_id").select(
        "partner_id", "attribution_id", "amount", "first_order_date", "medium", "default_channel_grouping")


@register("agg_sum_by_month", roi_sql("SELECT month, total_ad_costs FROM ad_months"))
def agg_sum_by_month(spark, sf):
    return RO.monthly_sum(Inputs(spark, sf)["ad_cost"], "date", "cost", "total_ad_costs")


@register("fn_guarded_ratio", roi_sql("SELECT month, gads_ROI, affiliate_ROI FROM model_roi_monthly"))
def fn_guarded_ratio(spark, sf):
    from .catalog import roi_df
    return roi_df(Inputs(spark, sf)).select("month", "gads_ROI", "affiliate_ROI")


# ------------------------------------------------------------------------------------------------
# price plans
# ------------------------------------------------------------------------------------------------
@register("union_all_many", plans_sql("SELECT * FROM p_all_plans"))
def union_all_many(spark, sf):
    i = Inputs(spark, sf)
    return union_price_lists([i[n] for n in PRICE_LISTS])


@register("join_left_or_keys", plans_sql("SELECT plan_id, location, region FROM plans_location"))
def join_left_or_keys(spark, sf):
    from .catalog import plans_location
    return plans_location(spark, sf).select("plan_id", "location", "region")


def _plans_cols(*cols):
    def fn(spark, sf):
        return plans_df(Inputs(spark, sf)).select("plan_id", *cols)
    return fn


for _name, _col in [("classify_cpu_vendor", "cpu_vendor"), ("classify_region", "custom_region"),
                    ("classify_cpu_family", "cpu_family"), ("extract_cpu_number", "cpu_model_number"),
                    ("fn_regex_group", "cpu_model_number"), ("derive_cpu_generation", "cpu_generation"),
                    ("case_coalesce_cascade", "cpu_generation")]:
    register(_name, plans_sql(f"SELECT plan_id, {_col} FROM model_price_plans"))(_plans_cols(_col))


@register("filter_regex_ci", plans_sql(f"SELECT plan_id, cpu_model FROM plans_location "
                                       f"WHERE {O.m('cpu_model', R.VENDOR_AMD, True)}"))
def filter_regex_ci(spark, sf):
    from .catalog import plans_location
    return plans_location(spark, sf).filter(rx("cpu_model", R.VENDOR_AMD, ci=True)).select("plan_id", "cpu_model")


_RYZEN_CASE = "CASE {g} " + " ".join(f"WHEN '{d}' THEN {v}" for d, v in R.GEN_RYZEN_THOUSANDS) + " END"


@register("case_simple", plans_sql("SELECT plan_id, " + _RYZEN_CASE.format(g=O.grp("cpu_model_number", "^([0-9])"))
                                   + " AS thousands_generation FROM model_price_plans"))
def case_simple(spark, sf):
    m = F.create_map(*[x for d, v in R.GEN_RYZEN_THOUSANDS for x in (F.lit(d), F.lit(v))])
    p = plans_df(Inputs(spark, sf))
    return p.select("plan_id", F.try_element_at(m, regex_group("cpu_model_number", "^([0-9])"))
                    .alias("thousands_generation"))


@register("cast_int", plans_sql(f"SELECT plan_id, CAST({O.grp('cpu_model', R.GEN_VERSION_SUFFIX)} AS INTEGER) AS version "
                                "FROM plans_location"))
def cast_int(spark, sf):
    from .catalog import plans_location
    return plans_location(spark, sf).select("plan_id", regex_group("cpu_model", R.GEN_VERSION_SUFFIX).cast("int")
                                            .alias("version"))


@register("fn_case", plans_sql(f"""SELECT plan_id, lower(cpu_model) AS lower_model, upper(cpu_model) AS upper_model,
  'Xeon ' || upper({O.grp('cpu_model', R.CPU_E57_FAMILY, True)}) AS xeon_line FROM plans_location"""))
def fn_case(spark, sf):
    from .catalog import plans_location
    p = plans_location(spark, sf)
    return p.select("plan_id", F.lower("cpu_model").alias("lower_model"), F.upper("cpu_model").alias("upper_model"),
                    F.concat(F.lit("Xeon "), F.upper(regex_group("cpu_model", R.CPU_E57_FAMILY, ci=True)))
                    .alias("xeon_line"))


# ------------------------------------------------------------------------------------------------
# page text functions on the matrix parts and on whole documents
# ------------------------------------------------------------------------------------------------
_WS = ("[\\t\\n\\x0b\\f\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}"
       "\\x{3000}]+")


@register("fn_clean_text", with_inputs([], final=f"""SELECT doc_id,
  NULLIF(trim(regexp_replace(regexp_replace(text, '[™®©]', '', 'g'), '{_WS}', ' ', 'g')), '') AS clean
FROM documents"""))
def fn_clean_text(spark, sf):
    d = Inputs(spark, sf)["documents"]
    return d.select("doc_id", clean_or_null("text").alias("clean"))


@register("fn_cut_clause", with_inputs(["matrix_parts"], final="""SELECT k,
  regexp_replace(ram_text, '(?is)\\s*Upgradeable.*\\z', '') AS ram,
  (regexp_split_to_array(nvme_text, '(?i)\\boptionally\\b'))[1] AS nvme
FROM matrix_parts"""))
def fn_cut_clause(spark, sf):
    p = Inputs(spark, sf)["matrix_parts"]
    return p.select("k", cut_upgradeable("ram_text").alias("ram"), before_optionally("nvme_text").alias("nvme"))


@register("fn_core_count", with_inputs(["matrix_parts"], final="""SELECT k,
  CAST(CASE s % 4 WHEN 0 THEN 8 WHEN 1 THEN s WHEN 2 THEN NULL ELSE 6 END AS INTEGER) AS cores,
  CAST(CASE s % 3 WHEN 0 THEN s + s % 8 ELSE s END AS INTEGER) AS gpu_cores
FROM matrix_parts"""))
def fn_core_count(spark, sf):
    p = Inputs(spark, sf)["matrix_parts"]
    raw = F.when(F.col("s") % 3 == 0, F.concat(F.col("s").cast("string"), F.lit(" Performance Cores "),
                                               (F.col("s") % 8).cast("string"), F.lit(" Efficient Cores"))) \
        .when(F.col("s") % 3 == 1, F.concat(F.col("s").cast("string"), F.lit(" Cores"))) \
        .otherwise(F.col("s").cast("string"))
    return p.select("k", core_count("detail_text").alias("cores"), gpu_core_count(raw).alias("gpu_cores"))


@register("fn_cpu_arch", with_inputs(["matrix_parts"], final="""SELECT k,
  CASE s % 3 WHEN 0 THEN 'Zen 4' WHEN 1 THEN NULL ELSE 'Raptor Lake' END AS cpu_arch FROM matrix_parts"""))
def fn_cpu_arch(spark, sf):
    return Inputs(spark, sf)["matrix_parts"].select("k", cpu_arch("detail_text").alias("cpu_arch"))


@register("fn_compose_list", with_inputs(["matrix_parts"], final="""SELECT k, NULLIF(concat_ws(', ',
  CASE WHEN k % 3 = 1 THEN concat('2 x ', CAST(s * 64 AS VARCHAR), ' GB NVMe') END,
  CASE WHEN k % 4 = 1 THEN concat(CAST(s * 100 AS VARCHAR), ' GB SSD') END,
  CASE WHEN k % 5 = 0 THEN concat(CAST(s AS VARCHAR), ' TB HDD') END), '') AS storage FROM matrix_parts"""))
def fn_compose_list(spark, sf):
    p = Inputs(spark, sf)["matrix_parts"]
    parts = [storage_part(F.col(c), lbl) for c, lbl in (("nvme_text", "NVMe"), ("ssd_text", "SSD"),
                                                           ("hdd_text", "HDD"))]
    return p.select("k", join_nonblank(parts).alias("storage"))


@register("fn_key_fallback", with_inputs(["matrix_parts"], final="""SELECT k,
  CASE WHEN k % 5 = 1 THEN concat('h', CAST(k AS VARCHAR)) ELSE concat('m', CAST(k AS VARCHAR)) END AS monthly_key,
  CASE WHEN k % 3 = 0 THEN concat('h', CAST(k AS VARCHAR))
       ELSE concat('m', CAST(k AS VARCHAR)) END AS hourly_key
FROM matrix_parts WHERE k % 5 <> 1 OR k % 3 = 0"""))
def fn_key_fallback(spark, sf):
    p = Inputs(spark, sf)["matrix_parts"]
    k = F.col("k").cast("string")
    m = F.when(F.col("k") % 5 == 1, F.lit("")).otherwise(F.concat(F.lit("m"), k))
    h = F.when(F.col("k") % 3 == 0, F.concat(F.lit("h"), k)).otherwise(F.lit(""))
    mk, hk = key_fallback(m, h)
    return p.select("k", mk.alias("monthly_key"), hk.alias("hourly_key")).filter(F.col("monthly_key").isNotNull())

