"""Ordered rule tables turned into first-match-wins ``when`` chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import col_, regex_group, rx



def _null_str() -> Column:
    return F.lit(None).cast("string")


def _chain(branches, otherwise=None) -> Column:
    """[(condition, value), ...] → CASE WHEN ... (first match wins)."""
    (c0, v0), rest = branches[0], branches[1:]
    expr = F.when(c0, v0)
    for c, v in rest:
        expr = expr.when(c, v)
    return expr if otherwise is None else expr.otherwise(otherwise)


def _all_null(*cols) -> Column:
    return reduce(lambda a, b: a & b, [col_(c).isNull() for c in cols])


# ------------------------------------------------------------------------------------------------
# Sessions
# ------------------------------------------------------------------------------------------------
def device(user_agent) -> Column:
    ua = col_(user_agent)
    return _chain([(rx(F.lower(ua) if low else ua, pat), F.lit(label)) for label, pat, low in R.DEVICE_RULES],
                  _null_str())


def channel(campaign="campaign", source="source", medium="medium", content="content", term="term",
            gclid="gclid", affiliate_code="affiliate_code", referrer="referrer_domain") -> Column:
    """Default channel grouping; never NULL (falls through to ``Not set``)."""
    cm, so, me, co, te, gc, af, rf = map(col_, (campaign, source, medium, content, term, gclid,
                                                affiliate_code, referrer))
    paid = rx(me, R.PAID_MEDIUM)
    all7 = _all_null(cm, so, me, co, te, gc, af)   # written five times in the reference
    ai_gate = _all_null(cm, me, co, te, af)
    return _chain([
        (paid & rx(cm, R.PAID_SEARCH_CAMPAIGN), F.lit("Paid Search")),
        (paid & rx(cm, R.PAID_DISPLAY_CAMPAIGN), F.lit("Paid Display")),
        (paid & rx(cm, R.PAID_VIDEO_CAMPAIGN), F.lit("Paid Video")),
        (rx(me, R.SOCIAL_MEDIUM) | (me.isNotNull() & rx(so, R.SOCIAL_SOURCE)), F.lit("Paid Social")),
        (rx(me, R.EMAIL_MEDIUM_SOURCE) | rx(so, R.EMAIL_MEDIUM_SOURCE), F.lit("Email")),
        (paid, F.lit("Paid Other")),
        (ai_gate & (rx(so, R.AI_SOURCE) | rx(rf, R.AI_REFERRER)), F.lit("AI")),
        (all7 & rx(rf, R.ORGANIC_SEARCH_REFERRER), F.lit("Organic Search")),
        (all7 & rx(rf, R.ORGANIC_SOCIAL_REFERRER), F.lit("Organic Social")),
        (all7 & rx(rf, R.ORGANIC_VIDEO_REFERRER), F.lit("Organic Video")),
        (af.isNotNull(), F.lit("Affiliate")),
        (all7 & (rf.isNull() | rx(rf, R.DIRECT_ACS_REFERRER) | rx(rf, R.DIRECT_PAYMENT_REFERRER)),
         F.lit("Direct")),
        (all7 & rf.isNotNull(), F.lit("Referral")),
    ], F.lit("Not set"))


# ------------------------------------------------------------------------------------------------
# Price plans
# ------------------------------------------------------------------------------------------------
def cpu_vendor(model="cpu_model") -> Column:
    m = col_(model)
    return _chain([
        (rx(m, R.VENDOR_AMD, ci=True), F.lit("AMD")),
        (rx(m, R.VENDOR_INTEL, ci=True), F.lit("Intel")),
        (rx(m, R.VENDOR_INTEL_SKU_E, ci=True) | rx(m, R.VENDOR_INTEL_SKU_I, ci=True), F.lit("Intel")),
    ], _null_str())


def _not_intel_amd(vendor: Column) -> Column:
    # ``vendor NOT IN ('Intel','AMD')`` is NULL for a NULL vendor: the branch does not fire
    return ~vendor.isin("Intel", "AMD")


def cpu_family(model="cpu_model", vendor="cpu_vendor") -> Column:
    m, v = col_(model), col_(vendor)
    tiers = [(rx(m, pat, ci=True), F.lit(label)) for pat, label in R.CPU_SCALABLE_TIERS]
    return _chain([
        (_not_intel_amd(v), _null_str()),
        (rx(m, R.CPU_E57, ci=True), F.concat(F.lit("Xeon "), F.upper(regex_group(m, R.CPU_E57_FAMILY, ci=True)))),
        (rx(m, R.CPU_E3, ci=True), F.lit("Xeon E3")),
        (rx(m, R.CPU_XEON_E, ci=True), F.lit("Xeon E")),
        (rx(m, R.CPU_XEON_D, ci=True), F.lit("Xeon D")),
        *tiers,
        (rx(m, R.CPU_CORE_ULTRA, ci=True),
         F.concat(F.lit("Core Ultra "), regex_group(m, R.CPU_CORE_ULTRA_TIER, ci=True))),
        ((v == "Intel") & (rx(m, R.CPU_CORE_I_A, ci=True) | rx(m, R.CPU_CORE_I_B, ci=True)),
         F.concat(F.lit("Core "), F.lower(regex_group(m, R.CPU_CORE_I_TIER, ci=True)))),
        ((v == "Intel") & rx(m, R.CPU_XEON6, ci=True), F.lit("Xeon 6")),
        ((v == "Intel") & rx(m, R.CPU_XEON5, ci=True), F.lit("Xeon 5")),
        (rx(m, R.CPU_THREADRIPPER, ci=True), F.lit("Threadripper PRO")),
        (rx(m, R.CPU_RYZEN, ci=True), F.lit("Ryzen")),
        (rx(m, R.CPU_EPYC, ci=True) | ((v == "AMD") & rx(m, R.CPU_EPYC_BARE)), F.lit("EPYC")),
    ], _null_str())


def cpu_model_number(model="cpu_model", vendor="cpu_vendor") -> Column:
    m, v = col_(model), col_(vendor)
    return _chain([
        (_not_intel_amd(v), _null_str()),
        (rx(m, R.CPU_E57, ci=True), regex_group(m, R.CPU_E57_NUMBER, ci=True)),
        (rx(m, R.CPU_E3, ci=True), regex_group(m, R.CPU_E3_NUMBER, ci=True)),
        (rx(m, R.CPU_XEON_E, ci=True), regex_group(m, R.CPU_XEON_E_NUMBER, ci=True)),
        (rx(m, R.CPU_XEON_D, ci=True), regex_group(m, R.CPU_XEON_D_NUMBER, ci=True)),
        (rx(m, R.CPU_SCALABLE_ANY, ci=True), regex_group(m, R.CPU_SCALABLE_NUMBER, ci=True)),
        (rx(m, R.CPU_CORE_ULTRA, ci=True), regex_group(m, R.CPU_CORE_ULTRA_NUMBER, ci=True)),
        ((v == "Intel") & (rx(m, R.CPU_CORE_I_A, ci=True) | rx(m, R.CPU_CORE_I_B, ci=True)),
         regex_group(m, R.CPU_CORE_I_NUMBER, ci=True)),
        # guard is case-insensitive, the extraction is not
        ((v == "Intel") & rx(m, R.CPU_XEON56_GUARD, ci=True), regex_group(m, R.CPU_XEON56_NUMBER)),
        (v == "AMD", regex_group(m, R.CPU_AMD_NUMBER, ci=True)),
    ], _null_str())


def cpu_generation(model="cpu_model", vendor="cpu_vendor", family="cpu_family",
                   number="cpu_model_number") -> Column:
    m, v, f, n = map(col_, (model, vendor, family, number))
    intel, amd = (v == "Intel"), (v == "AMD")
    scalable = F.when(intel & f.isin(*R.GEN_SCALABLE_FAMILIES), _chain([
        (rx(n, R.GEN_XEON6_SKU, ci=True), F.lit(6)),
        (f == "Xeon 6", F.lit(6)),
        *[(rx(n, pat), F.lit(g)) for pat, g in R.GEN_SCALABLE_DIGIT],
    ]))
    xeon_d = F.when(intel & (f == "Xeon D"), _chain([(rx(n, pat), F.lit(g)) for pat, g in R.GEN_XEON_D]))
    xeon_e = F.when(intel & (f == "Xeon E"), _chain([(rx(n, pat), F.lit(g)) for pat, g in R.GEN_XEON_E]))
    (five, five_grp), (four, four_grp) = R.GEN_CORE_I_5DIGIT, R.GEN_CORE_I_4DIGIT
    core_i = F.when(intel & rx(f, R.GEN_CORE_I_FAMILY), _chain([
        (rx(n, five), regex_group(n, five_grp).cast("int")),
        (rx(n, four), regex_group(n, four_grp).cast("int")),
    ]))
    core_ultra = F.when(intel & rx(f, R.GEN_CORE_ULTRA_FAMILY), regex_group(n, R.GEN_LEADING_DIGIT).cast("int"))
    ryzen_map = F.create_map(*[x for d, g in R.GEN_RYZEN_THOUSANDS for x in (F.lit(d), F.lit(g))])
    amd_gen = _chain([
        *[(amd & (f == "EPYC") & rx(n, pat, ci=True), F.lit(g)) for pat, g in R.GEN_EPYC],
        (amd & f.isin(*R.GEN_RYZEN_FAMILIES), F.try_element_at(ryzen_map, regex_group(n, R.GEN_LEADING_DIGIT))),
    ])
    return F.coalesce(
        regex_group(m, R.GEN_VERSION_SUFFIX).cast("int"),
        regex_group(m, R.GEN_MARKER).cast("int"),
        scalable, xeon_d, xeon_e, core_i, core_ultra, amd_gen,
    ).cast("int")


def custom_region(region="region", location="location") -> Column:
    r, loc = col_(region), col_(location)
    return _chain([
        ((r == R.REGION_EU_US[0]) | (loc == R.REGION_EU_US[1]), F.lit("EU/US")),
        (r == R.REGION_AMERICAS, F.lit("Americas (non US)")),
    ], r)
