"""Golden rows for the rule tables (hand-derived by reading the rules; FIXTURES.md §3)."""
from pyspark.sql import functions as F

from tidewater.functions import classify as C
from tidewater.functions import text as T

CPU_ROWS = [
    # cpu_model, vendor, family, number, generation
    ("Intel Xeon E5-2680v4", "Intel", "Xeon E5", "2680", 4),
    ("Xeon E3-1240 v6", "Intel", "Xeon E3", "1240", 6),
    ("Intel Xeon E-2288G", "Intel", "Xeon E", "2288G", 2),
    ("Xeon-D 1540", "Intel", "Xeon D", "1540", 1),
    ("Intel Xeon Platinum 8358", "Intel", "Xeon Platinum", "8358", 3),
    ("Intel Xeon Gold 6142", "Intel", "Xeon Gold", "6142", 1),
    ("Intel Xeon Gold 6530P", "Intel", "Xeon Gold", "6530P", 6),
    ("Intel Xeon Gold 5515+", "Intel", "Xeon Gold", "5515+", 5),
    ("Intel Xeon Silver 4210", "Intel", "Xeon Silver", "4210", 2),
    ("Intel Xeon Bronze 3408U", "Intel", "Xeon Bronze", "3408U", 4),
    ("Intel Core Ultra 7 265K", "Intel", "Core Ultra 7", "265K", 2),
    ("Intel Core i9-13900K", "Intel", "Core i9", "13900K", 13),
    ("Intel Core i7-6700", "Intel", "Core i7", "6700", 6),
    ("Intel Core i5-1135G7 (Gen 11)", "Intel", "Core i5", "1135G", 11),
    ("Intel Xeon 6421N", "Intel", "Xeon 6", "6421N", 6),
    ("Intel Xeon 6421n", "Intel", "Xeon 6", None, 6),
    ("Intel Xeon 5412U", "Intel", "Xeon 5", "5412U", 4),
    ("AMD Ryzen Threadripper PRO 7965WX", "AMD", "Threadripper PRO", "7965WX", 4),
    ("AMD Ryzen 9 5950X", "AMD", "Ryzen", "5950X", 3),
    ("AMD EPYC 7402P", "AMD", "EPYC", "7402P", 2),
    ("AMD 4344P", "AMD", "EPYC", "4344P", 4),
    ("Marigold 1234", None, "Xeon Gold", "1234", None),
    ("Ampere Altra Q80-30", None, None, None, None),
]


def test_cpu_rules(spark):
    df = spark.createDataFrame([(r[0],) for r in CPU_ROWS], "cpu_model string")
    out = (df.withColumn("cpu_vendor", C.cpu_vendor())
             .withColumn("cpu_family", C.cpu_family())
             .withColumn("cpu_model_number", C.cpu_model_number())
             .withColumn("cpu_generation", C.cpu_generation()))
    got = {r.cpu_model: (r.cpu_vendor, r.cpu_family, r.cpu_model_number, r.cpu_generation)
           for r in out.collect()}
    for m, v, f, n, g in CPU_ROWS:
        assert got[m] == (v, f, n, g), (m, got[m])


CHANNEL_CASES = [
    (dict(medium="cpc", campaign="[S] brand"), "Paid Search"),
    (dict(medium="cpc", campaign="[D] x"), "Paid Display"),
    (dict(medium="cpc", campaign="[DG] x"), "Paid Display"),
    (dict(medium="ppc", campaign="[V] x"), "Paid Video"),
    (dict(medium="cpc", campaign="[S]"), "Paid Other"),
    (dict(medium="social"), "Paid Social"),
    (dict(medium="cpc", source="linkedin", campaign="x"), "Paid Social"),
    (dict(source="facebook"), "Not set"),
    (dict(medium="cpc", source="newsletter"), "Email"),
    (dict(medium="cpc", source="google", campaign="brand"), "Paid Other"),
    (dict(source="chatgpt.com", gclid="g1"), "AI"),
    (dict(referrer_domain="gemini.google.com"), "AI"),
    (dict(referrer_domain="www.google.com"), "Organic Search"),
    (dict(referrer_domain="accounts.google.com"), "Organic Search"),
    (dict(referrer_domain="t.co"), "Organic Social"),
    (dict(referrer_domain="youtube.com"), "Organic Video"),
    (dict(affiliate_code="a1"), "Affiliate"),
    (dict(), "Direct"),
    (dict(referrer_domain="acs.bank.com"), "Direct"),
    (dict(referrer_domain="blog.example.org"), "Referral"),
    (dict(gclid="g1", referrer_domain="www.google.com"), "Not set"),
]
FIELDS = ["campaign", "source", "medium", "content", "term", "gclid", "affiliate_code", "referrer_domain"]


def test_channel_rules(spark):
    rows = [tuple([i] + [case.get(f) for f in FIELDS]) for i, (case, _) in enumerate(CHANNEL_CASES)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{f} string" for f in FIELDS))
    got = dict(df.select("i", C.channel().alias("ch")).collect())
    for i, (case, want) in enumerate(CHANNEL_CASES):
        assert got[i] == want, (case, got[i], want)


def test_device_and_region(spark):
    uas = ["Mozilla (Windows NT 10.0)", "X11; compatible; bot", "iPhone; CPU iPhone OS",
           "Googlebot (compatible)", "curl/8", None]
    df = spark.createDataFrame([(u,) for u in uas], "ua string")
    assert [r[0] for r in df.select(C.device("ua")).collect()] == \
        ["Desktop", "Desktop", "Mobile", "Bot", None, None]
    reg = spark.createDataFrame([("Europe", "Germany"), ("Americas", "United States"), ("Americas", "Brazil"),
                                 ("Asia", "Japan"), (None, None)], "region string, location string")
    assert [r[0] for r in reg.select(C.custom_region()).collect()] == \
        ["EU/US", "EU/US", "Americas (non US)", "Asia", None]


def test_small_functions(spark):
    df = spark.createDataFrame([("https://www.example.com/a?x=1", "/a"), ("example.com?x=1", None)],
                               "u string, p string")
    assert [r[0] for r in df.select(T.url_host_path("u", "p")).collect()] == ["www.example.com/a", "example.com"]
    cc = spark.createDataFrame([("Quad-Core",), ("16 Core",), ("Dual-Cores",), (None,)], "d string")
    assert [r[0] for r in cc.select(T.core_count("d")).collect()] == [4, 16, None, None]
    g = spark.createDataFrame([("8 Performance Cores 12 Efficient Cores",), ("24 Cores",), ("24",)], "d string")
    assert [r[0] for r in g.select(T.gpu_core_count("d")).collect()] == [20, 24, 24]
    a = spark.createDataFrame([("AMD Ryzen 7 (Zen 4)",), ("x (VT-x)",), ("none",)], "d string")
    assert [r[0] for r in a.select(T.cpu_arch("d")).collect()] == ["Zen 4", None, None]
    t = spark.createDataFrame([("  Intel Core™  i7 ",)], "d string")
    assert t.select(T.clean_text("d")).first()[0] == "Intel Core i7"


def test_regex_traps(spark):
    df = spark.createDataFrame([("ab\n",)], "s string")
    # Postgres '$' is end of string only; Java's would match before the final newline
    assert df.select(T.rx("s", "b$")).first()[0] is False
    assert df.select(T.rx("s", "b.")).first()[0] is True      # '.' matches newline
    assert T.pg_regex(r"\mE[57]-", ci=True) == r"(?s)(?i)\bE[57]-"
