import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import classify as C
from tidewater.functions import text as T
from tidewater.operators.relational import first_per_key
from tidewater.sources.pages import upsert_latest


def one(df, col):
    return df.select(col).first()[0]


def test_t1_t3_concat(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert one(df, T.concat_skip_nulls("a", "b")) == "a"          # CONCAT skips NULL
    assert one(df, F.concat("a", "b")) is None                    # || propagates NULL


def test_t2_concat_ws_renders_ints(spark):
    df = spark.createDataFrame([(None, -1)], "a string, g long")
    assert one(df, F.concat_ws("|", F.col("g").cast("string"), "a", F.lit("x"))) == "-1|x"
    assert one(df, T.md5_key(F.lit("a"), F.lit("b"))) == "d0726241020676b14aa6298ce6a18b21"


def test_t4_first_is_nulls_last(spark):
    df = spark.createDataFrame([("k", None, 1, "null-ts"), ("k", dt.datetime(2024, 1, 2), 2, "later"),
                                ("k", dt.datetime(2024, 1, 1), 3, "first")], "k string, ts timestamp_ntz, id int, v string")
    assert first_per_key(df, ["k"], ["ts", "id"], ["v"]).first()["v"] == "first"


def test_t5_least_ignores_nulls(spark):
    df = spark.createDataFrame([(None, 2, 1)], "a int, b int, c int")
    assert one(df, F.least("a", "b", "c")) == 1


def test_t6_t7_t8_regex_dialect(spark):
    df = spark.createDataFrame([("Intel Xeon E5-2680 v4\n",)], "s string")
    assert one(df, T.rx("s", r"\mE[57]-[0-9]", ci=True)) is True
    assert one(df, T.rx("s", r"xeon")) is False                   # ~ is case-sensitive
    assert one(df, T.rx("s", r"xeon", ci=True)) is True            # ~* is not
    assert one(df, T.regex_group("s", r"v([0-9]+)\s*$")) == "4"    # \s* eats the newline, $ = end of string


def test_t9_regex_group_null_on_no_match(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert one(df, T.regex_group("s", "([0-9]+)")) is None
    assert one(df, F.regexp_extract("s", "([0-9]+)", 1)) == ""


def test_t10_not_in_with_null_vendor_falls_through(spark):
    df = spark.createDataFrame([("Marigold 1234",)], "cpu_model string").withColumn("cpu_vendor", C.cpu_vendor())
    assert one(df, "cpu_vendor") is None
    assert one(df, C.cpu_family()) == "Xeon Gold"


def test_t12_is_true(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "b boolean")
    assert [r[0] for r in df.select(F.col("b").eqNullSafe(True)).collect()] == [False, True, False]


def test_t13_month_start_is_wall_clock_ntz(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 31),)], "d date")
    out = df.select(T.month_start("d").alias("m"))
    assert dict(out.dtypes)["m"] == "timestamp_ntz"
    assert one(out, "m") == dt.datetime(2024, 3, 1)


def test_t14_add_months_clamps_and_is_timestamp(spark):
    df = spark.createDataFrame([(dt.date(2024, 8, 31),)], "d date")
    assert one(df, T.add_months_ts("d", 6)) == dt.datetime(2025, 2, 28)


def test_t15_t16_replace_split_part(spark):
    df = spark.createDataFrame([("https://a.b/c?x",)], "u string")
    assert one(df, F.split_part(F.col("u"), F.lit("/"), F.lit(9))) == ""
    assert one(df, T.url_host_path("u", F.lit(None).cast("string"))) == "a.b"


def test_t18_guarded_ratio(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, -5.0), (15.0, 10.0)], "g double, c double")
    assert [r[0] for r in df.select(T.guarded_ratio("g", "c")).collect()] == [None, None, 0.5]


def test_t20_unicode_whitespace(spark):
    df = spark.createDataFrame([("a  b  c ",)], "s string")
    assert one(df, T.clean_text("s")) == "a b c"


def test_t22_upsert_keeps_first_provider_and_last_payload(spark):
    schema = "provider string, extracted_date date, source_url string, payload string, fetched_at timestamp_ntz"
    d = dt.date(2026, 5, 4)
    old = spark.createDataFrame([("first", d, "u", "[1]", dt.datetime(2026, 5, 4, 1))], schema)
    new = spark.createDataFrame([("second", d, "u", "[2]", dt.datetime(2026, 5, 4, 2))], schema)
    r = upsert_latest(old, new).first()
    assert (r.provider, r.payload, r.fetched_at) == ("first", "[2]", dt.datetime(2026, 5, 4, 2))
    again = upsert_latest(upsert_latest(old, new), new).collect()     # idempotent
    assert len(again) == 1 and again[0].payload == "[2]"


def test_ntz_inputs(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert dict(ev.dtypes)["ts"] == "timestamp_ntz"


def test_to_utc_from_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 12, 0),)], "t timestamp_ntz")
    assert one(df, T.to_utc("t", "Europe/Vilnius")) == dt.datetime(2024, 7, 1, 9, 0)
    assert one(df, T.to_utc("t")) == dt.datetime(2024, 7, 1, 12, 0)


def test_t11_not_in_drops_null(spark):
    df = spark.createDataFrame([("add_to_cart",), (None,), ("configure",)], "t string")
    assert [r.t for r in df.filter(~F.col("t").isin("add_to_cart")).collect()] == ["configure"]


def test_t17_int_cast_raises_on_overflow(spark):
    import pytest
    df = spark.createDataFrame([("99999999999",)], "s string")
    with pytest.raises(Exception) as err:                      # ANSI cast, like ::INT
        df.select(T.regex_group("s", "([0-9]+)").cast("int")).collect()
    assert "CAST_INVALID_INPUT" in str(err.value)       # out of range for INT raises, as in the reference


def test_t19_sum_all_null_then_coalesce(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5)], "g int, v int")
    out = {r.g: r.s for r in df.groupBy("g").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("s")).collect()}
    assert out == {1: 0, 2: 5}


def test_t23_alternatives_exclude_each_other(spark):
    # capture patterns whose alternatives could differ between leftmost-longest and first-match
    df = spark.createDataFrame([("Xeon E-2288G",), ("Intel Xeon E 2386G",), ("E3-1270v6",)], "m string")
    got = [r[0] for r in df.select(T.regex_group("m", r"(?:Xeon[\s-]E\M[\s-]+|\mE-)([0-9]+[A-Z]*)", ci=True)).collect()]
    assert got == ["2288G", "2386G", None]


def test_instants_are_read_in_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(1).select(F.timestamp_seconds(F.lit(1704067800)).alias("t"))       # 2024-01-01 00:10 UTC
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(T.to_utc("t").cast("string").alias("u"), T.month_start("t").cast("string").alias("m"),
                        T.add_months_ts("t", 1).cast("string").alias("p")).first()
        fold = spark.range(2).select(T.to_utc(F.timestamp_seconds(F.lit(1730608200) + F.col("id") * 3600)).cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(got) == ("2024-01-01 00:10:00", "2024-01-01 00:00:00", "2024-02-01 00:10:00")
    assert [r[0] for r in fold] == ["2024-11-03 04:30:00", "2024-11-03 05:30:00"]      # an hour the zone has twice


def test_add_months_keeps_the_time_of_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 8, 31, 13, 30),)], "t timestamp_ntz")
    assert one(df, T.add_months_ts("t", 6)) == dt.datetime(2025, 2, 28, 13, 30)
