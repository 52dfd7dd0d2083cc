import datetime as dt
import decimal
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.harness.catalog import leads_df, sessions_df
from tidewater.harness.standins import Inputs
from tidewater.functions import rules as R
from tidewater.plans.sessions import build_sessions, tag_sessions
from tidewater.plans.funnel import lead_stages
from tidewater.plans.roi import roi_model
from tidewater.session import settings, write_table
from tidewater.sources.pages import bucketed_raw_table, merged_by_key, touched, upsert_bucketed, upsert_latest, upsert_raw_table

SF = "/root/testdata/sf0.001"


def test_funnel_stages_are_monotone(spark):
    leads = leads_df(Inputs(spark, SF))
    cols = ["see_entered_at", "think_entered_at", "do_entered_at"]
    bad = leads.filter(
        (F.col(cols[0]) > F.col(cols[1])) | (F.col(cols[1]) > F.col(cols[2]))
        | (F.col(cols[2]) > F.col("care_entered_at").cast("timestamp_ntz"))
        | (F.col("care_entered_at").isNull() & F.col("care_exited_at").isNotNull()))
    assert bad.count() == 0


def test_sessions_channel_and_uniqueness(spark):
    i = Inputs(spark, SF)
    s = build_sessions(i["pageviews"], i["interactions"], ["event_id"])
    tagged = tag_sessions(s, i["identifies"], i["clients"], ["event_id"])
    assert tagged.groupBy("session_id").count().filter("count > 1").count() == 0   # before the ad fan-out
    model = sessions_df(i)
    assert model.filter(F.col("default_channel_grouping").isNull()).count() == 0
    assert set(r[0] for r in model.select("default_channel_grouping").distinct().collect()) <= set(R.CHANNELS)
    # visit numbers are 1..n without gaps per visitor
    per = tagged.groupBy("anonymous_id").agg(F.count(F.lit(1)).alias("n"), F.max("session_by_anonymous").alias("m"))
    assert per.filter("n != m").count() == 0


def test_raw_upsert_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-raw-"), "raw")
    i = Inputs(spark, SF)
    key = lambda r: [str(x) for x in r]  # noqa: E731  (versions may be NULL)
    upsert_raw_table(spark, path, i["raw_existing"])
    first = sorted(spark.read.parquet(path).collect(), key=key)
    upsert_raw_table(spark, path, i["raw_existing"])
    assert sorted(spark.read.parquet(path).collect(), key=key) == first
    upsert_raw_table(spark, path, i["raw_incoming"])
    after = spark.read.parquet(path)
    assert after.groupBy("source_url", "extracted_date").count().filter("count > 1").count() == 0
    assert after.count() >= len(first)


RAW = "provider string, extracted_date date, source_url string, payload string, fetched_at timestamp_ntz"


def raw(spark, rows):
    return spark.createDataFrame([(p, d and dt.date(2026, 1, d), u, x, t and dt.datetime(2026, 1, d or 1, t)) for p, d, u, x, t in rows], RAW)


def test_upsert_touches_only_its_dates_in_a_static_session(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-raw-"), "raw")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        upsert_raw_table(spark, path, raw(spark, [("p", 1, "u", "[1]", 1), ("p", 2, "u", "[2]", 1)]))
        upsert_raw_table(spark, path, raw(spark, [("q", 2, "u", "[3]", 2), ("q", 2, "w", "[4]", None)]))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    got = {(r.extracted_date.day, r.source_url): (r.provider, r.payload) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "u"): ("p", "[1]"), (2, "u"): ("p", "[3]"), (2, "w"): ("q", "[4]")}


@pytest.mark.parametrize("bucketed", [False, True])
def test_upsert_keeps_rows_without_a_date(spark, bucketed):
    """NULL dates, NULL urls and both: only the incoming rows' own keys change, and a replay changes nothing."""
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-raw-"), "raw")
    name = f"raw_{os.path.basename(os.path.dirname(path)).replace('-', '_')}"

    def put(rows):
        if not bucketed:
            upsert_raw_table(spark, path, raw(spark, rows))
            return
        bucketed_raw_table(spark, name, path, 4)
        upsert_bucketed(spark, name, raw(spark, rows))

    put([("p", None, "u1", "[1]", 1), ("p", None, None, "[2]", None), ("p", 1, "u1", "[3]", 1), ("p", 2, "u1", "[4]", 1)])
    for _ in range(2):
        put([("q", None, "u2", "[5]", 1), ("q", 1, "u9", "[6]", None), ("q", None, None, "[7]", 2), ("q", 1, "u1", "[0]", None)])
        got = {(r.extracted_date and r.extracted_date.day, r.source_url): (r.provider, r.payload) for r in spark.read.parquet(path).collect()}
        assert got == {(None, "u1"): ("p", "[1]"), (None, None): ("p", "[7]"), (None, "u2"): ("q", "[5]"), (1, "u1"): ("p", "[3]"),
                       (1, "u9"): ("q", "[6]"), (2, "u1"): ("p", "[4]")}
    if bucketed:
        spark.sql(f"DROP TABLE {name}")


def test_bucketed_upsert_shuffles_the_incoming_rows_alone(spark):
    name, path = "raw_shuffle_test", os.path.join(tempfile.mkdtemp(prefix="tidewater-raw-"), "raw")
    bucketed_raw_table(spark, name, path, 4)
    upsert_bucketed(spark, name, raw(spark, [("p", 1 + i % 3, f"u{i}", "[1]", 1) for i in range(200)]))
    new = write_table(raw(spark, [("q", 2, f"u{i}", "[2]", 2) for i in range(50)]), "upsert-test")
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        plan = merged_by_key(touched(spark.table(name), new), new)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extracted_date" in plan
    # the plan is a tree of lines: nothing above the stored scan, up to the join, is an exchange
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    depth, above = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-"))
        if d < depth:
            above.append(x)
            depth = d
        if "SortMergeJoin" in x:
            break
    assert above and "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)
    spark.sql(f"DROP TABLE {name}")


def test_leads_read_the_sessions_once(spark):
    """Sessions and See are built once: the plan that is left reads their tables."""
    i = Inputs(spark, SF)
    written = []
    from tidewater.plans import funnel, sessions
    keep = funnel.write_table, sessions.write_table
    try:
        for module in (funnel, sessions):
            module.write_table = lambda df, name, f=keep[0]: written.append(name) or f(df, name)
        from tidewater.harness.catalog import leads_df
        plan = leads_df(i)._jdf.queryExecution().executedPlan().toString()
    finally:
        funnel.write_table, sessions.write_table = keep
    assert written == ["sessions-built", "lead-firsts", "lead-see"]
    assert plan.count("Scan parquet") <= 20 and "session_by_anonymous" not in plan


def test_a_table_of_another_shape_is_an_error(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tidewater-raw-"), "raw")
    rows = raw(spark, [("p", 1, "u", "[1]", 1), ("p", 1, "v", "[1]", 1)])
    rows.drop("payload").write.partitionBy("extracted_date").parquet(path)
    with pytest.raises(Exception, match="payload"):
        upsert_raw_table(spark, path, raw(spark, [("p", 1, "u", "[2]", 2), ("p", 1, "w", "[2]", 2)]))
    assert {r.source_url for r in spark.read.parquet(path).collect()} == {"u", "v"}       # nothing was lost


def test_whole_row_wins(spark):
    one = raw(spark, [("p", 1, "n", "[1]", None), ("p", 1, "tie", "[old]", 5), ("p", 1, "null", "[x]", None)])
    two = raw(spark, [("q", 1, "n", None, None), ("q", 1, "tie", "[new]", 5), ("q", 1, "null", "[y]", 3)])
    got = {r.source_url: (r.provider, r.payload, r.fetched_at and r.fetched_at.hour) for r in upsert_latest(one, two).collect()}
    assert got == {"n": ("p", None, None), "tie": ("p", "[new]", 5), "null": ("p", "[y]", 3)}


def test_full_join_keeps_repeated_and_null_clients(spark):
    sessions = spark.createDataFrame([("a1", "s1", "u1", "k", dt.datetime(2024, 1, 5)), ("a2", "s2", None, "k", dt.datetime(2024, 1, 6))],
                                     "anonymous_id string, session_id string, first_user_by_anonymous string, attribution_id string, "
                                     "session_start_time timestamp_ntz")
    clients = spark.createDataFrame([("u1", dt.datetime(2024, 2, 1)), ("u1", dt.datetime(2024, 3, 1)), ("u2", dt.datetime(2024, 4, 1)),
                                     ("u2", dt.datetime(2024, 5, 1)), (None, dt.datetime(2024, 6, 1)), ("u3", None)],
                                    "korys_client_id string, korys_contact_created_date timestamp_ntz")
    none = lambda ddl: spark.createDataFrame([], ddl)
    out = lead_stages(sessions, clients, none("anonymous_id string, order_type string, original_timestamp timestamp_ntz"),
                      none("anonymous_id string, form_name string, original_timestamp timestamp_ntz"),
                      none("korys_client_id string, order_state string, resource_date_start date, resource_value_date date"),
                      none("partner_id long, date_cancel date, resource_value_date date"),
                      none("odoo_partner_id long, team_owner_client_id string")).collect()
    got = sorted((str(r.anonymous_id), str(r.korys_client_id), r.think_entered_at and r.think_entered_at.month) for r in out)
    assert [g[:2] for g in got] == [("None", "None"), ("None", "u2"), ("None", "u2"), ("a1", "u1"), ("a1", "u1"), ("a2", "None")]
    assert [g[2] for g in got] == [6, 4, 5, 2, 3, None]


def test_ratio_of_small_money_is_not_rounded(spark):
    d = decimal.Decimal
    sales = spark.createDataFrame([(1, "a", d("10.0000"), "paid")], "partner_id long, attribution_id string, amount decimal(18,4), invoice_state string")
    teams = spark.createDataFrame([(1, dt.date(2024, 5, 9))], "odoo_partner_id long, first_order_date date")
    attribution = spark.createDataFrame([("a", "cpc", "Affiliate")], "attribution_id string, medium string, default_channel_grouping string")
    ads = spark.createDataFrame([(dt.date(2024, 5, 1), d("0.0040"))], "date date, cost decimal(18,4)")
    aff = spark.createDataFrame([(dt.date(2024, 5, 1), d("0.006"), "paid")], "date_invoice date, commission_amt decimal(18,3), state string")
    r = roi_model(sales, teams, attribution, ads, aff).first()
    assert r.gads_ROI == pytest.approx(2499) and r.affiliate_ROI == pytest.approx(1665.6666667)


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    from tidewater import session
    monkeypatch.setattr(session, "is_local", lambda s: False)

    class NoDir:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(NoDir)


def test_scratch_tables_are_removed(spark):
    from tidewater.session import scratch, write_table
    with scratch(spark):
        t = write_table(spark.range(5), "gone")
        path = t.inputFiles()[0].removeprefix("file://")
        assert t.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)
