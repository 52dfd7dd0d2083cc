"""Relational operators against brute force, with a hot key holding a third of the rows, and
"""
import random

from pyspark.sql import functions as F

from tidewater.operators.relational import anti_join, as_of, first_per_key, left_join_or_keys, row_number_skew_safe


def skewed_rows(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        r = rnd.random()
        key = "hot" if r < 0.34 else (None if r < 0.45 else f"k{rnd.randint(0, 60)}")
        ts = rnd.choice([None] + list(range(50)))          # ties and NULLs in the order column
        rows.append((i, key, ts))
    return rows


def brute_rank(rows):
    groups = {}
    for i, k, ts in rows:
        groups.setdefault(k, []).append((ts is None, ts if ts is not None else 0, i))
    out = {}
    for k, g in groups.items():
        for n, (_, _, i) in enumerate(sorted(g), start=1):
            out[i] = n
    return out


def test_row_number_matches_brute_force(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id long, k string, ts int").repartition(5)
    for slices in (2, 7, 400):          # slices of many values, of several, of less than one
        got = row_number_skew_safe(df, ["k"], ["ts", "id"], "rn", slices=slices)
        assert dict(got.dtypes)["rn"] == "bigint" and {r.id: r.rn for r in got.collect()} == brute_rank(rows)


def test_row_number_by_times_and_two_keys(spark):
    import datetime as dt
    rows = [(i, "a" if i % 3 else None, i % 2, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=37 * (i % 50)) if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k string, j int, ts timestamp_ntz")
    got = {r.id: r.rn for r in row_number_skew_safe(df, ["k", "j"], ["ts", "id"], "rn").collect()}
    late = dt.datetime(9999, 1, 1)
    for key in {(r[1], r[2]) for r in rows}:
        mine = sorted((r for r in rows if (r[1], r[2]) == key), key=lambda r: (r[3] or late, r[0]))
        assert [got[r[0]] for r in mine] == list(range(1, len(mine) + 1))


def test_row_number_spreads_the_hot_key(spark):
    """A third of all rows in one key and one instant: no window sees more than a few parts in a hundred of the rows."""
    import datetime as dt
    rnd, busy = random.Random(1), dt.datetime(2024, 5, 1, 12)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randrange(50)}", busy if i % 3 == 0 else busy + dt.timedelta(seconds=rnd.randrange(99999)),
             f"s{rnd.randrange(10**9):09d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, s string, id long")
    out = row_number_skew_safe(df, ["k"], ["ts", "s", "id"], "rn", slices=50)
    got = {r.id: r.rn for r in out.collect()}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1:])
        assert [got[r[3]] for r in mine] == list(range(1, len(mine) + 1))
    from tidewater.operators.relational import order_slice
    from tidewater.session import write_table
    df = write_table(df, "ranked-test")
    sizes = df.groupBy("k", order_slice(df, ["ts", "s"], 50)).count()
    assert sizes.agg(F.max("count")).first()[0] <= 0.05 * len(rows)


def test_numbers_rise_with_their_columns(spark):
    import datetime as dt
    from tidewater.operators.relational import as_number, bounds_below
    texts = ["", "a", "ab", "abcdefg", "abcdefgh", "a\u00e9", "b", "\u00e9", "\uffff", "\U0001f600"]
    df = spark.createDataFrame([(t, dt.datetime(1960 + i, 3, 31, 2, 30), dt.date(1960 + i, 1, 1), 1.5 * i - 3) for i, t in enumerate(texts)],
                               "t string, ts timestamp_ntz, d date, x double")
    for c in df.columns:
        got = [r[0] for r in df.select(as_number(df, c)).collect()]
        assert got == sorted(got) and (c == "t" or len(set(got)) == len(got))
    values = spark.createDataFrame([(v,) for v in range(-1, 12)], "v long")
    for bounds in ([], [3], [0, 2, 2, 2, 5, 9]):
        assert [r[0] for r in values.select(bounds_below(F.col("v"), bounds)).collect()] == [sum(b <= v for b in bounds) for v in range(-1, 12)]


def brute_as_of(asked, known):
    out = []
    for i, k, t in asked:
        fit = [(s, v or "", v) for kk, s, v in known if kk == k and k is not None and t is not None and s is not None and s <= t]
        out.append((i, max(fit)[2] if fit else None))
    return sorted(out)


def test_as_of_against_brute_force(spark):
    import datetime as dt
    rnd, zero = random.Random(5), dt.datetime(2024, 1, 1)
    when = lambda: rnd.choice([None, zero + dt.timedelta(hours=rnd.randrange(200)), zero + dt.timedelta(minutes=rnd.randrange(60))])
    key = lambda: rnd.choice(["hot", "hot", "a", "b", "c", None])
    asked = [(i, key(), when()) for i in range(400)]
    known = [(key(), when(), rnd.choice([None, "x", "y", "z"])) for _ in range(150)]
    a = spark.createDataFrame(asked, "id long, k string, at timestamp_ntz")
    for n in (150, 0):
        b = spark.createDataFrame(known[:n], "k string, since timestamp_ntz, v string")
        assert sorted((r.id, r.v) for r in as_of(a, b, "k", "at", "since", "v").collect()) == brute_as_of(asked, known[:n])


def test_first_per_key_matches_brute_force_and_has_no_window(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id long, k string, ts int")
    first = first_per_key(df, ["k"], ["ts", "id"], ["id"])
    expect = {k: i for i, k, _ in rows if brute_rank(rows)[i] == 1}
    assert {r.k: r.id for r in first.collect()} == expect
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_anti_join_keeps_null_keys_and_plans_left_anti(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, s string")
    right = spark.createDataFrame([("a",), ("a",)], "s string")
    out = anti_join(left, right, "s")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    assert "LeftAnti" in out._jdf.queryExecution().executedPlan().toString()


def test_or_keys_join_matches_nested_loop_and_is_equi(spark):
    plans = spark.createDataFrame([(1, "DE"), (2, "Germany"), (3, "XX"), (4, None), (5, "US")],
                                  "id int, location string")
    dim = spark.createDataFrame([("DE", "Germany", "Europe"), ("US", "US", "Americas"), (None, "Nowhere", "x")],
                                "iso string, country string, region string")
    out = left_join_or_keys(plans, dim, "location", ["iso", "country"]).select("id", "country").collect()
    brute = []
    for pid, loc in plans.collect():
        hits = [c for iso, c, _ in dim.collect() if loc is not None and (loc == iso or loc == c)]
        brute += [(pid, c) for c in hits] or [(pid, None)]
    assert sorted(out, key=str) == sorted(brute, key=str)
    plan = left_join_or_keys(plans, dim, "location", ["iso", "country"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_partners_filter_the_sessions_by_a_bloom_filter(spark):
    """Where the partners are not broadcast, the sessions are filtered before their shuffle."""
    from tidewater.functions.rules import INTERNAL_REFERRER
    from tidewater.plans.sessions import internal_visitors
    from tidewater.session import settings, write_table
    sessions = write_table(spark.range(20_000).selectExpr("concat('v', id % 700) AS anonymous_id", "IF(id % 3 = 0, NULL, concat('u', id % 900)) AS user_id",
                                                          f"IF(id % 997 = 0, '{INTERNAL_REFERRER}', 'x.com') AS referrer_domain"), "bloom-sessions")
    clients = write_table(spark.range(300).selectExpr("concat('u', id) AS korys_client_id", "id % 50 = 0 AS is_company_partner"), "bloom-clients")
    out = internal_visitors(sessions, clients)
    want = {r[0] for r in out.collect()}
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                          "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}):
        out = internal_visitors(sessions, clients)
        assert "might_contain" in out._jdf.queryExecution().optimizedPlan().toString()
        assert {r[0] for r in out.collect()} == want and len(want) > 5
