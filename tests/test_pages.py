"""Page extraction: element table, first-match spec rows (vs a brute-force loop), cards, GPU
grids, embedded JSON. Expected values are derived by hand from the extraction rules."""
import itertools
import random

from pyspark.sql import functions as F

from tidewater.harness.standins import Inputs
from tidewater.operators.embedded_json import embedded_arrays, embedded_object
from tidewater.operators.html import ATTRIBUTES, card_rows, html_elements, page_facts, read_pages
from tidewater.plans.ingest import attach_prices, extract_responses, matrix_cards, prices_at
from tidewater.sources.pages import catalog_ok, page_ok, payload_rows


def pages_df(spark, pages):
    return spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "page_id long, html string")


def facts(spark, pages):
    return page_facts(read_pages(pages_df(spark, pages)))


def cards_of(spark, pages):
    return card_rows(facts(spark, pages))


def test_element_table_tolerant_tree(spark):
    html = ('<div class="a  b"><p>x<b>y</b><br>z</p><span>w</div><i>q &amp; r</i>'
            '<script>var t="</p><td>";</script><img src=x/></em>')
    rows = {r.ord: r for r in html_elements(pages_df(spark, [html]), paths=True).collect()}
    tags = [rows[k].tag for k in sorted(rows)]
    assert tags == ["div", "p", "b", "br", "span", "i", "script", "img"]
    assert rows[1].text == "x y z w" and rows[1]["class"] == ["a", "b"]
    assert rows[2].text == "x y z" and rows[2].path == [0, 1]
    assert rows[4].text == "" and rows[4].path == [0, 1, 2]          # void tag: no children
    assert rows[5].parent == 1                                        # </div> closed the open <span>
    assert rows[6].text == "q & r" and rows[6].path == [0]
    assert rows[7].text == 'var t="</p><td>";'                        # script content is text


LABELS = ["CPU", "CPU Details", "cpu detail x", "RAM", "RAM 2", "NVMe SSD", "NVMe HDD", "HDD", "SATA SSD", "SSD",
          "ssd cache", "Connection", "guaranteed bandwidth", "Traffic", "traffic 2", "Other"]


def brute_assign(labels):
    rules = [lambda s: s.startswith("cpu") and "detail" not in s, lambda s: "cpu" in s and "detail" in s,
             lambda s: s.startswith("ram"), lambda s: "nvme" in s,
             lambda s: "sata ssd" in s or s.startswith("ssd ") or s == "ssd", lambda s: "hdd" in s and "ssd" not in s,
             lambda s: "guaranteed bandwidth" in s or s == "connection", lambda s: s.startswith("traffic")]
    seen = {}
    for lab in labels:
        s = lab.lower()
        for a, rule in zip(ATTRIBUTES, rules):
            if a not in seen and rule(s):
                seen[a] = s
                break
    return seen


def table_page(labels):
    rows = "".join(f"<tr><th>{lab}</th><td>v</td></tr>" for lab in labels)
    return f"<html><body><table>{rows}</table></body></html>"


def test_spec_rows_first_match_vs_brute_force(spark):
    rnd = random.Random(3)
    orders = [rnd.sample(LABELS, len(LABELS)) for _ in range(25)] + [list(p) for p in itertools.islice(
        itertools.permutations(["NVMe SSD", "NVMe HDD", "HDD", "SSD"]), 24)]
    specs = facts(spark, [table_page(o) for o in orders]).select("page_id", "specs.*")
    got = {r.page_id: {a: r[a]["label"] for a in ATTRIBUTES if r[a] is not None} for r in specs.collect()}
    for pid, order in enumerate(orders):
        assert got[pid] == brute_assign(order), order


CARD_PAGE = """<html><body>
<div class="product product-type-HetznerProduct"><span class="product-text-name">AX41 &trade;</span>
  <ho-split-price-container product-key="ax41"></ho-split-price-container></div>
<div class="product product-type-HetznerProduct"><span class="product-text-name">  </span>
  <ho-split-price-container product-key="blank"></ho-split-price-container></div>
<div class="product product-type-HetznerProduct"><span class="product-text-name">AX52</span>
  <ho-price-container price-type="hourly" product-key="ax52h"></ho-price-container></div>
<div class="product product-type-HetznerProduct"><span class="product-text-name">NoKey</span></div>
<div class="product"><span class="product-text-name">NotACard</span>
  <ho-split-price-container product-key="x"></ho-split-price-container></div>
<table>
<tr><th>CPU</th><td colspan="2">Intel Core i7-6700&reg;</td></tr>
<tr><th>CPU Details</th><td>Quad-Core (Skylake)</td><td>16 Core (AMD-V)</td></tr>
<tr><th>RAM</th><td>64 GB DDR4 Upgradeable to 128 GB</td></tr>
<tr><th>NVMe SSD</th><td>2 x 512 GB optionally more</td><td>-</td></tr>
<tr><th>HDD</th><td>2 x 4 TB</td><td>none</td></tr>
<tr><th>Connection</th><td colspan="bad">1 Gbit/s Upgradeable</td><td>10 Gbit/s</td></tr>
</table></body></html>"""


def test_cards_and_table_enrichment(spark):
    cards = {r.plan_name: r for r in cards_of(spark, [CARD_PAGE]).collect()}
    assert set(cards) == {"AX41", "AX52"}                      # blank name and key-less card dropped
    ax41, ax52 = cards["AX41"], cards["AX52"]
    assert (ax41.monthly_key, ax41.hourly_key, ax41.position) == ("ax41", "ax41", 0)
    assert (ax52.monthly_key, ax52.hourly_key, ax52.position) == ("ax52h", "ax52h", 1)
    assert ax41.cpu_model == ax52.cpu_model == "Intel Core i7-6700"          # colspan 2, trademark removed
    assert (ax41.cores_count, ax41.cpu_arch) == (4, "Skylake")
    assert (ax52.cores_count, ax52.cpu_arch, ax52.cpu_detail_raw) == (16, None, "16 Core (AMD-V)")
    assert ax41.ram == "64 GB DDR4" and ax52.ram is None                        # padded with ''
    assert ax41.storage == "2 x 512 GB NVMe, 2 x 4 TB HDD" and ax52.storage is None
    assert (ax41.bandwidth, ax52.bandwidth) == ("1 Gbit/s", "10 Gbit/s")
    assert ax41.gpu is None and ax41.traffic is None


GPU_PAGE = """<html><body>
<div class="product product-type-HetznerProduct"><h3 class="product-text-name">GEX44</h3>
  <ho-split-price-container product-key="g1"></ho-split-price-container></div>
<div class="product product-type-HetznerProduct"><h3 class="product-text-name">GEX44</h3>
  <ho-split-price-container product-key="g2"></ho-split-price-container></div>
<div class="product product-type-HetznerProduct"><h3 class="product-text-name">GEX130</h3>
  <ho-split-price-container product-key="g3"></ho-split-price-container></div>
<div class="gpu-information-grid"><div class="grid-header-name">GEX44</div>
  <div class="item-a">old</div></div>
<div class="gpu-information-grid"><div class="grid-header-name">GEX44</div>
  <div class="item-a">Intel Core i5-13500</div><div class="item-b">6 Performance Cores 8 Efficient Cores</div>
  <div class="item-c">64 GB</div><div class="item-d">RTX 4000</div><div class="item-f">20 GB</div></div>
<div class="gpu-information-grid"><div class="grid-header-name">GEX130</div>
  <div class="item-b">24 Cores</div></div>
</body></html>"""


def test_gpu_grid_last_card_and_last_grid_win(spark):
    cards = {r.monthly_key: r for r in cards_of(spark, [GPU_PAGE]).collect()}
    assert cards["g1"].cpu_model is None                                # not the last card named GEX44
    g2 = cards["g2"]
    assert (g2.cpu_model, g2.cores_count, g2.ram, g2.gpu, g2.gpu_vram, g2.gpu_tflops) == \
        ("Intel Core i5-13500", 14, "64 GB", "RTX 4000", "20 GB", None)
    assert (cards["g3"].cpu_model, cards["g3"].cores_count, cards["g3"].cpu_cores_raw) == (None, 24, "24 Cores")
    assert sorted(r.position for r in cards.values()) == [0, 1, 2]


M = "window.PLANS_PRICING_DATA = "


def test_embedded_object_cases(spark):
    bodies = [M + '{"plansGroups":[{"b":1,"a":"}{"}],"x":2};</script>junk {',   # braces inside strings, key order
              "no marker here",
              M + '{"plansGroups":[{"a":1}',                                   # unterminated
              M + '{"plansGroups":[],"x":1};',                                 # empty list
              M + '{"other":[1]};']                                            # member missing
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, html string")
    out = {r.id: (r.payload, r.error) for r in embedded_object(df).collect()}
    assert out[0] == ('[{"b":1,"a":"}{"}]', None)
    assert out[1][1] == "marker not found" and out[2][1] == "end of JSON object not found"
    assert out[3][1] == "plansGroups is empty" and out[4][1] == "plansGroups is empty"
    more = [M + '{"plansGroups":[1],"plansGroups":[2,{"a":1.5}]}', M + "{oops}", None, M + '[{"plansGroups":[1]}]']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(more)], "id int, html string")
    out = {r.id: (r.payload, r.error) for r in embedded_object(df).collect()}
    assert out[0] == ('[2,{"a":1.5}]', None)                                    # the last of a repeated key
    assert out[1][1] == out[3][1] == "object is not valid JSON" and out[2][1] == "no body"


def test_embedded_arrays_cases(spark):
    e = '\\"'
    bodies = [f'x{e}servers{e}:[{{{e}a{e}:1}}],{e}virtualMachines{e}:[{{{e}b{e}:2}}]',
              f'{e}virtualMachines{e}:[{{{e}b{e}:2}}] then {e}servers{e}:[{{{e}a{e}:1}}]',   # VMs before servers
              f'{e}servers{e}:[{e}virtualMachines{e}:[0]]',                                    # second marker inside first
              'nothing', f'{e}servers{e}:[1, oops]',
              f'{e}servers{e}:[1, 2, {e}virtualMachines{e}:[{{{e}b{e}:2}}] x']                 # the first never ends
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, html string")
    out = {r.id: (r.payload, r.error) for r in embedded_arrays(df).collect()}
    assert out[0] == ('[{"a":1},{"b":2}]', None)
    assert out[1] == ('[{"a":1}]', None)          # the VM array precedes the servers array: not found after it
    assert out[2][1] == "array is not valid JSON"
    assert out[5] == ('[{"b":2}]', None)
    assert out[3][1] == "0 plans extracted" and out[4][1] == "array is not valid JSON"


def test_guards_and_payload_rows(spark):
    df = spark.createDataFrame([("x" * 999,), ("x" * 1000,), (None,)], "b string")
    assert [r[0] for r in df.select(page_ok("b")).collect()] == [False, True, False]
    p = spark.createDataFrame([('{"plans":[1,2,3]}',), ("[1,2]",), ('{"plans":5}',), ("bad",), ('{"x":1}',)],
                              "p string")
    assert [r[0] for r in p.select(catalog_ok("p")).collect()] == [True, False, True, False, False]
    assert [r[0] for r in p.select(payload_rows("p")).collect()] == [3, 2, 1, 1, 1]


def test_text_filter_on_elements(spark):
    el = html_elements(pages_df(spark, [CARD_PAGE]))
    assert el.filter(F.col("tag") == "tr").count() == 6


def test_nested_tables_list_a_row_once_per_table(spark):
    page = ("<table><tr><th>RAM</th><td>1</td></tr><tr><td><table><tr><th>RAM</th><td>2</td></tr>"
            "<tr><th>Traffic</th><td>3 TB</td></tr></table></td></tr></table>")
    s = facts(spark, [page]).select("specs.*").first()
    assert s.ram["cells"][0]["text"] == "1" and s.traffic["cells"][0]["text"] == "3 TB"


def test_huge_colspans_cost_no_more_than_the_cards(spark):
    def page(span):
        return CARD_PAGE.replace('<td colspan="2">Intel', f'<td colspan="{span}">Intel')
    spans = ["100000000", "2000000000", "99999999999999999999", " 7 ", "+3", "-5", "0", "x", ""]
    got = {}
    for r in cards_of(spark, [page(x) for x in spans]).collect():
        got.setdefault(r.page_id, {})[r.plan_name] = r.cpu_model
    wide = {"AX41": "Intel Core i7-6700", "AX52": "Intel Core i7-6700"}
    assert [got[i] for i in range(5)] == [wide] * 5
    assert [got[i]["AX52"] for i in range(5, 9)] == [None] * 4


def test_a_page_stored_twice_is_two_pages(spark):
    rows = cards_of(spark, [CARD_PAGE, CARD_PAGE, None, "", GPU_PAGE]).collect()
    per = {}
    for r in rows:
        per.setdefault(r.page_id, []).append((r.position, r.plan_name, r.cpu_model))
    assert sorted(per[0]) == sorted(per[1]) and len(per[0]) == 2 and set(per) == {0, 1, 4}


def test_chunks_keep_all_pages(spark, monkeypatch):
    from tidewater.operators import html
    monkeypatch.setattr(html, "CHUNK_CHARS", 10)     # (workers read their own; the driver's plan must not depend on it)
    pages = [table_page(["CPU", "RAM"])] * 30
    assert read_pages(pages_df(spark, pages)).count() == 30
    assert html_elements(pages_df(spark, pages)).filter(F.col("tag") == "td").count() == 60


RESPONSE = "provider string, kind string, source_url string, line string, fetched_at timestamp_ntz, body string"
PRICE = "product_key string, prices string, priced_at timestamp_ntz"


def test_prices_in_two_roles_make_the_cards_once(spark, tmp_path):
    """Cards come from parsed pages: every branch that made them anew would parse them anew."""
    import datetime as dt
    day = lambda d: dt.datetime(2026, 1, d, 12)
    rows = [(0, "m", "h", day(2)), (1, "m", "m", day(4)), (2, "h", "", day(2)), (3, None, "h", day(4)), (4, "m", "none", None),
            (5, "m", "h", day(2)), (5, "m", "h", day(2)), (6, "none", None, day(1))]
    made, folder = "card long, monthly_key string, hourly_key string, at timestamp_ntz", str(tmp_path)

    def parse(batches):
        import os
        import uuid
        for b in batches:
            for _ in range(b.num_rows):
                open(os.path.join(folder, uuid.uuid4().hex), "w").close()
            yield b

    cards = spark.createDataFrame(rows, made).mapInArrow(parse, made)
    prices = spark.createDataFrame([("m", "1", day(1)), ("m", "2", day(3)), ("h", "5", day(1)), ("h", None, day(4)), (None, "9", day(1))], PRICE)
    got = attach_prices(cards, prices, "at").select("card", "monthly_prices", "hourly_prices").collect()
    assert sorted(tuple(r) for r in got) == [(0, "1", "5"), (1, "2", "2"), (2, "5", None), (3, None, None), (4, None, None),
                                             (5, "1", "5"), (5, "1", "5"), (6, None, None)]
    assert len(list(tmp_path.iterdir())) == len(rows)
    asked = spark.createDataFrame([("m", day(2))], "product_key string, at timestamp_ntz")
    plan = prices_at(asked, prices, "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_matrix_pages_are_made_in_many_tasks(spark, tmp_path):
    """A small file of parts is read in one task; the pages, many times its size, are not made there, nor shuffled to be made."""
    parts = [(k, f"part {k}", "PROMO", k % 50, 1.0) for k in range(400)] * 2
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_size int, p_retailprice double").coalesce(1) \
        .write.parquet(f"{tmp_path}/part.parquet")
    i = Inputs(spark, str(tmp_path))
    placed = i["matrix_parts"].select("page_id", F.spark_partition_id().alias("task"))
    where = placed.groupBy("page_id").agg(F.collect_set("task").alias("at"), F.count(F.lit(1)).alias("n")).collect()
    assert len(where) == 10 and all(r.n == 80 and len(r["at"]) == 1 for r in where) and len({r["at"][0] for r in where}) > 1
    assert "ENSURE_REQUIREMENTS" not in i["matrix_pages"]._jdf.queryExecution().executedPlan().toString()


def test_ingest_cases(spark):
    import datetime as dt
    import json
    day = lambda d, h=12: dt.datetime(2026, 1, d, h)
    long = CARD_PAGE + " " * 1000
    rows = [("p", "matrix", "u", "ax", day(1), long), ("p", "matrix", "u", "ax", day(1), long),      # stored twice
            ("p", "matrix", "u", "ax", day(3), long),                                                  # another day
            ("p", "matrix", "short", "ax", day(1), "<html>"), ("p", "matrix", "none", "ax", day(1), "x" * 1000),
            ("q", None, "a", None, day(1), "{}"), ("q", "rss", "b", None, day(1), "{}"), ("q", "groups", "c", None, day(1), None),
            ("r", "catalog", "d", None, day(2, 23), '{"plans": [1]}'), ("r", "catalog", "e", None, None, '{"plans": []}')]
    prices = [("ax41", '{"p":9}', day(1, 1)), ("ax41", '{"p":10}', day(2)), ("ax41", '{"p":8}', day(4)), ("ax52h", "not json", day(1, 1))]
    out = extract_responses(spark.createDataFrame(rows, RESPONSE), spark.createDataFrame(prices, PRICE)).collect()
    got = {(r.source_url, r.extracted_date and r.extracted_date.day): r for r in out}
    assert len(out) == len(got) == len(rows) - 1
    first, third = (json.loads(got["u", d].payload) for d in (1, 3))
    assert [c["plan_name"] for c in first] == ["AX41", "AX52"] and first[0]["cpu_model"] == "Intel Core i7-6700"
    assert first[0]["monthly_prices"] == {"p": 9} and third[0]["monthly_prices"] == {"p": 10}       # as known that day
    assert first[1]["monthly_prices"] is None and list(first[0])[:3] == ["line", "plan_name", "plan_id"]
    assert got["none", 1].payload == "[]" and got["none", 1].ok
    assert got["short", 1].error.startswith("page shorter") and got["c", 1].error.startswith("page shorter")
    assert got["a", 1].error == got["b", 1].error == "unknown response kind"
    assert got["d", 2].payload == '{"plans": [1]}' and got["e", None].ok
    fixed = extract_responses(spark.createDataFrame(rows, RESPONSE), spark.createDataFrame(prices, PRICE), run_date="2026-05-04").collect()
    assert {str(r.extracted_date) for r in fixed} == {"2026-05-04"}


def test_matrix_cards_shuffle_once(spark):
    pages = pages_df(spark, [CARD_PAGE]).withColumn("line", F.lit("ax"))
    plan = matrix_cards(pages)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_elements_know_their_last_descendant(spark):
    html = "<a><b>x<c></c></b><d>y</d></a><e><f></f></e>" + "<i><b>" * 3
    rows = {r.ord: r for r in html_elements(pages_df(spark, [html]), texts=["b"], paths=True).collect()}
    up = {k: set(r.path) for k, r in rows.items()}
    for x in rows:
        for a in rows:
            assert (a < x <= rows[a].last) == (a in up[x])
    assert rows[2].text == "x" and rows[1].text is None


def test_deep_pages_cost_their_length(spark):
    deep = "<div>" * 300_000 + CARD_PAGE
    rows = {r.page_id: r for r in facts(spark, [deep, CARD_PAGE]).collect()}
    assert rows[0].cards == rows[1].cards and rows[0].specs == rows[1].specs and len(rows[0].cards) == 2
    assert html_elements(pages_df(spark, [deep]), texts=["th"]).count() == 300_000 + html_elements(pages_df(spark, [CARD_PAGE])).count()


def test_first_parts_of_nested_cards(spark):
    """Against the ancestors of every element."""
    from tidewater.operators.html import PageReader, page_parts
    rnd = random.Random(8)
    for _ in range(60):
        html = "".join(rnd.choice(['<div class="product product-type-HetznerProduct">', f'<p class="product-text-name">n{rnd.randrange(99)}',
                                   f'<ho-split-price-container product-key="{rnd.randrange(99)}">', "</div>", "</p>", "</ho-split-price-container>",
                                   '<ho-price-container price-type="hourly" product-key="h">', '<ho-price-container product-key="x">'])
                       for _ in range(40))
        page = PageReader(html)
        up = [set(page.ancestors(i)) for i in range(len(page.elements))]
        first = lambda c, test: next((i for i, e in enumerate(page.elements) if c in up[i] and test(e)), None)  # noqa: E731, B023
        want = []
        for c, e in enumerate(page.elements):
            if e.tag == "div" and "product" in e.classes():
                name, m = first(c, lambda e: "product-text-name" in e.classes()), first(c, lambda e: e.tag == "ho-split-price-container")
                h = first(c, lambda e: e.tag == "ho-price-container" and e.attrs.get("price-type") == "hourly")
                key = lambda i: None if i is None else page.elements[i].attrs["product-key"]  # noqa: E731, B023
                want.append({"name": None if name is None else page.text(name), "monthly": key(m), "hourly": key(h)})
        assert page_parts(html)["cards"] == want


def test_rows_of_nested_tables_as_a_scan_table_by_table(spark):
    """Every row once per table around it, however many; only the first eight can matter."""
    rnd = random.Random(9)
    pages, want = [], []
    for depth in (1, 3, 12, 40):
        labels = [rnd.choice(LABELS) for _ in range(depth)]
        pages.append("".join(f"<table><tr><th>{x}</th><td>v</td></tr><tr><td>" for x in labels))
        # a level's rows stand inside all tables above: table by table lists from every level down; the second row's label is all text below
        below = [" ".join(f"{x} v" for x in labels[k + 1:]) for k in range(depth)]
        listing = [y for k in range(depth) for j in range(k, depth) for y in (labels[j], below[j])]
        want.append(brute_assign(listing))
    specs = facts(spark, pages).select("page_id", "specs.*")
    got = {r.page_id: {a: r[a]["label"] for a in ATTRIBUTES if r[a] is not None} for r in specs.collect()}
    assert [got[k] for k in range(len(pages))] == want


DEEP_JSON = M + '{"plansGroups":' + "[" * 60_000


def hostile():
    """(kind, body, what becomes of it)"""
    long = " " * 1000
    return [("groups", DEEP_JSON + "]" * 60_000 + "}", "RecursionError"), ("arrays", 'x\\"servers\\":' + "[" * 60_000 + "]" * 60_000, "RecursionError"),
            ("matrix", "<![foo[x]]>" + long, "AssertionError"), ("matrix", "<![ x" + long, "AssertionError"),
            ("matrix", "<div>" * 50_000 + CARD_PAGE, None), ("groups", M + r'{"plansGroups":["\ud800"]}' + long, None),
            ("arrays", r'\"servers\":[{\"a\":\"\udfff\"}]' + long, None)]


def test_one_hostile_body_is_one_error_row(spark):
    import datetime as dt
    import json
    now = dt.datetime(2026, 1, 1)
    good = CARD_PAGE + " " * 1000
    rows = [("p", kind, f"bad{i}", "ax", now, body) for i, (kind, body, _) in enumerate(hostile())]
    rows += [("p", "matrix", f"good{i}", "ax", now, good + " " * i) for i in range(3)] + [("q", "matrix", "alone", "ax", now, "<![foo[x]]>" + " " * 1000)]
    df = spark.createDataFrame(rows, RESPONSE)
    # bytes that are no UTF-8 are read with replacement characters
    broken = df.filter("source_url = 'good0'").withColumn("source_url", F.lit("bytes")).withColumn(
        "body", F.concat(F.col("body").cast("binary"), F.unhex(F.lit("FFFE80"))).cast("string"))
    from tidewater.plans.ingest import ingest_results, quarantine, raw_rows
    results = ingest_results(df.unionByName(broken), spark.createDataFrame([], PRICE))
    kept = {r.source_url: r.payload for r in raw_rows(results).collect()}
    out = {r.source_url: r.error for r in quarantine(results).collect()}
    assert {"good0", "good1", "good2", "bytes"} <= kept.keys() and kept["bytes"] == kept["good0"]
    for i, (_, _, error) in enumerate(hostile()):
        if error:
            assert error in out[f"bad{i}"], i
        else:
            assert f"bad{i}" in kept
    assert json.loads(kept["bad4"]) == json.loads(kept["good0"]) and kept["bad5"] == r'["\ud800"]' and kept["bad6"] == r'[{"a":"\udfff"}]'
    assert "alone" in out
    el = html_elements(pages_df(spark, ["<p>x</p>", "<![foo[x]]>", "<b>y</b>"])).collect()
    assert sorted((r.page_id, r.tag or "", (r.page_error or "").split(":")[0]) for r in el) == [(0, "p", ""), (1, "", "AssertionError"), (2, "b", "")]
