"""Stored pages → plan cards (H1, H4–H7), page-local from end to end.

HTML parsing is the only Python: an Arrow-batched ``mapInArrow`` around the standard-library parser.
``html_elements`` (H1) yields one row per element; the card extraction uses ``read_pages``, which yields
one row per page with just what the rules look at: cards and grids with their first parts, and the listed
table rows with their cells. Everything after that is array expressions on that row in the JVM: spec rows
(H5) are folded with ``aggregate()`` over the listed rows, which reproduces "first matching row wins, a used
rule is skipped" exactly, and spec values meet their card by position, repeated by colspan, padded or cut.

* Elements are numbered in document order and know their last descendant: x lies inside a where
  ``a.ord < x.ord <= a.last``. Memory is linear in the page at any depth; ancestors are derived where asked for.
* "First descendant of X matching P" is a merge of intervals: the parts of every kind are in document order,
  so the first one behind X is found by halving and lies inside X or none does.
* A page that cannot be read - whatever the parser raises on it - is an error row with the kind of the
  error (``page_error``); the pages beside it land. Bytes that are no UTF-8 are read as replacement characters.

No join or shuffle is needed after the pages are spread over the cores, a page stored twice cannot mix
with itself, and Python yields every ``CHUNK_CHARS`` of pages, so its memory does not grow with the batch.

Element: ord (pre-order, root = 0), last (its last descendant, else itself), parent, depth, tag, class
array<string>, attrs map<string,string>, text (all descendant text, whitespace collapsed), page_error.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.text import blank_to_null, clean_or_null, clean_text, core_count, cpu_arch, cut_upgradeable, \
    gpu_core_count, key_fallback
from ..session import ship_package

ELEMENT_SCHEMA = ("page_id long, ord int, last int, parent int, depth int, tag string, class array<string>, "
                  "attrs map<string,string>, text string")
CELL_T = "struct<text:string,colspan:string>"
GRID_FIELDS = [f for _, f in R.GPU_GRID_CELLS]
#: What the card rules look at, in document order: cards and grids with their first parts, table rows as listed.
PARTS = {"cards": "array<struct<name:string,monthly:string,hourly:string>>",
         "grids": "array<struct<name:string," + ",".join(f"{f}:string" for f in GRID_FIELDS) + ">>",
         "has_table": "boolean", "rows": f"array<struct<label:string,cells:array<{CELL_T}>>>"}
CHUNK_CHARS = 1 << 21
#: Most characters that the parts or elements of one page may hold; a page of more is an error row.
MOST_CHARS = 1 << 28
#: Bytes of pages for one task: parsing takes about a second a MB.
SPREAD_BYTES = 16 << 20
_VOID = frozenset(R.HTML_VOID_TAGS)
ATTRIBUTES = ["cpu", "cpu_detail", "ram", "nvme", "ssd", "hdd", "bandwidth", "traffic"]


class Element:
    __slots__ = ("attrs", "depth", "first_word", "last", "last_word", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: int, depth: int, first_word: int):
        self.tag, self.attrs, self.parent, self.depth, self.first_word = tag, attrs, parent, depth, first_word
        self.last = self.last_word = -1

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class PageReader(HTMLParser):
    """Elements of one page in document order. An end tag closes the innermost open element of its name
    and all that is open inside it; one without an open element is ignored; void tags hold nothing."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", {}, -1, 0, 0)]
        self.open = [0]
        self.levels: dict[str, list[int]] = {}      # where the elements of a name are open, the innermost last
        self.words: list[str] = []
        self.chars = 0
        self.feed(html)
        self.close()
        self.shut(0)

    def shut(self, level: int) -> None:
        """Close the open elements from ``level`` on."""
        while len(self.open) > level:
            e = self.elements[self.open.pop()]
            e.last_word, e.last = len(self.words), len(self.elements) - 1
            if self.open:
                self.levels[e.tag].pop()

    def handle_starttag(self, tag, attrs):
        self.levels.setdefault(tag, []).append(len(self.open))
        self.elements.append(Element(tag, dict(attrs), self.open[-1], len(self.open), len(self.words)))
        self.open.append(len(self.elements) - 1)
        if tag in _VOID:
            self.shut(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.shut(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.levels.get(tag):
            self.shut(self.levels[tag][-1])

    def handle_data(self, data):
        if data.strip():
            self.words.append(data)

    def text(self, i: int) -> str:
        e = self.elements[i]
        out = " ".join(" ".join(self.words[e.first_word:e.last_word]).split())
        self.chars += len(out)
        if self.chars > MOST_CHARS:
            raise ValueError(f"the parts of the page hold more than {MOST_CHARS} characters")
        return out

    def ancestors(self, i: int) -> list[int]:
        """Ords of the element's ancestors, root first."""
        up = []
        while i:
            i = self.elements[i].parent
            up.append(i)
        return up[::-1]


def element_rows(html: str, texts: Sequence[str] | None = None, paths: bool = False) -> Iterable[dict]:
    page = PageReader(html)
    for i, e in enumerate(page.elements):
        if i:
            row = {"ord": i, "last": e.last, "parent": e.parent, "depth": e.depth, "tag": e.tag, "class": e.classes(),
                   "attrs": list(e.attrs.items()), "text": page.text(i) if texts is None or e.tag in texts else None}
            yield {**row, "path": page.ancestors(i)} if paths else row


class Parts:
    """Parts of one kind in document order."""

    def __init__(self, page: PageReader):
        self.page, self.ords, self.texts = page, [], {}

    def first_inside(self, anchor: int) -> int | None:
        """The first part inside the anchor."""
        k = bisect_right(self.ords, anchor)
        return self.ords[k] if k < len(self.ords) and self.ords[k] <= self.page.elements[anchor].last else None

    def text_inside(self, anchor: int) -> str | None:
        i = self.first_inside(anchor)
        if i is not None and i not in self.texts:
            self.texts[i] = self.page.text(i)
        return None if i is None else self.texts[i]

    def key_inside(self, anchor: int) -> str | None:
        i = self.first_inside(anchor)
        return None if i is None else self.page.elements[i].attrs.get(R.PRODUCT_KEY_ATTR)


def listed_rows(page: PageReader, rows: dict[int, tuple[list[int], list[int]]]) -> list[dict]:
    """Table rows (ord: its tables, its cells) in the order of a scan table by table: a row inside nested tables is listed
    once for each. A row that gives no attribute when it is listed never will, and there are ``ATTRIBUTES`` to give, so
    its outermost tables, as many as there are attributes, are all that matter."""
    read = {}
    for i, (_, cells) in rows.items():
        if cells:
            read[i] = {"label": page.text(cells[0]).lower(),
                       "cells": [{"text": page.text(c), "colspan": page.elements[c].attrs.get("colspan")} for c in cells[1:]]}
    order = sorted((t, i) for i, (tables, _) in rows.items() if i in read for t in tables)
    return [read[i] for _, i in order]


def page_parts(html: str) -> dict[str, object]:
    """What the card rules look at; text only where a rule reads it."""
    page = PageReader(html)
    names, monthly, hourly, grid_names = Parts(page), Parts(page), Parts(page), Parts(page)
    cells = {k: Parts(page) for k, _ in R.GPU_GRID_CELLS}
    cards, grids, rows, tables, has_table = [], [], {}, [], False
    for i, e in enumerate(page.elements):
        while tables and page.elements[tables[-1]].last < i:
            tables.pop()
        if e.tag == "table":
            tables.append(i)
            has_table = True
        elif e.tag == "tr":
            rows[i] = (tables[:len(ATTRIBUTES)], [])
        elif e.tag in ("th", "td") and e.parent in rows:
            rows[e.parent][1].append(i)
        elif e.tag == R.MONTHLY_PRICE_TAG:
            monthly.ords.append(i)
        elif e.tag == R.HOURLY_PRICE_TAG and e.attrs.get("price-type") == R.HOURLY_PRICE_TYPE:
            hourly.ords.append(i)
        found = set(e.classes())
        if R.CARD_NAME_CLASS in found:
            names.ords.append(i)
        if R.GPU_GRID_NAME_CLASS in found:
            grid_names.ords.append(i)
        if e.tag == "div":
            if found.issuperset(R.CARD_CLASSES):
                cards.append(i)
            if R.GPU_GRID_CLASS in found:
                grids.append(i)
            for k in found & cells.keys():
                cells[k].ords.append(i)
    return {"cards": [{"name": names.text_inside(c), "monthly": monthly.key_inside(c), "hourly": hourly.key_inside(c)} for c in cards],
            "grids": [{"name": grid_names.text_inside(g), **{f: cells[k].text_inside(g) for k, f in R.GPU_GRID_CELLS}} for g in grids],
            "has_table": has_table, "rows": listed_rows(page, rows)}


def _spread(pages: DataFrame, key: Column) -> DataFrame:
    """Pages over at least the configured parallelism and, where their size is known, tasks of ``SPREAD_BYTES``: shuffling
    bytes is far faster than parsing them."""
    spark = pages.sparkSession
    size = int(str(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    by_size = -(-size // SPREAD_BYTES) if size < 1 << 55 else 0         # an unknown size is given as the largest number
    return pages.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, by_size), key)


def failure(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:200]


def read_safely(parse: Callable[[str | None], Iterable[dict]], body: bytes | None) -> tuple[list[dict], str | None]:
    """The records of a body and no error, or none and the error that it gives."""
    try:
        return list(parse(None if body is None else body.decode("utf-8", "replace"))), None
    except Exception as e:      # whatever a stored page does to the parser, it is that page's error alone
        return [], failure(e)


def _parsed(pages: DataFrame, parse: Callable[[str | None], Iterable[dict]], schema: str) -> DataFrame:
    """The records of every page, with all columns but the last (the body) repeated beside them and ``page_error``; a page that
    cannot be read is one record of its error alone."""
    ship_package(pages.sparkSession)
    keep, body = pages.columns[:-1], pages.columns[-1]
    full = pages.select(*keep).limit(0).selectExpr("*", *[f"CAST(NULL AS {t}) AS `{n}`" for n, t in
                                                          (x.split(" ", 1) for x in f"{schema}, page_error string".split(", "))]).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(full)
        new = pa.schema([target.field(i) for i in range(len(keep), len(target))])

        def batch(b, source, out):
            kept = [c.take(pa.array(source, pa.int64())) for c in b.columns[:-1]]
            made = pa.Table.from_pylist(out, schema=new).combine_chunks()
            cols = kept + [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in made.columns]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, target, strict=True)], schema=target)

        for b in batches:
            size, source, out = 0, [], []
            for at, x in enumerate(b.column(b.num_columns - 1)):
                records, error = read_safely(parse, x.as_py())
                records = records if error is None else [{"page_error": error}]
                try:
                    made = batch(b, [at] * len(records), records) if len(records) > 4096 else None
                except Exception as e:      # records that Arrow cannot hold
                    made, records = None, [{"page_error": failure(e)}]
                if made is not None:
                    yield made
                    continue
                out += records
                source += [at] * len(records)
                size += len(x.as_buffer() or b"") + 1 if x.is_valid else 1
                if size >= CHUNK_CHARS:
                    yield batch(b, source, out)
                    size, source, out = 0, [], []
            if source:
                yield batch(b, source, out)

    return pages.select(*keep, F.col(body).cast("binary").alias(body)).mapInArrow(run, full)


def html_elements(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", texts: Sequence[str] | None = None,
                  paths: bool = False) -> DataFrame:
    """H1: one row per element of every page; a page that cannot be read is one row of its ``page_error``.

    ``texts``: only the elements of these tags get their text (of nested elements every level repeats it); ``paths`` adds the
    ords of all ancestors, root first."""
    src = pages.filter(F.col(html_col).isNotNull()).select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    schema = ELEMENT_SCHEMA.removeprefix("page_id long, ") + (", path array<int>" if paths else "")
    return _parsed(_spread(src, F.xxhash64("page_id")), lambda html: element_rows(html, texts, paths), schema)


def inside(element: str, anchor: str) -> Column:
    """Whether the element lies inside the anchor (aliases of two element tables of one page)."""
    return (F.col(f"{element}.ord") > F.col(f"{anchor}.ord")) & (F.col(f"{element}.ord") <= F.col(f"{anchor}.last"))


def read_pages(pages: DataFrame, html_col: str = "html", carry: Sequence[str] = ("page_id",), spread: bool = True) -> DataFrame:
    """One row per page: the carried columns, its parts (NULL where the body is NULL or cannot be read) and ``page_error``."""
    src = pages.select(*carry, F.col(html_col).alias("_html"))
    if spread:
        src = _spread(src, F.xxhash64(*carry))
    return _parsed(src, lambda html: [dict.fromkeys(PARTS) if html is None else page_parts(html)],
                   ", ".join(f"{k} {t}" for k, t in PARTS.items()))


# ------------------------------------------------------------------------------------------------
# H4 + H7: product cards and GPU grids
# ------------------------------------------------------------------------------------------------
def product_cards() -> Column:
    """H4: the page's cards with a name and a price key, in document order: plan_name, monthly_key, hourly_key."""
    def card(c):
        monthly, hourly = key_fallback(blank_to_null(c["monthly"]), blank_to_null(c["hourly"]))
        return F.struct(clean_text(c["name"]).alias("plan_name"), monthly.alias("monthly_key"), hourly.alias("hourly_key"))

    return F.filter(F.transform("cards", card), lambda c: (c["plan_name"] != "") & c["monthly_key"].isNotNull())


def gpu_grids() -> Column:
    """H7 grids, the last first: cleaned name and the six cleaned cells."""
    def grid(g):
        return F.struct(clean_text(g["name"]).alias("plan_name"), *[clean_text(F.coalesce(g[f], F.lit(""))).alias(f) for f in GRID_FIELDS])

    return F.reverse(F.filter(F.transform("grids", grid), lambda g: g["plan_name"].isNotNull()))


# ------------------------------------------------------------------------------------------------
# H5: hardware table rows, first matching row per attribute
# ------------------------------------------------------------------------------------------------
PICKED_T = f"struct<label:string,cells:array<{CELL_T}>>"


def _fold_sql(rows: str) -> str:
    """``aggregate()`` over a page's ordered rows: state = (label, cells) per attribute, NULL until a
    row is assigned; a row goes to the first rule it matches whose attribute is still unassigned."""
    init = "named_struct(" + ", ".join(f"'{a}', CAST(NULL AS {PICKED_T})" for a in ATTRIBUTES) + ")"
    picked = "named_struct('label', r.label, 'cells', r.cells)"
    branches = []
    for a, cond in R.SPEC_LABEL_RULES:
        new_state = ", ".join(f"'{b}', {picked if b == a else 'st.' + b}" for b in ATTRIBUTES)
        branches.append(f"WHEN st.{a} IS NULL AND {cond.format(label='r.label')} THEN named_struct({new_state})")
    return f"aggregate({rows}, {init}, (st, r) -> CASE {' '.join(branches)} ELSE st END)"


def page_facts(read: DataFrame) -> DataFrame:
    """``read_pages`` rows with has_table, cards, grids and specs (per attribute the (label, value cells) of the
    first table row assigned to it, NULL without one) in place of the parts."""
    return read.select(*[c for c in read.columns if c not in PARTS], "has_table", product_cards().alias("cards"), gpu_grids().alias("grids"),
                       F.expr(_fold_sql("rows")).alias("specs"))


# ------------------------------------------------------------------------------------------------
# H6: values by position
# ------------------------------------------------------------------------------------------------
def _ustrip(c: Column) -> Column:
    return F.regexp_replace(c, r"^(?U)\s+|(?U)\s+$", "")


def storage_part(v: Column, label: str) -> Column:
    """``"<value> <label>"`` for a storage cell, NULL for blank, ``-`` or digit-less values."""
    v0 = _ustrip(v)
    head = _ustrip(F.element_at(F.split(v0, R.OPTIONALLY_WORD, 2), 1))
    v1 = F.regexp_replace(head, r"(?U)\s+", " ")
    ok = (v0 != "") & (v0 != "-") & (v1 != "") & v1.rlike(r"(?U)\d")
    return F.when(ok, F.concat(v1, F.lit(" " + label)))


def expand_cells_sql(cells: str, n: str) -> str:
    """X1 + X2 (SQL text): each cell's text repeated ``max(1, colspan)`` times (a bad colspan counts as 1), padded with ''
    or cut to exactly n values. No cell is repeated more than n times: what is beyond is cut anyway."""
    span = (f"least({n}, greatest(1, coalesce(try_cast(trim(c.colspan) AS BIGINT), "
            f"CASE WHEN c.colspan RLIKE '^\\\\s*[+]?[0-9]+\\\\s*$' THEN {n} ELSE 1 END)))")
    repeated = f"flatten(transform({cells}, c -> array_repeat(c.text, CAST({span} AS INT))))"
    return f"slice(concat(coalesce({repeated}, CAST(array() AS array<string>)), array_repeat('', {n})), 1, {n})"


CARD_FIELDS = ["cpu_model", "cores_count", "cpu_arch", "cpu_detail_raw", "ram", "storage", "bandwidth", "traffic",
               "gpu", "gpu_vram", "gpu_tflops", "cpu_cores_raw"]


def _table_fields(at: dict[str, Column]) -> dict[str, Column]:
    """H6 field expressions over a card's value of every attribute ('' where there is none)."""
    storage = F.array_join(F.array_compact(F.array(*[storage_part(at[k], lbl) for k, lbl in R.STORAGE_KINDS])), ", ")
    null = F.lit(None).cast("string")
    return {
        "cpu_model": clean_or_null(at["cpu"]),
        "cores_count": core_count(at["cpu_detail"]),
        "cpu_arch": cpu_arch(at["cpu_detail"]),
        "cpu_detail_raw": clean_or_null(at["cpu_detail"]),
        "ram": blank_to_null(F.trim(cut_upgradeable(clean_text(at["ram"])))),
        "storage": blank_to_null(storage),
        "bandwidth": clean_or_null(cut_upgradeable(at["bandwidth"])),
        "traffic": clean_or_null(at["traffic"]),
        "gpu": null, "gpu_vram": null, "gpu_tflops": null, "cpu_cores_raw": null,
    }


def _gpu_fields(grid: Column) -> dict[str, Column]:
    """H7 field expressions over a card's grid (NULL: none, or not the last card of its name)."""
    null = F.lit(None).cast("string")
    raw = grid["cpu_cores_raw"]
    return {
        "cpu_model": blank_to_null(grid["cpu_model"]),
        "cores_count": F.when(raw != "", gpu_core_count(raw)),
        "cpu_arch": null, "cpu_detail_raw": null,
        "ram": blank_to_null(grid["ram"]),
        "storage": null, "bandwidth": null, "traffic": null,
        "gpu": blank_to_null(grid["gpu"]), "gpu_vram": blank_to_null(grid["gpu_vram"]),
        "gpu_tflops": blank_to_null(grid["gpu_tflops"]), "cpu_cores_raw": blank_to_null(raw),
    }


def card_rows(facts: DataFrame) -> DataFrame:
    """One row per card: the page's other columns, position, n_cards, has_table, name, keys and the hardware fields, by
    table position on pages with a table, else from the last grid of the name, which only the last card of that name
    gets (J11). The fields are plain columns above the explode: what belongs to the page is computed once per page."""
    keep = [c for c in facts.columns if c not in ("cards", "grids", "specs", "has_table")]
    d = facts.withColumn("n_cards", F.size("cards"))
    page = d.select(*keep, "has_table", "n_cards", "grids", F.reverse("cards.plan_name").alias("_names"), "cards",
                    *[F.expr(expand_cells_sql(f"specs.{a}.cells", "n_cards")).alias(f"_v_{a}") for a in ATTRIBUTES])
    one = page.select("*", F.posexplode("cards").alias("position", "c")).select(
        *keep, "position", "n_cards", "has_table", "c.plan_name", "c.monthly_key", "c.hourly_key",
        F.when(F.array_position("_names", F.col("c.plan_name")) == F.col("n_cards") - F.col("position"),
               F.get(F.filter("grids", lambda g: g["plan_name"] == F.col("c.plan_name")), F.lit(0))).alias("_grid"),
        *[F.coalesce(F.get(F.col(f"_v_{a}"), F.col("position")), F.lit("")).alias(f"_at_{a}") for a in ATTRIBUTES])
    tf, gf = _table_fields({a: F.col(f"_at_{a}") for a in ATTRIBUTES}), _gpu_fields(F.col("_grid"))
    fields = [F.when(F.col("has_table"), tf[f]).otherwise(gf[f]).alias(f) for f in CARD_FIELDS]
    return one.select(*keep, "position", "n_cards", "has_table", "plan_name", "monthly_key", "hourly_key", *fields)
