"""JSON embedded in stored pages (H2, H3) and JSON payload helpers.

Both extractions need the end of a JSON value inside a page, which may hold anything behind it, so
they run in one vectorised (Arrow) pass over the pages that need it: the body reaches Python once and
comes back as (payload, error). A value ends where its brackets balance outside strings; an
unterminated object is an error, an unterminated array counts as absent, a balanced value that is not
JSON is an error. Of a repeated key the last value counts, as in Python's decoder.

Whatever a body does to the decoder (a nesting deeper than its stack, say) is that body's error alone. A lone
surrogate, which JSON can spell but no column can hold, stays spelled (``\\ud800``).
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions import rules as R
from ..session import ship_package

_TOKEN = {"{": re.compile(r'\\.|["{}]', re.S), "[": re.compile(r'\\.|["\[\]]', re.S)}


def value_end(text: str, start: int, opener: str) -> int:
    """Offset behind the bracket that balances the first ``opener`` from ``start`` on; -1 where none does."""
    depth, quoted = 0, False
    for t in _TOKEN[opener].finditer(text, start):
        mark = t.group()
        if mark == '"':
            quoted = not quoted
        elif quoted or len(mark) == 2:
            continue
        elif mark == opener:
            depth += 1
        else:
            depth -= 1
            if depth == 0:
                return t.end()
    return -1


_SURROGATE = re.compile("[\ud800-\udfff]")


def compact(value) -> str:
    """JSON text; outside its strings JSON is ASCII, so a surrogate is part of one and may be spelled."""
    return _SURROGATE.sub(lambda x: f"\\u{ord(x.group()):04x}", json.dumps(value, separators=(",", ":"), ensure_ascii=False))


def object_member(text: str, marker: str = R.GROUPS_MARKER, member: str = R.GROUPS_KEY) -> tuple[str | None, str | None]:
    """H2: (payload, error) of the member of the JSON object behind ``marker``."""
    at = text.find(marker)
    if at < 0:
        return None, "marker not found"
    start = at + len(marker)
    end = value_end(text, start, "{")
    if end < 0:
        return None, "end of JSON object not found"
    try:
        value = json.loads(text[start:end])
    except ValueError:
        return None, "object is not valid JSON"
    found = value.get(member) if isinstance(value, dict) else None
    return (compact(found), None) if found else (None, f"{member} is empty")


def escaped_arrays(text: str, markers=R.ARRAY_MARKERS) -> tuple[str | None, str | None]:
    """H3: (payload, error) of the arrays behind the markers, each searched behind the one before."""
    text, items, behind = text.replace('\\"', '"'), [], 0
    for marker in markers:
        at = text.find(marker, behind)
        end = value_end(text, at + len(marker) - 1, "[") if at >= 0 else -1
        if end < 0:         # absent, or never closed
            behind = 0
            continue
        try:
            items += json.loads(text[at + len(marker) - 1:end])
        except ValueError:
            return None, "array is not valid JSON"
        behind = end
    return (compact(items), None) if items else (None, "0 plans extracted")


_EXTRACTORS = {"groups": object_member, "arrays": escaped_arrays}


def extracted(kind: str | None, body: bytes | None) -> tuple[str | None, str | None]:
    if kind not in _EXTRACTORS or body is None:
        return None, None
    try:
        return _EXTRACTORS[kind](body.decode("utf-8", "replace"))
    except Exception as e:      # one body's fault is one error row
        return None, f"body cannot be read: {type(e).__name__}"


@arrow_udf(T.StructType([T.StructField("payload", T.StringType()), T.StructField("error", T.StringType())]))
def extract_json(kind: pa.Array, body: pa.Array) -> pa.Array:
    """Payload and error of every body (UTF-8) by its kind; nothing for other kinds and NULL bodies."""
    out = [extracted(k.as_py(), b.as_py()) for k, b in zip(kind, body, strict=True)]
    return pa.StructArray.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["payload", "error"])


def embedded_payload(df: DataFrame, kind: str | Column, body: str | Column) -> Column:
    """Struct (payload, error); bodies of other kinds than ``groups`` and ``arrays`` are not sent to Python."""
    ship_package(df.sparkSession)
    k, b = (F.col(c) if isinstance(c, str) else c for c in (kind, body))
    return extract_json(k, F.when(k.isin(*_EXTRACTORS), b).cast("binary"))


def _embedded(df: DataFrame, kind: str, html: str) -> DataFrame:
    out = df.withColumn("_x", embedded_payload(df, F.lit(kind), html))
    missing = F.when(F.col(html).isNull(), F.lit("no body"))
    return out.withColumn("payload", F.col("_x.payload")).withColumn("error", F.coalesce(F.col("_x.error"), missing)).drop("_x")


def embedded_object(df: DataFrame, html: str = "html") -> DataFrame:
    """H2: adds ``payload`` (JSON text) and ``error`` (NULL when usable)."""
    return _embedded(df, "groups", html)


def embedded_arrays(df: DataFrame, html: str = "html") -> DataFrame:
    """H3: adds ``payload`` (JSON text) and ``error`` (NULL when usable)."""
    return _embedded(df, "arrays", html)


def explode_payload(df: DataFrame, payload: str = "payload", schema: str = "map<string,string>") -> DataFrame:
    """One row per element of a JSON array payload (``from_json`` + ``posexplode``)."""
    return df.select("*", F.posexplode(F.from_json(F.col(payload), f"array<{schema}>")).alias("item_pos", "item"))


def to_json_doc(*cols, keep_nulls: bool = True) -> Column:
    """Serialise columns to one JSON object (NULL members kept, as ``json.dumps`` does)."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false" if keep_nulls else "true"})
