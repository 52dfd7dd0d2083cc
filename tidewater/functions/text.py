"""Column helpers for the SQL dialect traps of the reference.

All helpers return JVM-side Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def pg_regex(pattern: str, ci: bool = False) -> str:
    """Translate a Postgres ARE pattern to Java regex.

    * ``\\m`` / ``\\M`` (word start / end) become ``\\b``: every use sits next to a word character.
    * ``$`` outside a bracket means end of string only: ``\\z`` (Java's ``$`` also matches before
      a final newline).
    * ``.`` matches newline in Postgres: ``(?s)``.
    * ``~*`` is case-insensitive: ``(?i)``.
    """
    out = []
    i, n, in_class = 0, len(pattern), False
    while i < n:
        c = pattern[i]
        if c == "\\" and i + 1 < n:
            nxt = pattern[i + 1]
            out.append(r"\b" if (nxt in "mM" and not in_class) else pattern[i:i + 2])
            i += 2
            continue
        if in_class:
            if c == "]":
                in_class = False
            out.append(c)
        elif c == "[":
            in_class = True
            out.append(c)
            if pattern[i + 1:i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1:i + 2] == "]":
                out.append("]")
                i += 1
        elif c == "$":
            out.append(r"\z")
        else:
            out.append(c)
        i += 1
    return ("(?s)" + ("(?i)" if ci else "")) + "".join(out)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rx(c, pattern: str, ci: bool = False) -> Column:
    """``c ~ pattern`` (``~*`` when ci): unanchored search, NULL on NULL input."""
    return col_(c).rlike(pg_regex(pattern, ci))


def regex_group(c, pattern: str, idx: int = 1, ci: bool = False) -> Column:
    """``(regexp_match(c, pattern[, 'i']))[idx]`` / ``substring(c from pattern)``: NULL on no match."""
    return F.nullif(F.regexp_extract(col_(c), pg_regex(pattern, ci), idx), F.lit(""))


def concat_skip_nulls(*cols) -> Column:
    """Postgres ``CONCAT``: NULL arguments are skipped."""
    return F.concat_ws("", *[col_(c).cast("string") for c in cols])


def md5_key(*cols, sep: str = "|") -> Column:
    """``MD5(CONCAT_WS(sep, ...))``: NULL arguments skipped, integers rendered as text."""
    return F.md5(F.concat_ws(sep, *[col_(c).cast("string") for c in cols]))


def url_host_path(url, path) -> Column:
    """Host of a URL (scheme stripped, cut at first '/' and '?') followed by a path."""
    u = col_(url)
    for scheme in ("android-app://", "http://", "https://"):
        u = F.replace(u, F.lit(scheme), F.lit(""))
    host = F.split_part(F.split_part(u, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))
    return concat_skip_nulls(host.cast("string"), col_(path))


def blank_to_null(c) -> Column:
    """Python ``x or None`` on a string."""
    return F.nullif(col_(c), F.lit(""))


def clean_text(c) -> Column:
    """Strip trademark signs, collapse Unicode whitespace runs, trim; NULL stays NULL."""
    no_marks = F.regexp_replace(col_(c), rules.TRADEMARK_CHARS, "")
    return F.trim(F.regexp_replace(no_marks, r"(?U)\s+", " "))


def clean_or_null(c) -> Column:
    return blank_to_null(clean_text(F.coalesce(col_(c), F.lit(""))))


def cut_upgradeable(c) -> Column:
    """Drop a trailing ``Upgradeable...`` clause (case-insensitive, to the end)."""
    return F.regexp_replace(col_(c), rules.UPGRADE_CLAUSE, "")


def before_optionally(c) -> Column:
    """Text before the first word ``optionally`` (case-insensitive)."""
    return F.element_at(F.split(col_(c), rules.OPTIONALLY_WORD, 2), 1)


def core_count(detail) -> Column:
    """Core count of a CPU detail cell: ``Quad-Core`` → 4, ``16 Core`` → 16, else NULL."""
    d = col_(detail)
    words = F.create_map(*[x for w, n in rules.CORE_WORDS for x in (F.lit(w), F.lit(n))])
    word = F.lower(F.regexp_extract(d, rules.CORE_WORD, 1))
    digits = F.regexp_extract(d, rules.CORE_DIGITS, 1)
    return F.coalesce(F.try_element_at(words, word), F.when(digits != "", digits.try_cast("int")))


def gpu_core_count(raw) -> Column:
    """``8 Performance Cores 12 Efficient Cores`` → 20, ``24 Cores`` → 24, ``24`` → 24."""
    r = col_(raw)
    p, e = (F.regexp_extract(r, rules.GPU_CORES_PE, k) for k in (1, 2))
    plain = F.regexp_extract(r, rules.GPU_CORES_PLAIN, 1)
    lead = F.regexp_extract(r, rules.GPU_CORES_LEADING, 1)
    return (F.when(p != "", p.try_cast("int") + e.try_cast("int"))
            .when(plain != "", plain.try_cast("int"))
            .when(lead != "", lead.try_cast("int")))


def cpu_arch(detail) -> Column:
    """First parenthesised text of a CPU detail cell unless it is a virtualisation flag."""
    a = F.trim(F.regexp_extract(col_(detail), rules.IN_PARENTHESES, 1))
    return F.when(F.upper(a).isin(*rules.VIRTUALISATION_FLAGS), F.lit(None).cast("string")) \
        .otherwise(blank_to_null(a))


def join_nonblank(items, sep: str = ", ") -> Column:
    """Join the non-NULL items of a list of string columns (``", ".join(parts) or None``)."""
    return blank_to_null(F.array_join(F.array_compact(F.array(*items)), sep))


def key_fallback(a, b) -> tuple[Column, Column]:
    """Each of two keys falls back to the other when blank."""
    a_, b_ = blank_to_null(a), blank_to_null(b)
    return F.coalesce(a_, b_), F.coalesce(b_, a_)


def to_utc(c, source_tz: str = "UTC") -> Column:
    """``x AT TIME ZONE 'UTC'`` as wall clock: an instant (TIMESTAMP) is read in UTC whatever the session's
    zone, a wall clock (TIMESTAMP_NTZ) recorded in ``source_tz`` is converted, a date is its midnight."""
    ts = col_(c)
    instant = F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")), F.lit("1970-01-01").cast("timestamp_ntz"))
    wall = ts.cast("timestamp_ntz")
    if source_tz != "UTC":
        wall = F.convert_timezone(F.lit(source_tz), F.lit("UTC"), wall)
    return F.when(F.typeof(ts) == "timestamp", instant).otherwise(wall)    # decided when the plan is analysed


def month_start(c) -> Column:
    """``date_trunc('month', x)`` as a UTC wall-clock timestamp, independent of the session zone."""
    return F.trunc(to_utc(c).cast("date"), "month").cast("timestamp_ntz")


def add_months_ts(c, months: int) -> Column:
    """``x + INTERVAL 'n months'`` on a date or timestamp, as a timestamp (T14); the day is clamped and
    the time of day stays."""
    return to_utc(c) + F.make_ym_interval(F.lit(0), F.lit(months))


def guarded_ratio(gain, cost) -> Column:
    """``CASE WHEN cost > 0 THEN (gain - cost) / cost END`` in double precision."""
    g, c = col_(gain).cast("double"), col_(cost).cast("double")
    return F.when(c > 0, (g - c) / c)
