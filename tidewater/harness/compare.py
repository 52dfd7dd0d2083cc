"""Order-insensitive result comparison used by the local oracle check and the tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math


NULL = "\u0000NULL"


def norm_value(v):
    if v is None:
        return NULL
    if isinstance(v, float):
        if math.isnan(v):
            return NULL
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}" if v == v else NULL
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(norm_value(x)) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm_value(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm_value(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def diff(spark_cols, spark_rows, duck_cols, duck_rows, show=3):
    a, ca = normalise(spark_cols, spark_rows)
    b, cb = normalise(duck_cols, duck_rows)
    if ca != cb:
        return f"columns differ: {ca} vs {cb}"
    if len(a) != len(b):
        msg = f"row count {len(a)} vs {len(b)}"
    elif a == b:
        return None
    else:
        msg = "values differ"
    sa, sb = set(a), set(b)
    return (msg + f"; spark-only {[x for x in a if x not in sb][:show]}; duck-only {[x for x in b if x not in sa][:show]}")
