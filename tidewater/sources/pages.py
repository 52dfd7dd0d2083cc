"""Stored pages and raw provider responses.

Raw responses table: provider, extracted_date, source_url, payload (JSON text), fetched_at;
unique on (source_url, extracted_date). Written as Parquet partitioned by ``extracted_date``; the writer
itself asks for dynamic partition overwrite, so an upsert rewrites only the dates it touches whatever
the session is set to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import settings, write_table

RAW_COLS = ["provider", "extracted_date", "source_url", "payload", "fetched_at"]
RAW_KEYS = ["source_url", "extracted_date"]


class Tables:
    """Named-model scan (S1/S2): ``Tables(spark, {"FactSales": "/path/..."})["FactSales"]``.

    A name maps to a Parquet path or a catalog table; scans are lazy, so Catalyst prunes columns
    and pushes filters into each scan."""

    def __init__(self, spark, mapping: dict[str, str]):
        self.spark, self.mapping = spark, mapping

    def __getitem__(self, name: str) -> DataFrame:
        target = self.mapping.get(name, name)
        if "/" in target or target.endswith(".parquet"):
            return self.spark.read.parquet(target)
        return self.spark.table(target)


def page_ok(body: str | Column = "html", min_chars: int = R.MIN_PAGE_CHARS) -> Column:
    """A fetched page is usable unless shorter than ``min_chars`` (a block page); NULL is rejected."""
    b = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.length(b) >= min_chars, F.lit(False))


def valid_pages(pages: DataFrame, body: str = "html", min_chars: int = R.MIN_PAGE_CHARS):
    """S3: (ok, rejected) split of stored pages by the block-page guard."""
    ok = page_ok(body, min_chars)
    return pages.filter(ok), pages.filter(~ok)


def catalog_ok(payload: str | Column = "payload") -> Column:
    """The payload is a JSON object with a ``plans`` key (invalid JSON is rejected)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(F.array_contains(F.json_object_keys(p), R.CATALOG_REQUIRED_KEY), F.lit(False))


def payload_rows(payload: str | Column = "payload") -> Column:
    """List length, or length of the ``plans`` list of an object, else 1."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.coalesce(F.json_array_length(p),
                      F.json_array_length(F.get_json_object(p, "$." + R.CATALOG_REQUIRED_KEY)),
                      F.lit(1)).cast("int")


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = RAW_KEYS,
                  version_col: str = "fetched_at", keep_first: Sequence[str] = ("provider",)) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET payload, source_url, fetched_at``.

    Per key one whole row wins: the latest version, on ties the incoming one, then the greatest values; a
    NULL version is older than any other. ``keep_first`` columns keep the value of the first insert: the
    stored row's, else the earliest version's. One aggregation (partial aggregation map-side); idempotent."""
    cols = existing.columns
    late = [c for c in cols if c not in keys and c not in keep_first]
    both = existing.select(*cols, F.lit(0).alias("_new")).unionByName(incoming.select(*cols, F.lit(1).alias("_new")))
    rank = [F.col(version_col).isNotNull(), F.col(version_col), F.col("_new")]
    winner = F.max(F.struct(*[r.alias(f"_r{i}") for i, r in enumerate(rank)], *[F.col(c).alias(f"_v_{c}") for c in late])).alias("_w")
    first = F.min(F.struct(F.col("_new"), *[r.alias(f"_r{i}") for i, r in enumerate(rank[:2])],
                           *[F.struct(F.col(c).isNull(), F.col(c).alias("v")).alias(f"_v_{c}") for c in keep_first])).alias("_f")
    merged = both.groupBy(*keys).agg(winner, first)
    return merged.select(*[F.col(c) if c in keys else F.col(f"_w._v_{c}").alias(c) if c in late
                           else F.col(f"_f._v_{c}.v").alias(c) for c in cols])


def write_model(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Materialise a model as Parquet; with ``partition_by`` only the partitions that occur in ``df`` are replaced."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def stored_rows(spark, path: str) -> DataFrame | None:
    """The raw-response table at ``path``; None only where the path does not exist. A table of another shape is an error."""
    try:
        return spark.read.parquet(path).select(*RAW_COLS)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def touched(rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """The rows of the dates that ``incoming`` has, NULL dates among them, so that the scan prunes the other partitions.
    The dates come to the driver: at most one for each day."""
    days = [r[0] for r in incoming.select("extracted_date").distinct().collect()]
    date = F.col("extracted_date")
    known = date.isin([d for d in days if d is not None])
    return rows.filter(known | date.isNull() if None in days else known)


def upsert_raw_table(spark, path: str, incoming: DataFrame) -> DataFrame:
    """Merge ``incoming`` into the raw-response table at ``path``: only the partitions (dates, NULL is one) that
    ``incoming`` touches are read and rewritten. ``incoming`` is evaluated once, and the merged rows are
    written to the shared folder first, so the job that overwrites the partitions no longer reads them."""
    new = write_table(incoming.select(*RAW_COLS), "upsert-incoming")
    old = stored_rows(spark, path)
    old = new.limit(0) if old is None else touched(old, new)
    merged = write_table(upsert_latest(old, new), "upsert-merged")
    write_model(merged, path, partition_by=["extracted_date"])
    return merged


def bucketed_raw_table(spark, name: str, path: str, buckets: int) -> None:
    """Know the raw-response table at ``path`` as ``name``, partitioned by date and bucketed by ``source_url``. The catalog
    alone holds the number of buckets: every session names the one that the table was made with."""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (provider STRING, source_url STRING, payload STRING, fetched_at TIMESTAMP_NTZ, extracted_date DATE)
        USING parquet PARTITIONED BY (extracted_date) CLUSTERED BY (source_url) INTO {int(buckets)} BUCKETS LOCATION '{path}'""")
    if stored_rows(spark, path) is not None:
        spark.catalog.recoverPartitions(name)


def merged_by_key(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """``upsert_latest`` where ``stored`` has one row per key and lies in buckets: a full join on the keys, for which the
    incoming rows alone, reduced to one per key, are shuffled."""
    new = upsert_latest(incoming.limit(0), incoming)
    known = F.col("source_url").isNotNull()
    s, n = stored.filter(known).alias("s"), new.filter(known).alias("n")
    c = lambda side, name: F.col(f"{side}.{name}")
    # the buckets serve the plain equality; rows without a url, at most one a date, are merged beside
    key = (c("s", "source_url") == c("n", "source_url")) & c("s", "extracted_date").eqNullSafe(c("n", "extracted_date"))
    s, n = s.withColumn("s_is", F.lit(True)).alias("s"), n.withColumn("n_is", F.lit(True)).alias("n")
    age = lambda side: F.struct(c(side, "fetched_at").isNotNull(), c(side, "fetched_at"))
    incoming_wins = c("s", "s_is").isNull() | (c("n", "n_is").isNotNull() & (age("n") >= age("s")))
    pick = lambda name: F.when(incoming_wins, c("n", name)).otherwise(c("s", name)).alias(name)
    either = lambda name: F.when(c("s", "s_is").isNull(), c("n", name)).otherwise(c("s", name)).alias(name)
    joined = s.join(n, key, "full").select(either("provider"), either("source_url"), pick("payload"), pick("fetched_at"), either("extracted_date"))
    return joined.unionByName(upsert_latest(stored.filter(~known), new.filter(~known)))


def upsert_bucketed(spark, name: str, incoming: DataFrame) -> None:
    """Merge ``incoming`` into the bucketed table ``name``: of the stored rows only the touched dates are read, bucket by
    bucket, and none is shuffled; the joined buckets are written as they are. Spark replaces the touched partitions
    when all tasks are done, so a lost task reads the old ones again."""
    new = write_table(incoming.select(*RAW_COLS), "upsert-incoming")
    merged = merged_by_key(touched(spark.table(name), new), new)
    with settings(spark, {
            "spark.sql.requireAllClusterKeysForCoPartition": "false",           # buckets by source_url serve a join on (source_url, date)
            "spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        merged.write.insertInto(name, overwrite=True)


def ingest_status(results: DataFrame, source: str = "provider", ok: str = "ok") -> DataFrame:
    """success/failure counts per source; a source fails only if every fetch failed."""
    return (results.groupBy(source)
            .agg(F.count_if(F.col(ok)).alias("n_ok"), F.count_if(~F.col(ok)).alias("n_failed"))
            .withColumn("failed", F.col("n_ok") == 0))


class ProviderFailed(RuntimeError):
    """Every response of a provider failed."""


def raise_on_failed(status: DataFrame, source: str = "provider") -> None:
    """After the results are stored, fail the job for the providers of which nothing landed (one row per provider)."""
    failed = sorted(str(r[0]) for r in status.filter("failed").select(source).distinct().collect())
    if failed:
        raise ProviderFailed(f"every response failed: {', '.join(failed)}")
