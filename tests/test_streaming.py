"""The ingest as an incremental stream: every new file of stored responses is processed once."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.harness.standins import Inputs
from tidewater.session import tables_dir
from tidewater.sources.pages import ProviderFailed
from tidewater.streaming.ingest_stream import run_ingest, start_ingest_stream


def test_ingest_stream_available_now(spark):
    root = tempfile.mkdtemp(prefix="tidewater-stream-")
    src, raw, status = (os.path.join(root, d) for d in ("responses", "raw", "status"))
    i = Inputs(spark, "/root/testdata/sf0.001")
    responses = i["stored_responses"].filter("provider <> 'provider-e'")
    before = set(os.listdir(tables_dir(spark))) if os.path.exists(tables_dir(spark)) else set()
    responses.filter(F.col("kind") != "matrix").write.mode("append").parquet(src)
    run_ingest(spark, src, responses.schema, i["prices"], raw, status, name=os.path.basename(root))
    first = spark.read.parquet(raw)
    n_first = first.count()
    assert n_first > 0
    assert first.groupBy("source_url", "extracted_date").count().filter("count > 1").count() == 0
    assert first.filter(F.col("extracted_date") != F.col("fetched_at").cast("date")).count() == 0

    # a second file of responses for other days: matrix pages; the raw table is upserted
    responses.filter(F.col("kind") == "matrix").write.mode("append").parquet(src)
    run_ingest(spark, src, responses.schema, i["prices"], raw, status, name=os.path.basename(root))
    after = spark.read.parquet(raw)
    assert after.count() > n_first
    st = spark.read.parquet(status)
    assert set(r.provider for r in st.collect()) == {"provider-a", "provider-b", "provider-c", "provider-d", "provider-f"}
    assert st.select("batch_id").distinct().count() == 2
    n_status, stored = st.count(), sorted(after.collect())

    # a replay of everything changes nothing: same rows, status overwritten by batch
    q = start_ingest_stream(spark, src, responses.schema, i["prices"], raw, status, name=os.path.basename(root) + "-replay")
    q.awaitTermination(600)
    assert sorted(spark.read.parquet(raw).collect()) == stored
    again = spark.read.parquet(status)
    assert again.groupBy("batch_id", "provider").count().filter("count > 1").count() == 0 and again.count() >= n_status
    # intermediate tables of the batches are gone
    assert set(os.listdir(tables_dir(spark))) <= before

    # a provider of which nothing landed fails the run after both tables are written
    lost = i["stored_responses"].filter("provider = 'provider-e'")
    lost.write.mode("append").parquet(src)
    with pytest.raises(ProviderFailed, match="provider-e"):
        run_ingest(spark, src, responses.schema, i["prices"], raw, status, name=os.path.basename(root))
    assert spark.read.parquet(status).filter("provider = 'provider-e' AND failed").count() == 1
