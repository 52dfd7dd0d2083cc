"""The page ingest as an incremental Structured Streaming job.

The reference runs the ingest as a scheduled batch (weekly). Here each new file of stored
responses landing in a folder is processed once: ``readStream`` → ``foreachBatch`` (extract,
upsert the raw-response table, write per-provider status). With ``trigger(availableNow=True)``
a scheduled run processes everything new and stops; the checkpoint folder (under the cluster's
``spark.checkpoint.dir``) records progress, so a lost executor or driver restarts from the last
committed batch. A replayed batch changes nothing: the upsert is keyed, and the status of a batch is a
partition of its own that is overwritten. Intermediate tables go when their batch is done.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.ingest import ingest
from ..session import checkpoint_dir, scratch
from ..sources.pages import raise_on_failed, upsert_raw_table, write_model


def stream_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def last_committed(spark: SparkSession, name: str) -> int:
    """The last batch that the stream has committed; -1 before the first."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(stream_folder(spark, name), "commits"))
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(commits)] if fs.exists(commits) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def start_ingest_stream(spark: SparkSession, responses_dir: str, schema: StructType, prices: DataFrame,
                        raw_table: str, status_table: str, run_date: str | None = None, name: str = "page_ingest",
                        available_now: bool = True):
    """Start the stream; returns the StreamingQuery (``awaitTermination()`` for a scheduled run)."""
    src = spark.readStream.schema(schema).parquet(responses_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        with scratch(spark):
            raw, status = ingest(batch, prices, run_date)
            upsert_raw_table(spark, raw_table, raw)
            write_model(status.withColumn("batch_id", F.lit(batch_id)), status_table, partition_by=["batch_id"])

    w = src.writeStream.foreachBatch(process).option("checkpointLocation", stream_folder(spark, name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def run_ingest(spark: SparkSession, responses_dir: str, schema: StructType, prices: DataFrame, raw_table: str,
               status_table: str, run_date: str | None = None, name: str = "page_ingest") -> None:
    """A scheduled run: process all that is new, then fail (``ProviderFailed``) if in one of its batches every response
    of a provider failed. Both tables are written before that, and the stream's progress is kept."""
    before = last_committed(spark, name)
    start_ingest_stream(spark, responses_dir, schema, prices, raw_table, status_table, run_date, name).awaitTermination()
    if last_committed(spark, name) > before:        # all batches of the run, however many: the progress keeps the last 100 only
        raise_on_failed(spark.read.parquet(status_table).filter(F.col("batch_id") > before))
