"""Session construction and cluster-aware settings."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are UTC wall clock (the reference converts with
# AT TIME ZONE 'UTC'); AQE re-plans joins by runtime size and splits skewed sort-merge partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (size-checked) broadcast: only sides measured below this size are broadcast,
    # everything else stays a sort-merge join
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # semi and inner joins filter a large side by a Bloom filter of a small side's keys before its shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    # reliable checkpoints of the exact ranking are removed once their DataFrames are collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # AQE sizes shuffle partitions from the data; on a cluster set spark.sql.shuffle.partitions (or
    # spark.sql.adaptive.coalescePartitions.initialPartitionNum) high and let AQE coalesce to this size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return a session with the defaults above. ``master`` is only set for local runs and tests."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """One machine runs everything (``local``, ``local[n]``); ``local-cluster`` counts as a cluster."""
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local run (tests) may leave it unset: a
    private scratch folder is then created and registered. On a cluster every executor would write to
    its own disk, so there an unset folder is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewater-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def tables_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables lie; the folder is removed when the interpreter ends."""
    folder = os.path.join(checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)
    if folder not in _CLEANED:
        _CLEANED.add(folder)
        atexit.register(_remove_at_exit, spark, folder)
    return folder


_SCRATCH: list[list[str]] = []
_CLEANED: set[str] = set()


def write_table(df, name: str):
    """Materialise ``df`` as Parquet under the shared checkpoint folder and return the re-read
    frame: an intermediate that several branches read is computed once and its lineage is cut.

    The tables of an application are removed when its interpreter ends (``remove_tables`` does it
    earlier), those written inside ``with scratch(spark):`` when the block ends."""
    spark = df.sparkSession
    path = os.path.join(tables_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        _remove(spark, folder)
    except Exception:       # the JVM has already ended: the cluster's own cleaning of the folder remains
        pass


def remove_tables(spark: SparkSession) -> None:
    """Remove the intermediate tables this application has written so far. Frames that read them end with them."""
    _remove(spark, tables_dir(spark))


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside the block are removed at its end, also after an error. Results
    must be written before that."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            _remove(spark, path)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs that run inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewater`` importable in Python workers (needed by the Arrow UDF / mapInPandas
    operators): once per application the package is zipped into Spark's own folder for added files on
    the driver and added with ``addPyFile``, from where Spark sends it to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(pkg) for f in fs if f.endswith(".py"))
    folder = os.path.join(SparkFiles.getRootDirectory(), "tidewater-package")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "tidewater-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in files:
            z.write(f, os.path.join("tidewater", os.path.relpath(f, pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
