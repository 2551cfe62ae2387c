"""Spark session and checkpoint helpers.

Cluster jobs take their settings from the session they are given; the helpers
here only fill in what is unset (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the package relies on.  AQE re-plans shuffles at run
# time (coalescing small partitions, splitting skewed ones); LAST_WIN is the
# map-key policy of template parameters (a later ``k=v`` wins).
REQUIRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "wikisift") -> SparkSession:
    """A local session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A fresh local folder is made only where the session names none and runs in
    one JVM (``local[...]``, tests); on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="wikisift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """In here a query's shuffle files go when it ends, not when the driver happens to collect its
    garbage.  For loops whose every query is written or checkpointed, and run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str | None = None, factor: int = 2) -> DataFrame:
    """Give CPU-heavy text jobs enough tasks.

    A small file with one row group scans as one partition, so every regex
    runs on one core.  When the scan has fewer partitions than
    ``factor x defaultParallelism`` the rows are hash-partitioned by ``key``
    (a cheap shuffle of a small input); at cluster scale the scan already
    has far more splits than cores and the frame is returned unchanged.
    """
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    # the scan's own plan; df.rdd would add a conversion of every row
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def arriving_files(df: DataFrame, batches: int = 3) -> tuple[int, int]:
    """(files, files a batch) of a stream that takes ``df`` in ``batches`` batches.

    A batch has a file for every task slot of the session and every partition of the scan, so that its
    work spreads over the cluster and a file grows no larger than a split.
    """
    each = max(2, df.sparkSession.sparkContext.defaultParallelism, -(-df._jdf.queryExecution().toRdd().getNumPartitions() // batches))
    return batches * each, each


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A text-heavy table, spread over enough tasks (see :func:`spread`)."""
    return spread(table(spark, sf_dir, name), key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate files, under the shared checkpoint
    folder (never a machine-local temporary folder)."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex}"
