"""Session construction and the shared checkpoint location.

On a cluster the session is handed in (spark-submit / notebook) and carries its
own ``spark.checkpoint.dir`` pointing at shared storage; we only read it. A
value is set here only when none is configured, which is the local/test case.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: AQE for runtime re-planning (coalescing small
# shuffle partitions, broadcast conversion from runtime sizes, skew-join
# splitting) and UTC so dates derived from timestamps do not shift.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (e.g. 1000 executors reading ~100 TB), passed
# with spark-submit --conf or applied with build_session(extra=SCALE_CONF).
# Shuffles start wide (a partition per ~128 MB of the largest shuffle) and AQE
# coalesces them to the advisory size at runtime, so small stages do not run
# thousands of empty tasks; a partition 5x the median and over 512 MB counts as
# skewed and is split. Scan splits of 256 MB keep task counts manageable
# without exceeding executor memory. Broadcasts stay size-checked by AQE at
# runtime (64 MB); only proven-bounded sides are hinted in code.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.sortBeforeRepartition": "true",
    # split a skewed join even where the next operator reuses its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "delaylake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = os.environ.get("DELAYLAKE_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, configuring one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always respected. Only when it is absent (local runs, tests) a scratch
    folder is created so ``DataFrame.checkpoint()`` works.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="delaylake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


_MADE: list[str] = []       # scratch tables of this process, for release_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete one folder that this process wrote."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if path in _MADE:
        _MADE.remove(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process wrote (call it when their readers
    are done; tables shared between queries go too and are rewritten on the
    next use)."""
    for path in list(_MADE):
        delete_path(spark, path)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (an executor loss re-reads files instead of
    recomputing joins), lets later plans prune and push filters into it, and
    makes its size known, so that the size-based broadcast can choose it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000


def sized(lookup: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A caller's lookup table, hinted for broadcast if it has at most
    ``max_rows`` rows (counted as far as that bound), else left as it is for the
    planner's own joins."""
    if lookup.isStreaming:
        return lookup
    small = lookup.limit(max_rows + 1).agg(F.count(F.lit(1))).first()[0] <= max_rows
    return F.broadcast(lookup) if small else lookup


_SPLIT, _OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@contextmanager
def scan_splits(spark: SparkSession, size: int | None) -> Iterator[None]:
    """What runs inside reads files in splits of at most ``size`` bytes, packed without a charge
    for each file; None leaves the session's settings alone."""
    before = {k: spark.conf.get(k) for k in (_SPLIT, _OPEN)}
    try:
        if size is not None:
            spark.conf.set(_SPLIT, str(max(1, size)))
            spark.conf.set(_OPEN, "0")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def split_size(df: DataFrame, rows: int) -> int | None:
    """Bytes of the files that ``df`` reads for about ``rows`` of its rows; None where it reads
    no files, or where the session's own splits are smaller."""
    spark, n = df.sparkSession, df.count()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    if n <= rows or not folders:
        return None
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in folders]
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths) * rows // n


def most_rows(df: DataFrame) -> int:
    """Rows of the largest task that reads ``df``."""
    return df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0] or 0
