"""The prediction log: an append-only table, its latest rows, its display form."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.functions import constants as K
from delaylake.session import delete_path
from delaylake.sources.publish import children, read_pointer, write_pointer
from delaylake.sources.tables import PREDICTION_LOG_SCHEMA

MISSING = "—"
DAY, BATCH = "log_date", "batch_id"
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def append_prediction_log(scored: DataFrame, path: str, partition_by: str = "log_date") -> None:
    """Append scored rows to the Parquet log, partitioned by day.

    Each task writes its own files; a failed task's files are discarded by the
    commit protocol, so a lost executor never leaves half a batch behind.
    """
    cols = [f.name for f in PREDICTION_LOG_SCHEMA.fields]
    have = set(scored.columns)
    out = scored.select(*[F.col(c) if c in have else F.lit(None).cast(f.dataType).alias(c)
                          for c, f in zip(cols, PREDICTION_LOG_SCHEMA.fields)])
    out = out.withColumn(partition_by, F.to_date("timestamp"))
    out.write.mode("append").partitionBy(partition_by).parquet(path)


# --- a log of numbered batches ------------------------------------------------------------
#
# <path>/log/log_date=D/batch_id=N, <path>/rejected/batch_id=N and the file <path>/_committed
# with the last complete batch. Batches come in order (a stream's micro-batches); one beyond
# the committed number is invisible to read_log, whatever of it has been written.

def committed_batch(spark: SparkSession, path: str) -> int:
    """Number of the last complete batch; -1 before the first."""
    text = read_pointer(spark, f"{path.rstrip('/')}/_committed")
    return -1 if text is None else int(text)


def append_batch(scored: DataFrame, rejected: DataFrame | None, path: str, batch_id: int,
                 columns: list[str] | None = None) -> bool:
    """Appends batch ``batch_id`` to the log and its rejects, all or nothing.

    A batch that is already committed is left alone (False). What an interrupted attempt has
    left of this batch is deleted first, also in other days; the commit, one small file, comes
    after both writes.
    """
    spark, path = scored.sparkSession, path.rstrip("/")
    if batch_id <= committed_batch(spark, path):
        return False
    for day in children(spark, f"{path}/log"):
        if day.startswith(f"{DAY}="):
            delete_path(spark, f"{path}/log/{day}/{BATCH}={batch_id}")
    delete_path(spark, f"{path}/rejected/{BATCH}={batch_id}")
    rows = scored.select(*(columns or scored.columns)).withColumn(DAY, F.to_date("timestamp"))
    (rows.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("append")
     .partitionBy(DAY, BATCH).parquet(f"{path}/log"))
    if rejected is not None:
        rejected.write.parquet(f"{path}/rejected/{BATCH}={batch_id}")
    write_pointer(spark, f"{path}/_committed", str(batch_id))
    return True


def _committed(spark: SparkSession, path: str, part: str) -> DataFrame:
    df = spark.read.option("basePath", f"{path}/{part}").parquet(f"{path}/{part}")
    return df.where(F.col(BATCH) <= committed_batch(spark, path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the complete batches, with ``log_date`` and ``batch_id`` (both partitions)."""
    return _committed(spark, path.rstrip("/"), "log")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return _committed(spark, path.rstrip("/"), "rejected")


def log_days(spark: SparkSession, path: str) -> list[str | None]:
    """Days of a log partitioned by ``log_date``, the newest first, rows without one last.
    A directory listing: no file is read."""
    names = [c.partition("=")[2] for c in children(spark, path) if c.startswith(f"{DAY}=")]
    days = sorted((unquote(n) for n in names if n != _NULL_DAY), reverse=True)
    return days + [None] * (_NULL_DAY in names)


def latest_rows(spark: SparkSession, path: str, n: int = 25, ts: str = "timestamp",
                tie: str | None = None, log: DataFrame | None = None) -> DataFrame:
    """The latest ``n`` rows of a log under ``path`` partitioned by the day of ``ts``.

    Days are taken from the newest, twice as many each time, until they hold n rows; only
    those are sorted. A day's rows are all later than those of the day before, so the rows
    equal those of a sort of the whole log. ``log`` is the table to read (default: the files).
    """
    whole = spark.read.parquet(path) if log is None else log
    days = log_days(spark, path)
    part, take = whole.limit(0), 1
    while days:
        near = days[:take]
        if None in near or len(near) == len(days):
            part = whole
            break
        part = whole.where(F.col(DAY) >= F.lit(near[-1]).cast("date"))
        if part.limit(n).count() >= n:
            break
        take *= 2
    return prediction_history(part, n, ts, tie)


def prediction_history(log: DataFrame, n: int = 25, ts: str = "timestamp",
                       tie: str | None = None) -> DataFrame:
    """Latest ``n`` rows by timestamp (TakeOrderedAndProject: n rows per task)."""
    order = [F.desc(ts)] + ([F.col(tie)] if tie else [])
    return log.orderBy(*order).limit(n)


def history_display(log: DataFrame) -> DataFrame:
    """Display form of log rows: a missing text field shows '—', a missing
    source 'flask', a missing risk 'low'; the label follows the risk."""
    def txt(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c)

    risk = F.coalesce(F.col("risk"), F.lit("low"))
    label = (F.when(risk == "high", F.lit(K.RISK_TEXT["high"][1]))
              .when(risk == "medium", F.lit(K.RISK_TEXT["medium"][1]))
              .otherwise(F.lit(K.RISK_TEXT["low"][1])))
    return log.select(
        "timestamp",
        F.coalesce(F.col("source"), F.lit("flask")).alias("source"),
        txt("route"), txt("airline"), txt("travel_date"), txt("dep_time"),
        "delay_prob", risk.alias("risk"), label.alias("risk_label"), txt("model_used"),
    )
