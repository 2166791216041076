"""Structured Streaming: requests in, scored rows appended to the prediction log.

The stream is stateless (per-request enrichment + model + bracket), so the
only state is the source offsets and the sink's commit log in the checkpoint:
a restart on the same checkpoint resumes after the last committed batch and
the file sink's manifest gives exactly-once appends. Lookup tables are static
DataFrames joined to each micro-batch; they are small dimensions (airports,
airport-months), so the join is a broadcast inside each batch.

``availableNow`` drains whatever has arrived and stops, which is how a
scheduled job (or a test) runs the same code as a long-lived stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaylake.functions import columns as C
from delaylake.functions import constants as K
from delaylake.operators.projection import validate_requests
from delaylake.operators.score import score_requests
from delaylake.session import delete_path, materialize, scratch_path
from delaylake.sources.log import append_batch, committed_batch
from delaylake.sources.tables import PREDICTION_LOG_SCHEMA, REQUEST_SCHEMA

LOG_COLUMNS = [f.name for f in PREDICTION_LOG_SCHEMA.fields]


def read_request_stream(spark: SparkSession, in_path: str, fmt: str = "json",
                        max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(in_path)


def start_sink(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
               partition_by: str | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(out_path)


def stream_score_log(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                     weather_avg: DataFrame, coords: DataFrame, rates: DataFrame, classifier,
                     model_name: str = K.MODEL_NAMES["gbt"], fmt: str = "json",
                     rejected_path: str | None = None, regressor=None,
                     available_now: bool = True) -> list[StreamingQuery]:
    """Score requests arriving as files under ``in_path`` into the log at
    ``out_path``. Malformed requests (blank airline or airports) are routed to
    ``rejected_path`` when given, never into the log.

    The lookups are written once before the start, so micro-batches read
    small tables instead of recomputing the aggregates behind them. Returns
    the handles of all queries started (the log, then the rejects): wait for
    each with :func:`drain`.
    """
    weather_avg, coords, rates = (materialize(d, n) for d, n in (
        (weather_avg, "stream-weather"), (coords, "stream-coords"), (rates, "stream-rates")))
    src = read_request_stream(spark, in_path, fmt)
    valid, rejected = validate_requests(src)
    scored = score_requests(valid, weather_avg, coords, rates, classifier,
                            regressor=regressor, model_name=model_name, source="stream",
                            validate=False)
    out = scored.select("request_id", *LOG_COLUMNS).withColumn("log_date", F.to_date("timestamp"))
    started = [start_sink(out, out_path, checkpoint, available_now, partition_by="log_date")]
    if rejected_path:
        started.append(start_sink(rejected, rejected_path, checkpoint.rstrip("/") + "-rejected",
                                  available_now))
    return started


def start_log_sink(src: DataFrame, score: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]],
                   path: str, checkpoint: str, available_now: bool = True,
                   columns: list[str] | None = None) -> StreamingQuery:
    """Appends each micro-batch of ``src`` to the log of numbered batches at ``path``.

    ``score`` splits a micro-batch into log rows and rejects. The micro-batch is written to
    the shared checkpoint folder once, and both come from that copy: its source is read one
    time, and a lost executor costs a reread. A batch that is delivered again after its commit
    is left alone, one that was interrupted is written anew (``sources.log.append_batch``), so
    every request is in the log once.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= committed_batch(spark, path):
            return
        copy = scratch_path(spark, "micro-batch")
        batch.write.parquet(copy)
        try:
            scored, rejected = score(spark.read.schema(batch.schema).parquet(copy))
            append_batch(scored, rejected, path, batch_id, columns)
        finally:
            delete_path(spark, copy)

    w = src.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_requests_to_log(spark: SparkSession, in_path: str, path: str, checkpoint: str,
                           weather_avg: DataFrame, coords: DataFrame, rates: DataFrame, classifier,
                           model_name: str = K.MODEL_NAMES["gbt"], fmt: str = "json", regressor=None,
                           available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Requests that arrive as files, scored into the log of numbered batches at ``path``,
    malformed ones into its rejects: one query, one read of the input."""
    weather_avg, coords, rates = (materialize(d, n) for d, n in (
        (weather_avg, "stream-weather"), (coords, "stream-coords"), (rates, "stream-rates")))

    def score(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid, rejected = validate_requests(batch)
        return score_requests(valid, weather_avg, coords, rates, classifier, regressor=regressor,
                              model_name=model_name, source="stream", validate=False), rejected

    return start_log_sink(read_request_stream(spark, in_path, fmt, max_files), score, path, checkpoint,
                          available_now, ["request_id", *LOG_COLUMNS])


def event_brackets(ev: DataFrame) -> DataFrame:
    """Log rows of already-scored events (a probability per event)."""
    p = F.least(F.col("value") / 500, F.lit(1.0))
    rb = C.risk_bracket(p)
    pct, on_time = C.percent_fields(p)
    return ev.select("event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("source"),
                     pct.alias("delay_prob"), on_time.alias("on_time_prob"),
                     rb["label"].alias("prediction"), rb["risk"].alias("risk"))


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_event_stream(spark: SparkSession, events_dir: str, name_glob: str = "events*.parquet") -> DataFrame:
    return spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", name_glob).parquet(events_dir)


def stream_log_brackets(spark: SparkSession, events_dir: str, out_path: str,
                        checkpoint: str, available_now: bool = True,
                        name_glob: str = "events*.parquet") -> StreamingQuery:
    """Already-scored events (a probability per event) -> log rows with risk
    bracket and percents, appended as they arrive in ``events_dir``."""
    out = event_brackets(read_event_stream(spark, events_dir, name_glob))
    return start_sink(out, out_path, checkpoint, available_now)


def drain(q: StreamingQuery | list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries to finish; re-raise a failure.

    There is no limit unless the caller gives one; when it passes before the
    backlog is done the query is stopped and TimeoutError raised, so a partial
    sink is never taken for a complete one.
    """
    for one in q if isinstance(q, list) else [q]:
        if timeout_s is None:
            one.awaitTermination()
        elif not one.awaitTermination(timeout_s):
            one.stop()
            raise TimeoutError(f"the stream was not drained within {timeout_s} s")
        exc = one.exception()
        if exc is not None:
            raise RuntimeError(str(exc))
