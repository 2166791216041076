"""Published versions, the log of numbered batches, and its newest rows."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from delaylake.operators import models as M
from delaylake.sources import log as LOG
from delaylake.sources import publish as PUB
from delaylake.sources import tables as TB
from delaylake.streaming.score_stream import drain, start_log_sink

SCHEMA = "k int, timestamp timestamp, source string"
DAY = dt.datetime(2023, 5, 1)


def batch(spark, ks, day=0):
    return spark.createDataFrame([(k, DAY + dt.timedelta(days=day, minutes=k), "s") for k in ks], SCHEMA)


def keys(df):
    return sorted(r["k"] for r in df.collect())


def test_readers_see_the_old_version_during_and_after_a_failed_write(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    assert PUB.current(spark, base) is None
    with pytest.raises(FileNotFoundError):
        PUB.read_published(spark, base)
    PUB.publish_table(batch(spark, [1, 2]), base)
    held = PUB.read_published(spark, base)
    seen = []

    def write(path):
        batch(spark, [3]).write.parquet(path)
        seen.append(keys(PUB.read_published(spark, base)))     # while the new one is being written
        raise RuntimeError("executor lost for good")

    with pytest.raises(RuntimeError):
        PUB.publish(spark, base, write)
    assert seen == [[1, 2]] and keys(PUB.read_published(spark, base)) == [1, 2]
    PUB.publish_table(batch(spark, [4]), base)
    assert keys(PUB.read_published(spark, base)) == [4] and keys(held) == [1, 2]
    assert PUB.prune(spark, base) == 2 and keys(PUB.read_published(spark, base)) == [4]


def test_lookups_of_two_runs_never_mix(spark, tmp_dir):
    base = os.path.join(tmp_dir, "lookups")
    TB.publish_lookups({"a": batch(spark, [1]), "b": batch(spark, [2])}, base)
    bad = batch(spark, [9]).withColumn("k", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        TB.publish_lookups({"a": batch(spark, [8]), "b": bad}, base)
    assert [keys(TB.read_lookup(spark, base, n)) for n in "ab"] == [[1], [2]]


def test_a_half_written_model_is_no_model(spark, tmp_dir):
    from pyspark.ml.feature import StringIndexer
    good = StringIndexer(inputCol="source", outputCol="i").fit(batch(spark, [1]))
    half = os.path.join(tmp_dir, "gbt", "_v-half", "stages", "0")
    good.write().save(half)
    from pyspark.ml import Pipeline
    model = Pipeline(stages=[good]).fit(batch(spark, [1]))
    M.publish_model(model, os.path.join(tmp_dir, "svm"))
    got, name = M.load_first_published([(os.path.join(tmp_dir, n), n) for n in ("gbt", "svm")])
    assert name == "svm" and got.transform(batch(spark, [1])).first()["i"] == 0.0
    with pytest.raises(FileNotFoundError):
        M.load_first_published([(os.path.join(tmp_dir, "gbt"), "gbt")])


def snapshot(spark, path):
    return sorted((r["k"], str(r["log_date"]), r["batch_id"]) for r in LOG.read_log(spark, path).collect())


def test_batches_are_appended_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    assert LOG.append_batch(batch(spark, [1, 2]), batch(spark, [100]), path, 0)
    assert LOG.append_batch(batch(spark, [3], 1), batch(spark, []), path, 1)
    before = snapshot(spark, path)
    assert not LOG.append_batch(batch(spark, [1, 2]), batch(spark, [100]), path, 0)       # delivered again
    assert not LOG.append_batch(batch(spark, [3], 1), None, path, 1)
    assert snapshot(spark, path) == before == [(1, "2023-05-01", 0), (2, "2023-05-01", 0), (3, "2023-05-02", 1)]
    assert keys(LOG.read_rejected(spark, path)) == [100]


@pytest.mark.parametrize("stop", ["rejects", "commit"])
def test_an_interrupted_batch_is_invisible_and_written_anew(spark, tmp_dir, monkeypatch, stop):
    path = os.path.join(tmp_dir, "log")
    LOG.append_batch(batch(spark, [1]), batch(spark, [100]), path, 0)
    before = snapshot(spark, path)
    if stop == "rejects":
        lost = batch(spark, [101]).withColumn("k", F.raise_error(F.lit("stopped")).cast("int"))
        with pytest.raises(Exception, match="stopped"):
            LOG.append_batch(batch(spark, [2, 3]), lost, path, 1)
    else:
        with monkeypatch.context() as m:
            m.setattr(LOG, "write_pointer", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
            with pytest.raises(RuntimeError):
                LOG.append_batch(batch(spark, [2, 3]), batch(spark, [101]), path, 1)
    assert snapshot(spark, path) == before and keys(LOG.read_rejected(spark, path)) == [100]
    LOG.append_batch(batch(spark, [2, 3], day=1), batch(spark, [101]), path, 1)       # past midnight
    assert snapshot(spark, path) == before + [(2, "2023-05-02", 1), (3, "2023-05-02", 1)]
    assert keys(LOG.read_rejected(spark, path)) == [100, 101]


def test_sink_reads_each_batch_once_and_survives_a_restart(spark, tmp_dir):
    inbox, path, ck = (os.path.join(tmp_dir, n) for n in ("in", "log", "ck"))
    batch(spark, [1, 2, 50]).coalesce(1).write.mode("append").parquet(inbox)
    calls = []

    def run(fail=False):
        def score(df):
            calls.append(df.inputFiles())
            if fail:
                raise RuntimeError("stopped")
            return df.where("k < 50"), df.where("k >= 50")
        drain(start_log_sink(spark.readStream.schema(SCHEMA).parquet(inbox), score, path, ck))

    run()
    assert [r[0] for r in snapshot(spark, path)] == [1, 2] and keys(LOG.read_rejected(spark, path)) == [50]
    batch(spark, [3, 51], 1).coalesce(1).write.mode("append").parquet(inbox)
    with pytest.raises(Exception):
        run(fail=True)
    run()
    run()                                          # nothing new
    assert [r[0] for r in snapshot(spark, path)] == [1, 2, 3] and keys(LOG.read_rejected(spark, path)) == [50, 51]
    assert len(calls) == 3 and all("micro-batch" in f for files in calls for f in files)


@pytest.mark.parametrize("n", [1, 7, 25, 400])
def test_latest_rows_equal_a_sort_of_the_whole_log(spark, tmp_dir, n):
    rnd = random.Random(n)
    rows = [(i, DAY + dt.timedelta(days=rnd.choice([0, 0, 3, 9, 30]), minutes=rnd.randrange(4)), "s") for i in range(90)]
    rows += [(900 + i, None, "s") for i in range(3)]
    late = [(500 + i, DAY + dt.timedelta(minutes=i), "late") for i in range(5)]
    path = os.path.join(tmp_dir, "log")
    for part in (rows, late):
        spark.createDataFrame(part, SCHEMA).withColumn("log_date", F.to_date("timestamp")).write.mode(
            "append").partitionBy("log_date").parquet(path)
    got = LOG.latest_rows(spark, path, n, tie="k")
    want = LOG.prediction_history(spark.read.parquet(path), n, tie="k")
    assert [r["k"] for r in got.collect()] == [r["k"] for r in want.collect()]
    if n < 25:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "log_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_latest_rows_of_an_empty_log(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    df = batch(spark, []).withColumn("log_date", F.current_date())
    assert LOG.latest_rows(spark, path, 5, log=df).collect() == []
