"""Pipeline stages with training statistics: values, persistence, another session."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from delaylake.operators.stages import TrainingFill, TrainingFillModel
from tests.conftest import ROOT

SCHEMA = "k int, a double, b double, delay int, y double"


def train(spark):
    rows = [(i, None if i % 5 == 0 else float(i), None if i % 7 == 0 else float(i % 4), 3 * i, 2.0 * i + 1) for i in range(60)]
    return spark.createDataFrame(rows + [(99, float("nan"), None, None, 0.0)], SCHEMA)


def fill():
    return TrainingFill(means=["a"], medians=["b"], constants={"c": 7.5}, clips={"y": [None, 50.0]},
                        label=["delay", "late", 15])


def test_fills_come_from_training_and_requests_have_no_outcome(spark):
    df = train(spark)
    model = fill().fit(df)
    a = [float(i) for i in range(60) if i % 5]
    b = sorted(float(i % 4) for i in range(60) if i % 7)
    want = {"a": sum(a) / len(a), "b": (b[len(b) // 2] + b[(len(b) - 1) // 2]) / 2, "c": 7.5}
    assert model.values() == pytest.approx(want)
    requests = spark.createDataFrame([(1, None, None), (2, 1e6, None), (3, float("nan"), 5.0)], "k int, a double, b double")
    got = {r["k"]: (r["a"], r["b"], r["c"]) for r in model.transform(requests).collect()}
    assert got[1] == pytest.approx((want["a"], want["b"], 7.5)) and got[2][0] == 1e6
    assert got[3] == pytest.approx((want["a"], 5.0, 7.5))
    full = model.transform(df).collect()
    assert max(r["y"] for r in full) == 50.0
    assert all(r["late"] == int((r["delay"] or 0) > 15) for r in full)


def test_estimator_and_model_are_saved(spark, tmp_dir):
    est, model = fill(), fill().fit(train(spark))
    est.save(os.path.join(tmp_dir, "e"))
    model.save(os.path.join(tmp_dir, "m"))
    again = TrainingFill.load(os.path.join(tmp_dir, "e")).fit(train(spark))
    assert again.values() == TrainingFillModel.load(os.path.join(tmp_dir, "m")).values() == model.values()
    assert TrainingFill(means=["a"]).fit(train(spark).limit(0)).values() == {}


def test_pipeline_predicts_the_same_in_another_session(spark, tmp_dir):
    df = train(spark)
    stages = [fill(), VectorAssembler(inputCols=["a", "b", "c"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")]
    model = Pipeline(stages=stages).fit(df)
    path, rows = os.path.join(tmp_dir, "p"), os.path.join(tmp_dir, "rows")
    model.write().overwrite().save(path)
    df.write.parquet(rows)
    want = {r["k"]: r["prediction"] for r in model.transform(df).collect()}
    assert {r["k"]: r["prediction"] for r in PipelineModel.load(path).transform(df).collect()} == want
    code = ("import json, sys; sys.path.insert(0, sys.argv[1])\n"
            "from pyspark.ml import PipelineModel\nfrom delaylake.session import build_session\n"
            "s = build_session('local[2]', 2, extra={'spark.driver.memory': '1g'})\n"
            "out = PipelineModel.load(sys.argv[2]).transform(s.read.parquet(sys.argv[3]))\n"
            "print('OUT' + json.dumps({str(r['k']): r['prediction'] for r in out.collect()}))\n")
    said = subprocess.run([sys.executable, "-c", code, ROOT, path, rows], capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "SPARK_CONN"))})
    got = json.loads(said.stdout.split("OUT")[1])
    assert {int(k): v for k, v in got.items()} == want
