"""Steps that the fits and the scoring queries share: flights written once, rows read in small splits."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from delaylake.operators import clean, models
from delaylake.plans import fixtures as X
from delaylake.plans import q_models as QM
from delaylake.session import materialize, most_rows
from delaylake.sources import views as V
from tests.conftest import SF001, rows


def test_stored_flights_find_duplicates_without_an_exchange(spark):
    stored = V.stored_flights(spark, SF001)
    plan = clean.dedup_rows(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert stored.exceptAll(V.flights(spark, SF001)).count() == 0
    assert stored.count() == V.flights(spark, SF001).count()


def test_scoring_queries_read_one_copy_of_the_flights(spark):
    plan = QM._requests(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert rows(QM._requests(spark, SF001)) == rows(X.requests(spark, SF001))
    assert X.shared_flights(spark, SF001) is X.shared_flights(spark, SF001)


def test_fit_reads_its_files_in_small_splits_and_deals_nothing(spark, monkeypatch):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    train = materialize(spark.range(4000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast(
        "double").alias("y")).repartition(40), "fit-rows")
    monkeypatch.setattr(models, "FIT_ROWS", 250)
    seen, dealt = [], []

    class Learner(LinearRegression):
        def fit(self, df, params=None):
            seen.append(most_rows(df))
            return super().fit(df, params)

    real = models.dealt
    monkeypatch.setattr(models, "dealt", lambda df: dealt.append(df) or real(df))
    encode = [VectorAssembler(inputCols=["x"], outputCol="features")]
    models.fitted(train, encode, Learner(labelCol="y"))
    assert seen[0] <= 500 and not dealt
    assert {k: spark.conf.get(k) for k in before} == before
    models.fitted(train.coalesce(1), encode, Learner(labelCol="y"))       # one task holds all: dealt
    assert len(dealt) == 1 and seen[1] <= 600
