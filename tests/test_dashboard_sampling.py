import hashlib

import pytest
from pyspark.sql import functions as F

from delaylake.operators import dashboard as D
from delaylake.operators import evaluate as E
from delaylake.operators import sampling as S
from tests.conftest import rows


def test_heatmap_pivot_absent_day_and_slot(spark):
    heat = spark.createDataFrame([
        (2, "Morning", 3.456, "Mon", "Low"),
        (2, "Night", 20.0, "Mon", "Medium"),
        (4, "Evening", -1.0, "Wed", "Low"),
    ], "day_of_week int, DepTime_label string, Average_Delay double, Day string, Delay_Level string")
    got = rows(D.heatmap_pivot(heat), order=False)
    assert [g[1] for g in got] == ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert got[0][2:] == (3.46, 0.0, 0.0, 20.0)
    assert got[1][2:] == (0.0, 0.0, 0.0, 0.0)      # absent day
    assert got[2][2:] == (0.0, 0.0, -1.0, 0.0)     # absent slots


def test_summary_peaks_ties_go_first(spark):
    monthly = spark.createDataFrame([(1, "Jan", 9.0), (2, "Feb", 9.0), (3, "Mar", 1.0)],
                                    "month_num int, Month string, Average_Arrival_Delay_Minutes double")
    ranking = spark.createDataFrame([("B Air", 5.0), ("A Air", 5.0)],
                                    "Airline string, Average_Arrival_Delay double")
    counts = spark.createDataFrame([(1, "Jan", 3), (2, "Feb", 7), (3, "Mar", 7)],
                                   "month_num int, Month string, Total_Delays bigint")
    got = {r[0]: (r[1], r[2]) for r in D.summary_peaks(monthly, ranking, counts).collect()}
    assert got == {"peak_month": ("Jan", 9.0), "top_airline": ("A Air", 5.0),
                   "delay_volume_peak": ("Feb", 7.0)}


def test_temp_trend_min_count_and_clip(spark):
    data = [(float(t), d) for t in (0.9, 1.1) for d in range(50)] + [(30.0, 5)]
    df = spark.createDataFrame(data, "tavg double, Arr_Delay int")
    got = rows(D.temp_delay_trend(df, min_count=40))
    assert [g[0] for g in got] == [0, 2]          # 0.45 -> 0, 0.55 -> 1*2; band 30 dropped
    assert all(g[3] == 50 for g in got)


def _md5_rank_pick(keys, seed, n):
    def h(k):
        m = hashlib.md5("|".join([str(x) for x in k] + [str(seed)]).encode()).hexdigest()
        return int(m[:15], 16)
    return sorted(sorted(keys, key=lambda k: (h(k), k))[:n])


@pytest.mark.parametrize("n", [0, 1, 37, 500, 1000])
def test_first_n_by_hash_matches_brute_force(spark, n):
    keys = [(i, i % 7) for i in range(1000)]
    df = spark.createDataFrame(keys, "a int, b int").repartition(5)
    nt = spark.createDataFrame([(n,)], "__n bigint")
    got = sorted(tuple(r) for r in S.first_n_by_hash(df, ["a", "b"], nt).collect())
    assert got == _md5_rank_pick(keys, 42, n)


def test_split_stratified_per_label(spark):
    data = [(i, i % 3 == 0) for i in range(300)]
    df = spark.createDataFrame(data, "k int, y boolean").withColumn("y", F.col("y").cast("int"))
    tr, te = S.split_stratified(df, "y", ["k"], 0.8)
    counts = {r[0]: r[1] for r in tr.groupBy("y").count().collect()}
    assert counts == {1: 80, 0: 160}
    assert tr.count() + te.count() == 300
    assert tr.join(te, "k").count() == 0


def test_split_train_test_independent_of_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, _ = S.split_train_test(df, ["k"])
    b, _ = S.split_train_test(df.repartition(7), ["k"])
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())


@pytest.mark.parametrize("delays,expect_ontime", [
    ([20, 30, 40, 50] + [0] * 10, 2),     # more on-time than delayed/2
    ([20, 30, 40, 50] + [0], 1),          # fewer on-time
    ([0, 5, -40], 0),                     # none delayed
])
def test_balanced_sample(spark, delays, expect_ontime):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(delays)] + [(99, None)],
                               "k int, Arr_Delay int")
    out = S.balanced_sample(df, ["k"])
    got = [r[0] for r in out.select("Arr_Delay").collect()]
    delayed = [min(max(d, -30), 300) for d in delays if d > 15]
    assert sorted(x for x in got if x > 15) == sorted(delayed)
    ontime = [x for x in got if x <= 15]
    assert len(ontime) == expect_ontime and all(x >= 0 for x in ontime)


def test_auc_matches_pairwise_brute_force(spark):
    import random
    rnd = random.Random(1)
    data = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(data, "y int, score double")
    got = E.auc(df, "y", "score").collect()[0][0]
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    num = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    assert got == pytest.approx(num / (len(pos) * len(neg)), abs=1e-12)


def test_auc_with_many_distinct_scores_is_stable_and_equals_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(150_000, numPartitions=7).select(
        (F.abs(F.xxhash64("id")) % 1_000_003 / 1_000_003.0).alias("u"), "id")
    df = df.select(F.when(F.col("id") % 50 == 0, F.round("u", 2)).otherwise(F.pow("u", 3)).alias("score"),
                   (F.abs(F.xxhash64(F.col("id") + 7)) % 1000 < 300 + 400 * F.col("u")).cast("int").alias("y"))
    assert df.select("score").distinct().count() > 100_000
    got = [E.auc(df, "y", "score").first()[0] for _ in range(2)]
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df)
    assert got[0] == got[1] and abs(got[0] - want) < 1e-9


def test_running_sum_before(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(100)], "o int, v int")
    got = {r["o"]: r["s"] for r in E.running_sum_before(df, "o", "v", "s").collect()}
    assert all(got[i] == sum(j % 5 for j in range(i)) for i in range(100))


def test_eval_report_and_regression(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "delay_label int, prediction int")
    rep = {r[0]: tuple(r[1:]) for r in E.eval_report(df).collect()}
    assert rep[1] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert rep[0] == (pytest.approx(2 / 3), 1.0, pytest.approx(0.8), 2)
    odd = spark.createDataFrame([(0, 2), (None, 0), (0, None)], "delay_label int, prediction int")
    rep = {r[0]: tuple(r[1:]) for r in E.eval_report(odd).collect()}
    assert rep == {0: (0.0, 0.0, 0.0, 2), 2: (0.0, 0.0, 0.0, 0)}
    reg = spark.createDataFrame([(10.0, 12.0), (20.0, -5.0), (30.0, 400.0)], "y double, p double")
    mae, rmse, r2 = E.eval_regression(reg, "y", "p").collect()[0]
    # predictions clipped to [0, 300] first: 12, 0, 300
    assert mae == pytest.approx((2 + 20 + 270) / 3)
    assert rmse == pytest.approx(((4 + 400 + 72900) / 3) ** 0.5)
    assert r2 == pytest.approx(1 - (4 + 400 + 72900) / 200.0)


def test_first_n_by_hash_with_a_hot_group_of_copies(spark):
    # one key copied 3000 times (most of the table) plus 1000 distinct keys
    keys = [(i, i % 7) for i in range(1000)]
    data = keys + [(5000, 1)] * 3000
    df = spark.createDataFrame(data, "a int, b int").repartition(6)
    for n in (10, 400, 2500, 4000):
        nt = spark.createDataFrame([(n,)], "__n bigint")
        got = sorted(tuple(r) for r in S.first_n_by_hash(df, ["a", "b"], nt).collect())
        assert got == _md5_rank_pick(data, 42, n), n
    tr, te = S.split_stratified(df.withColumn("y", F.lit(1)), "y", ["a", "b"], 0.5)
    assert tr.count() == 2000 and te.count() == 2000
    assert sorted(tuple(r) for r in tr.unionByName(te).select("a", "b").collect()) == sorted(data)


def test_samples_do_not_exchange_their_rows(spark):
    """The only exchanges on the rows' side are those of the boundary bucket."""
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("y"),
                                  F.concat(F.lit("payload"), F.col("id").cast("string")).alias("v"))
    flagged = S.flag_stratified(df, "y", ["k"], 0.8)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    first = plan[:plan.index("Union") + 1] + plan[plan.index("Union"):].split("Scan parquet")[0]
    assert "Exchange hashpartitioning" not in first and "BroadcastExchange" in plan
    assert flagged.where("is_train").groupBy("y").count().orderBy("y").collect() == [
        (y, int(n * 0.8)) for y, n in ((0, 1667), (1, 1667), (2, 1666))]
