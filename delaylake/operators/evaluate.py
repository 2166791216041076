"""Model evaluation as aggregates: one-row or per-class DataFrames.

AUC is exact (ties count one half) and distributed: scores are first collapsed
to (score, positives, negatives) by a partial aggregate; the negatives below
each score come from ranges of the scores that Spark samples: running totals
over the ranges, then a window inside each range. Nothing is sorted in one task
or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.session import materialize


def running_sum_before(df: DataFrame, order_col: str, value_col: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value_col`` over rows with a smaller ``order_col``.

    ``order_col`` must be unique (the caller aggregates first). The rows are dealt by ranges of
    the column that Spark samples from it, so they are spread evenly whatever its values are
    (an outlier, a narrow cluster), and written once, so that every branch of the plan agrees
    on the ranges. The sums before a range are a window over one row a range; a window inside
    each range finishes them.
    """
    r = materialize(df.repartitionByRange(order_col).withColumn("__range", F.spark_partition_id()), "score-ranges")
    earlier = (Window.unboundedPreceding, -1)
    totals = r.groupBy("__range").agg(F.sum(value_col).alias("__s"))
    w = Window.orderBy("__range").rowsBetween(*earlier)
    off = totals.select("__range", F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("__range").orderBy(order_col).rowsBetween(*earlier)
    return (r.withColumn("__in", F.coalesce(F.sum(value_col).over(inside), F.lit(0))).join(off, "__range")
             .withColumn(out, F.col("__off") + F.col("__in")).drop("__range", "__in", "__off"))


def score_histogram(scored: DataFrame, label: str = "delay_label",
                    score: str = "score") -> DataFrame:
    """(score, positives, negatives): one row per distinct score."""
    return (scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
                  .groupBy(F.col(score).alias("__s"))
                  .agg(F.sum(F.col(label).cast("long")).alias("__pos"),
                       F.sum((1 - F.col(label)).cast("long")).alias("__neg")))


def auc(scored: DataFrame, label: str = "delay_label", score: str = "score",
        threshold: float | None = None) -> DataFrame:
    """Area under the ROC curve (exact, ties one half), one row ``auc``; with
    ``threshold`` also the accuracy of ``score >= threshold``, read off the
    same histogram (no second pass over the scored rows)."""
    return histogram_auc(score_histogram(scored, label, score), threshold)


def histogram_auc(hist: DataFrame, threshold: float | None = None) -> DataFrame:
    """:func:`auc` of a table of distinct scores. Pairs are counted in 38 digits: with ten
    billion rows there are more than a long can hold."""
    c = running_sum_before(hist, "__s", "__neg", "__neg_below")
    wide = lambda x: F.col(x).cast("decimal(19,0)")
    pairs = lambda x: F.sum((wide("__pos") * wide(x)).cast("decimal(38,0)"))
    total = (F.sum(wide("__pos")).cast("decimal(19,0)") * F.sum(wide("__neg")).cast("decimal(19,0)"))
    below, tied = pairs("__neg_below").cast("double"), pairs("__neg").cast("double")
    aggs = [F.try_divide(below + tied / 2, total.cast("double")).alias("auc")]
    if threshold is not None:
        correct = F.when(F.col("__s") >= threshold, F.col("__pos")).otherwise(F.col("__neg"))
        aggs.append(F.try_divide(F.sum(correct), F.sum(F.col("__pos") + F.col("__neg"))
                                 .cast("double")).alias("accuracy"))
    return c.agg(*aggs)


def eval_binary(scored: DataFrame, label: str = "delay_label", score: str = "score",
                threshold: float = 0.5) -> DataFrame:
    """One row: AUC and accuracy of ``score >= threshold`` (one pass)."""
    return auc(scored, label, score, threshold)


def eval_report(scored: DataFrame, label: str = "delay_label",
                pred: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support, from one pass: each row
    adds to its true class and to its predicted class."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    hit = F.coalesce((y == p).cast("long"), F.lit(0))
    cells = scored.groupBy(y.alias("__y"), p.alias("__p")).agg(F.count(F.lit(1)).alias("__n"),
                                                               F.sum(hit).alias("__hit"))
    ends = F.explode(F.array(
        F.struct(F.col("__y").alias("cls"), F.col("__n").alias("sup"), F.lit(0).alias("pre"),
                 F.col("__hit").alias("tp")),
        F.struct(F.col("__p").alias("cls"), F.lit(0).alias("sup"), F.col("__n").alias("pre"),
                 F.lit(0).alias("tp"))))
    j = (cells.select(ends.alias("e")).where("e.cls is not null").groupBy(F.col("e.cls").alias("cls"))
              .agg(F.sum("e.sup").alias("support"), F.sum("e.pre").alias("predicted"),
                   F.sum("e.tp").alias("tp")))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support").cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return j.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), F.col("support").cast("long").alias("support"))


def eval_regression(scored: DataFrame, y: str, yhat: str, clip: tuple | None = (0, 300)) -> DataFrame:
    """One row: MAE, RMSE and R^2, predictions clipped to ``clip`` first."""
    p = C.clip(F.col(yhat), *clip) if clip else F.col(yhat)
    d = scored.select(F.col(y).cast("double").alias("__y"), p.cast("double").alias("__p")) \
              .where(F.col("__y").isNotNull() & F.col("__p").isNotNull())
    s = d.agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("__y") - F.col("__p"))).alias("sae"),
              F.sum(F.pow(F.col("__y") - F.col("__p"), 2)).alias("sse"),
              F.sum("__y").alias("sy"), F.sum(F.col("__y") * F.col("__y")).alias("syy"))
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    return s.select((F.col("sae") / F.col("n")).alias("mae"),
                    F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                    (1 - F.try_divide(F.col("sse"), sst)).alias("r2"))
