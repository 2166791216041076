"""Classifiers and the delay-minutes regressor with Spark MLlib.

Training is distributed by MLlib (tree learners aggregate split statistics
per partition; linear models run treeAggregate gradient passes). Every
model is a ``PipelineModel`` (index -> one-hot -> assemble -> learner), so
the same object scores batches and streams and persists with
``write().overwrite()``.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.functions import constants as K
from delaylake.operators.forest import FOLDER as _FOREST
from delaylake.operators.forest import BlockForest, block_forest
from delaylake.operators.sampling import folded_counts
from delaylake.operators.svm import (LinearMember, complete, encoded, fit_inputs, member_margin, sigmoid,
                                     squared_hinge)
from delaylake.operators.trees import FOLDER as _BOOSTED
from delaylake.operators.trees import BoostedTrees, boosted_trees
from delaylake.session import materialize, most_rows, path_exists, scan_splits, split_size
from delaylake.sources.publish import current, publish

log = logging.getLogger(__name__)

CLASSIFIER_NUMERIC = ["tavg", "prcp", "wspd", "pres", "LATITUDE", "LONGITUDE", "month",
                      "day_of_week", "dep_airport_delay_avg", "arr_airport_delay_avg"]
# dow_iso: ISO day of week (Monday = 1), named apart from the classifier's
# day_of_week (Sunday = 1) because column names resolve case-insensitively.
REGRESSOR_NUMERIC = ["Flight_Duration", "Aicraft_age", "dow_iso", "month", "day",
                     "is_weekend", "tavg", "prcp", "wspd", "pres", "LATITUDE", "LONGITUDE"]


def encode_stages(cats: Sequence[str] = tuple(K.CATEGORICAL_COLS), numeric: Sequence[str] = (),
                  drop_last: bool = True, out: str = "features", tag: str = "") -> list:
    """index (keep unseen) -> one-hot -> assemble (rows with a null input are
    skipped). ``tag`` suffixes the intermediate columns so several fitted
    pipelines can be applied to one DataFrame in sequence."""
    cats = list(cats)
    idx = [c + "_idx" + tag for c in cats]
    vec = [c + "_vec" + tag for c in cats]
    return [
        StringIndexer(inputCols=cats, outputCols=idx, handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=vec, dropLast=drop_last),
        VectorAssembler(inputCols=list(numeric) + vec, outputCol=out, handleInvalid="skip"),
    ]


FIT_ROWS = 200_000      # training rows in a task: the learners keep them in memory and read them at every step


def dealt(train: DataFrame) -> DataFrame:
    """The training rows dealt evenly over tasks of at most about ``FIT_ROWS``: a split of a
    compressed file holds millions of rows, which the learner would keep as one block."""
    tasks = -(-train.count() // FIT_ROWS)
    return train if tasks <= 1 else train.repartition(max(tasks, train.sparkSession.sparkContext.defaultParallelism))


def fitted(train: DataFrame, encode: Sequence, learner, tasks: int | None = None) -> PipelineModel:
    """Encoders and learner as one model. The encoders are fitted where the rows lie. The
    learner reads its rows in splits of about ``FIT_ROWS``, if their files allow that; else
    they are dealt (:func:`dealt`), once. With ``tasks`` they are always dealt, evenly over that
    many tasks."""
    encoder = Pipeline(stages=list(encode)).fit(train)
    if tasks:
        return PipelineModel([*encoder.stages, learner.fit(encoder.transform(train.repartition(tasks)))])
    with scan_splits(train.sparkSession, split_size(train, FIT_ROWS)):
        rows = train if most_rows(train) <= 2 * FIT_ROWS else dealt(train)
        return PipelineModel([*encoder.stages, learner.fit(encoder.transform(rows))])


def gbt_classifier(train: DataFrame, max_iter: int = 20, max_depth: int = 5,
                   step: float = 0.1, seed: int = K.SEED, label: str = "delay_label",
                   numeric: Sequence[str] = tuple(CLASSIFIER_NUMERIC)) -> PipelineModel:
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step, seed=seed)
    return fitted(train, encode_stages(numeric=numeric), gbt)


GROWN_ROWS = 4_000_000  # rows of all trees from which a forest is grown over binned blocks
KEPT_IDS = 100_000_000  # node ids (a row's, one a tree) that a forest keeps for each core: 400 MB


def rf_classifier(train: DataFrame, num_trees: int = 50, max_depth: int = 10,
                  min_instances: int = 1, weight_col: str | None = None,
                  seed: int = K.SEED, label: str = "delay_label",
                  numeric: Sequence[str] = tuple(CLASSIFIER_NUMERIC)) -> PipelineModel | BlockForest:
    """Random forest; ``weight_col`` carries balanced class weights (see
    ``features.with_class_weights``). MLlib has no min-samples-split knob;
    ``min_instances`` is the per-leaf minimum.

    A forest of two classes that draws ``GROWN_ROWS`` rows or more in all is grown over binned blocks
    (``operators.forest``); MLlib grows the others. While ``KEPT_IDS`` allows it, each row keeps the node it has reached in every tree, so that a
    level costs a step of each tree and not a walk from its root; the trees are the same. Rows
    that fill one round of the cores are dealt evenly over them: a level takes as long as its
    longest task, and far longer than that one exchange."""
    kw = {"weightCol": weight_col} if weight_col else {}
    n, odd = train.agg(F.count(F.lit(1)), F.count_if(~F.col(label).isin(0, 1))).first()
    cores = train.sparkSession.sparkContext.defaultParallelism
    if n * num_trees >= GROWN_ROWS and not odd:
        return block_forest(train, label, weight_col, numeric, K.CATEGORICAL_COLS, num_trees, max_depth,
                            min_instances, seed)
    kw |= {"cacheNodeIds": n * num_trees <= KEPT_IDS * cores, "checkpointInterval": -1}
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances,
                                seed=seed, **kw)
    one_round = n <= 2 * FIT_ROWS * cores
    return fitted(train, encode_stages(numeric=numeric), rf, cores if one_round else None)


@dataclass
class CalibratedSVM:
    """Linear SVMs, one per fold, each with a sigmoid fitted on its held-out
    fold (Platt scaling); the probability is the mean of the calibrated
    probabilities, as scikit-learn's CalibratedClassifierCV does by default.
    Scoring is a column expression; rows with a missing numeric input are left out."""
    members: list[LinearMember]

    def transform(self, df: DataFrame) -> DataFrame:
        out = complete(df, list(self.members[0].numeric))
        probs = [m.probability() for m in self.members]
        p = sum(probs[1:], probs[0]) / len(probs)
        return (out.withColumn("__p", p)
                   .withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))))
                   .withColumn("prediction", (F.col("__p") >= 0.5).cast("double"))
                   .drop("__p"))

    def save(self, path: str) -> None:
        """The members' weights under ``path``: a row for each input of each member."""
        rows = [r for i, m in enumerate(self.members) for r in m.rows(i)]
        (SparkSession.active().createDataFrame(rows, LinearMember.ROWS).coalesce(1)
         .write.mode("overwrite").json(f"{path.rstrip('/')}/{_MEMBERS}"))

    @classmethod
    def load(cls, path: str) -> CalibratedSVM:
        rows = SparkSession.active().read.schema(LinearMember.ROWS).json(f"{path.rstrip('/')}/{_MEMBERS}").collect()
        return cls([LinearMember.from_rows([r for r in rows if r["member"] == i])
                    for i in sorted({r["member"] for r in rows})])


_MEMBERS = "members"


def svm_calibrated(train: DataFrame, keys: Sequence[str], C_: float = 0.1, balanced: bool = True,
                   folds: int = 3, max_iter: int = 50, tol: float = 1e-6, seed: int = K.SEED,
                   label: str = "delay_label", numeric: Sequence[str] = tuple(CLASSIFIER_NUMERIC),
                   cats: Sequence[str] = tuple(K.CATEGORICAL_COLS)) -> CalibratedSVM:
    """Linear SVM (squared hinge, L2, cost ``C_`` on the loss sum, balanced class weights) with
    sigmoid calibration over ``folds`` folds, on inputs standardised over all training rows.

    The folds are stratified by label (``sampling.stratified_folds``). A member is fitted on
    the rows of the other folds, its sigmoid on the margins of its own; all members are fitted
    together, one aggregate a step (``operators.svm``). The encoded rows are written once.
    """
    inputs = fit_inputs(complete(train, numeric), numeric, cats)
    usable = complete(train, numeric).where(F.col(label).isNotNull())
    # equal rows are one, with a count: a group of copies costs one row a fold
    rows = folded_counts(usable.select(*dict.fromkeys([*keys, label, *numeric, *cats])), label, keys, folds, seed)
    rows = materialize(encoded(rows, inputs, label, ["fold", "n"]), "svm-rows")
    n = {(r["fold"], r["y"]): r["n"] for r in rows.groupBy("fold", "y").agg(F.sum("n").alias("n")).collect()}
    per = [[sum(c for (f, y), c in n.items() if f != k and y == s) for s in (-1, 1)] for k in range(folds)]
    share = [[float((low + high) / (2 * x)) if balanced and x else 1.0 for x in (low, high)] for low, high in per]
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col("fold"))
    weight = F.lit([w for pair in share for w in pair])[2 * F.col("member") + F.when(F.col("y") > 0, 1).otherwise(0)]
    fit = rows.withColumn("member", F.explode(others)).withColumn("c", F.col("n") * weight)
    theta = squared_hinge(fit, inputs, folds, C_, max_iter, tol)
    beta = theta @ inputs.scaling()
    held = rows.select(F.col("fold").alias("member"), "y", "n", member_margin(inputs, beta, F.col("fold")).alias("f"))
    curve = sigmoid(held, folds, max_iter)
    return CalibratedSVM([LinearMember.of(inputs, theta[k], *curve[k]) for k in range(folds)])


def skipped_rows(df: DataFrame, numeric: Sequence[str] = tuple(CLASSIFIER_NUMERIC)) -> DataFrame:
    """One row ``skipped``: how many rows the assembler leaves out because a
    numeric input is missing. Report it beside the scores."""
    bad = F.lit(False)
    for c in numeric:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return df.agg(F.sum(bad.cast("long")).alias("skipped"))


def gbt_regressor(train: DataFrame, label: str = "Arr_Delay", max_iter: int = 100,
                  max_depth: int = 4, step: float = 0.1, subsample: float = 0.8,
                  seed: int = K.SEED,
                  numeric: Sequence[str] = tuple(REGRESSOR_NUMERIC)) -> BoostedTrees:
    """Delay minutes. Every category has a split of its own, unknown ones too (one-hot without
    drop). Trees need no scaling, so none is fitted. The trees are grown over binned blocks
    (``operators.trees``): MLlib's learner keeps some 240 bytes of a row and visits each of its
    one-hot slots, in hundreds of passes."""
    return boosted_trees(train, label, numeric, K.CATEGORICAL_COLS, max_iter, max_depth, step, subsample, seed)


def save_model(model: PipelineModel | CalibratedSVM | BoostedTrees | BlockForest, path: str) -> None:
    if isinstance(model, CalibratedSVM | BoostedTrees | BlockForest):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | CalibratedSVM | BoostedTrees | BlockForest:
    for folder, kind in ((_BOOSTED, BoostedTrees), (_FOREST, BlockForest)):
        if path_exists(SparkSession.active(), f"{path.rstrip('/')}/{folder}"):
            return kind.load(path)
    if path_exists(SparkSession.active(), f"{path.rstrip('/')}/{_MEMBERS}"):
        return CalibratedSVM.load(path)
    return PipelineModel.load(path)


def publish_model(model: PipelineModel | CalibratedSVM, base: str) -> str:
    """The model as a new version of ``base``: complete before any reader is pointed to it."""
    return publish(SparkSession.active(), base, lambda path: save_model(model, path))


def load_published(base: str) -> PipelineModel | CalibratedSVM:
    path = current(SparkSession.active(), base)
    if path is None:
        raise FileNotFoundError(f"no model is published at {base}")
    return load_model(path)


def load_first_published(bases: Sequence[tuple[str, str]]) -> tuple[PipelineModel | CalibratedSVM, str]:
    """The first published model of ``bases`` (base, name); returns (model, name).

    A base without a published version falls through to the next, with a warning, also where a
    write was cut off half way; a published model that cannot be read is an error."""
    for base, name in bases:
        if current(SparkSession.active(), base) is not None:
            return load_published(base), name
        log.warning("model %s is not published at %s; trying the next one", name, base)
    raise FileNotFoundError(f"no model at any of {[b for b, _ in bases]}")


def load_first(paths: Sequence[tuple[str, str]]) -> tuple[PipelineModel | CalibratedSVM, str]:
    """The first model of ``paths`` (path, name) that exists; returns (model, name).

    Only a missing path falls through to the next, with a warning; any other
    failure (storage, a damaged model) is raised, so it can never change the
    model silently."""
    for path, name in paths:
        if path_exists(SparkSession.active(), path):
            return load_model(path), name
        log.warning("model %s is not at %s; trying the next one", name, path)
    raise FileNotFoundError(f"no model at any of {[p for p, _ in paths]}")


def feature_names(scored: DataFrame, features: str = "features") -> list[str]:
    """Vector slot names from the assembler's ML attribute metadata, by index."""
    meta = scored.schema[features].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs += [(a["idx"], a["name"]) for a in group]
    return [n for _, n in sorted(attrs)]


def feature_importance(model: PipelineModel, scored: DataFrame,
                       features: str = "features") -> DataFrame:
    """(feature, share) of the tree model's importances, largest first.

    The importance vector has one entry per feature slot (tens of values);
    it becomes a small DataFrame."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = feature_names(scored, features)
    spark = scored.sparkSession
    rows = [(names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, share double")
    return df.orderBy(F.desc("share"), "feature")


def positive_probability(scored: DataFrame, col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]
