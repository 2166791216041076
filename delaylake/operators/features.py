"""Feature encoding with Spark MLlib transformers and DataFrame expressions.

Fitting a StringIndexer is one distributed count per column (a tree
aggregate of value -> count maps); only the label list, bounded by the
category cardinality, reaches the driver. Everything else is a per-row
expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.functions import constants as K


def string_index(train: DataFrame, cols: Sequence[str] = tuple(K.CATEGORICAL_COLS),
                 order: str = "frequencyDesc", handle_invalid: str = "keep",
                 suffix: str = "_idx"):
    """One multi-column StringIndexer fit: most frequent -> 0, ties
    alphabetical; unseen or null values -> the extra index ``len(labels)``."""
    cols = list(cols)
    return StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols],
                         stringOrderType=order, handleInvalid=handle_invalid).fit(train)


def label_encode(train: DataFrame, cols: Sequence[str] = ("Dep_Airport", "Arr_Airport"),
                 suffix: str = "_Encoded"):
    """Category -> position in sorted order (0-based)."""
    return string_index(train, cols, order="alphabetAsc", suffix=suffix)


def one_hot(indexed: DataFrame, idx_cols: Sequence[str], suffix: str = "_vec",
            drop_last: bool = True):
    """Index -> sparse 0/1 vector. With ``keep`` indexing and ``drop_last`` an
    unseen category (the extra index) becomes the all-zero vector."""
    idx_cols = list(idx_cols)
    outs = [c[:-4] + suffix if c.endswith("_idx") else c + suffix for c in idx_cols]
    return OneHotEncoder(inputCols=idx_cols, outputCols=outs, dropLast=drop_last).fit(indexed)


MAX_CATEGORIES = 10_000


def categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct non-null values; raises beyond ``max_categories`` of them
    (each becomes a column or an index, and the list is fetched)."""
    rows = (df.where(F.col(col).isNotNull()).select(col).distinct()
              .limit(max_categories + 1).collect())
    if len(rows) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories")
    return sorted(r[0] for r in rows)


def dummy_columns(df: DataFrame, cols: Sequence[str], cats: dict[str, list[str]] | None = None,
                  drop_first: bool = False, keep_source: bool = False) -> DataFrame:
    """One 0/1 column ``<col>_<value>`` per category (sorted), optionally
    without the first; a null category gives all zeros. The category list
    fixes the schema, so it comes from ``cats`` or, when absent, from one
    distinct query per column (bounded by the column's cardinality)."""
    cats = dict(cats or {})
    out = [F.col(c) for c in df.columns if keep_source or c not in cols]
    for c in cols:
        values = list(cats.get(c) or categories(df, c))
        if drop_first:
            values = values[1:]
        out += [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                for v in values]
    return df.select(*out)


def assemble_features(df: DataFrame, cols: Sequence[str] = tuple(K.FEATURE_COLS),
                      out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    """Inputs -> one vector; rows with a null or NaN input are dropped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


@dataclass
class ScaleModel:
    """Population z-score: (x - mean) / std, std with divisor n.

    ``stats`` is a one-row DataFrame (lazy); ``transform`` broadcasts it.
    """
    cols: list[str]
    stats: DataFrame

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        j = df.crossJoin(F.broadcast(self.stats))
        scaled = {c: F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__s_{c}"))
                  for c in self.cols}
        keep = [F.col(c) for c in df.columns if suffix or c not in self.cols]
        return j.select(*keep, *[scaled[c].alias(c + suffix) for c in self.cols])


def standard_scale(train: DataFrame, cols: Sequence[str]) -> ScaleModel:
    cols = list(cols)
    stats = train.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols],
                      *[F.stddev_pop(c).alias(f"__s_{c}") for c in cols])
    return ScaleModel(cols, stats)


def class_weights(df: DataFrame, label: str = "delay_label", n_classes: int = 2) -> DataFrame:
    """Per label: n_rows / (n_classes * n_label) (the 'balanced' weights). One
    pass: the total is the sum of the per-label counts (a row per label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))
    total = F.sum("n_label").over(Window.partitionBy())
    return counts.select(label, "n_label", (total / (F.lit(n_classes) * F.col("n_label"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "delay_label",
                       weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's label. The weights are a row per
    class; they are fetched (at most MAX_CATEGORIES, else an error) and written
    into the plan as literals, so attaching them needs no join."""
    w = class_weights(df, label).limit(MAX_CATEGORIES + 1).collect()
    if len(w) > MAX_CATEGORIES:
        raise ValueError(f"{label} has more than {MAX_CATEGORIES} classes")
    weight = F.lit(None).cast("double")
    for r in w:
        weight = F.when(F.col(label).eqNullSafe(F.lit(r[label])), F.lit(r["weight"])).otherwise(weight)
    return df.withColumn(weight_col, weight)
