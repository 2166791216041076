"""Pipeline stages for fill, clip and label, so that serving uses the statistics of training.

``TrainingFill`` is an Estimator: it learns the fill values (means, medians) from the training
rows. Its model carries them as parameters, is saved and loaded with the pipeline, and fills a
request's missing readings with the training values instead of those of the request batch.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.functions import columns as C
from delaylake.operators.clean import as_double, mean_expr
from delaylake.operators.quantiles import exact_quantiles


def _text(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toString)


class _FillParams(Params):
    """Parameters as JSON text: a Param's value must have a type that both languages know."""

    clips = _text("clips", "column -> [low, high], JSON; null for an open end")
    label = _text("label", "[source column, label column, threshold], JSON; '' for none")

    def _tail(self, df: DataFrame) -> DataFrame:
        """Clips and label, for the columns that are there (a request has no outcome)."""
        for c, (low, high) in json.loads(self.getOrDefault(self.clips)).items():
            if c in df.columns:
                df = df.withColumn(c, C.clip(c, low, high))
        spec = self.getOrDefault(self.label)
        if spec:
            source, out, threshold = json.loads(spec)
            if source in df.columns:
                df = df.withColumn(out, C.delay_label(source, threshold))
        return df


class TrainingFill(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a fill value for each column of ``means`` and ``medians``; ``constants`` are given."""

    means = Param(Params._dummy(), "means", "columns filled with their training mean", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "columns filled with their training median",
                    TypeConverters.toListString)
    constants = _text("constants", "column -> fill value, JSON")

    def __init__(self, means: Sequence[str] = (), medians: Sequence[str] = (),
                 constants: Mapping[str, float] | None = None, clips: Mapping[str, Sequence] | None = None,
                 label: Sequence | None = None):
        super().__init__()
        self._set(means=list(means), medians=list(medians), constants=json.dumps(dict(constants or {})),
                  clips=json.dumps({c: list(b) for c, b in (clips or {}).items()}),
                  label=json.dumps(list(label)) if label else "")

    def _fit(self, df: DataFrame) -> TrainingFillModel:
        fills = json.loads(self.getOrDefault(self.constants))
        means, medians = self.getOrDefault(self.means), self.getOrDefault(self.medians)
        if means:
            row = df.agg(*[mean_expr(c).alias(c) for c in means]).first()
            fills |= {c: row[c] for c in means if row[c] is not None}
        if medians:
            row = exact_quantiles(as_double(df, medians), medians, [0.5]).first()
            fills |= {c: row[c][0] for c in medians if row is not None and row[c] is not None}
        model = TrainingFillModel(fills)
        model._set(clips=self.getOrDefault(self.clips), label=self.getOrDefault(self.label))
        return model


class TrainingFillModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fills with the learnt values, then clips and labels. A column without any training value
    keeps its nulls; a column that is missing altogether is added with its fill value."""

    fills = _text("fills", "column -> fill value, JSON")

    def __init__(self, fills: Mapping[str, float] | None = None):
        super().__init__()
        self._set(fills=json.dumps(dict(fills or {})), clips="{}", label="")

    def values(self) -> dict[str, float]:
        return json.loads(self.getOrDefault(self.fills))

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.values()
        d = as_double(df, [c for c in fills if c in df.columns])
        out = [F.coalesce(F.col(f"`{c}`"), F.lit(float(fills[c]))).alias(c) if c in fills else F.col(f"`{c}`")
               for c in d.columns]
        out += [F.lit(float(v)).alias(c) for c, v in fills.items() if c not in d.columns]
        return self._tail(d.select(*out))
