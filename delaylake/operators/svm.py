"""Linear SVM with the squared hinge loss, and its sigmoid calibration, by Newton steps.

``theta`` minimises  theta.theta / 2 + C * sum_i c_i * max(0, 1 - y_i * theta.z_i)^2  over the
standardised inputs z (numeric columns and a 0/1 column per category, plus a constant that is
regularised like the rest). The loss is piecewise quadratic: a Newton step needs the gradient
and the curvature over the rows inside the margin, and a handful of steps reach the minimum.

Each step is one DataFrame aggregate for all folds together. A row's 0/1 inputs depend on its
categories alone, so rows are summed per cell (fold, categories): the weights, weight times
each numeric input and each product of two, and the same for the residual. The cells are then
summed to every category and every pair of categories by grouping sets, which are the blocks
of the curvature matrix: what reaches the driver has the size of that matrix (inputs squared),
whatever the number of rows or cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.operators.features import categories

MAX_INPUTS = 2_000       # numeric columns and categories; the curvature matrix has their square


@dataclass
class Inputs:
    """The encoded inputs: numeric columns, then the sorted values of each category column;
    means and population deviations over the training rows (a constant input has 1)."""

    numeric: list[str]
    cats: dict[str, list[str]]
    mean: np.ndarray
    scale: np.ndarray

    def __post_init__(self):
        m, at = len(self.numeric), 0
        self.first = {}
        for c, values in self.cats.items():
            self.first[c] = m + at
            at += len(values)
        self.size = m + at

    def index(self, c: str) -> F.Column:
        """Position of a row's category among the known ones; -1 if unknown or null."""
        return F.coalesce(F.array_position(F.lit(self.cats[c]), F.col(c).cast("string")), F.lit(0)).cast("int") - 1

    def scaling(self) -> np.ndarray:
        """Rows of z (last: the constant) in terms of the constant (first), the standardised
        numeric inputs and the 0/1 inputs."""
        m = len(self.numeric)
        a = np.zeros((self.size + 1, self.size + 1))
        a[range(m), range(1, m + 1)] = 1
        for j in range(m, self.size):
            a[j, j + 1], a[j, 0] = 1 / self.scale[j], -self.mean[j] / self.scale[j]
        a[self.size, 0] = 1
        return a


def fit_inputs(train: DataFrame, numeric: Sequence[str], cats: Sequence[str]) -> Inputs:
    known = {c: categories(train.select(F.col(c).cast("string").alias(c)), c) for c in cats}
    if len(numeric) + sum(map(len, known.values())) > MAX_INPUTS:
        raise ValueError(f"more than {MAX_INPUTS} inputs")
    x = [F.col(c).cast("double") for c in numeric]
    x += [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
          for c, vs in known.items() for v in vs]
    aggs = []
    for i, e in enumerate(x):
        aggs += [F.avg(e).alias(f"m{i}"), F.stddev_pop(e).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(len(x))])
    scale = np.array([row[f"s{i}"] or 1.0 for i in range(len(x))])
    return Inputs(list(numeric), known, mean, scale)


def complete(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Rows without a missing numeric input (the others can be neither learnt nor scored)."""
    ok = F.lit(True)
    for c in numeric:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(ok)


def encoded(train: DataFrame, inputs: Inputs, label: str, keep: Sequence[str]) -> DataFrame:
    """``y`` (-1 or 1), standardised numeric inputs x0.., category positions k0.., and ``keep``."""
    xs = [((F.col(c).cast("double") - float(inputs.mean[i])) / float(inputs.scale[i])).alias(f"x{i}")
          for i, c in enumerate(inputs.numeric)]
    ks = [inputs.index(c).alias(f"k{i}") for i, c in enumerate(inputs.cats)]
    return train.select((2 * F.col(label).cast("int") - 1).alias("y"), *xs, *ks, *keep)


def member_margin(inputs: Inputs, beta: np.ndarray, member: F.Column) -> F.Column:
    """theta.z for rows of ``encoded``; ``beta`` has a row of coefficients for each member."""
    pick = lambda values: F.lit([float(v) for v in values])[member]
    out = pick(beta[:, 0])
    for i in range(len(inputs.numeric)):
        out = out + pick(beta[:, 1 + i]) * F.col(f"x{i}")
    for i, (c, values) in enumerate(inputs.cats.items()):
        a, n = inputs.first[c] + 1, len(values)
        flat = F.lit([float(v) for v in beta[:, a:a + n].ravel()] or [0.0])
        out = out + F.when(F.col(f"k{i}") < 0, 0.0).otherwise(
            F.coalesce(F.get(flat, member * n + F.greatest(F.col(f"k{i}"), F.lit(0))), F.lit(0.0)))
    return out


def _pairs(m: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(m) for j in range(i, m)]


def hinge_sums(rows: DataFrame, inputs: Inputs, beta: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per member: sums over the rows inside the margin of c x x', c (y - f) x and c (1 - y f)^2,
    x being the constant, the numeric and the 0/1 inputs. ``rows``: encoded, with ``member`` and
    the weight ``c``."""
    m, names = len(inputs.numeric), list(inputs.cats)
    ks = [f"k{i}" for i in range(len(names))]
    f = rows.withColumn("f", member_margin(inputs, beta, F.col("member"))).where(F.col("y") * F.col("f") < 1)
    f = f.withColumn("r", F.col("c") * (F.col("y") - F.col("f")))
    c, r, x = F.col("c"), F.col("r"), [F.col(f"x{i}") for i in range(m)]
    sums = {"w": c, **{f"w{i}": c * x[i] for i in range(m)}, "g": r, **{f"g{i}": r * x[i] for i in range(m)}}
    whole = {**{f"w{i}_{j}": c * x[i] * x[j] for i, j in _pairs(m)},
             "loss": c * (1 - F.col("y") * F.col("f")) * (1 - F.col("y") * F.col("f"))}
    cells = f.groupBy("member", *ks).agg(*[F.sum(e).alias(n) for n, e in {**sums, **whole}.items()])
    sets = [["member"], *[["member", k] for k in ks],
            *[["member", ks[a], ks[b]] for a in range(len(ks)) for b in range(a + 1, len(ks))]]
    found = cells.groupingSets([[F.col(c) for c in s] for s in sets], "member", *ks).agg(
        *[F.sum(n).alias(n) for n in [*sums, *whole]], F.grouping_id().alias("level")).collect()

    out = [(np.zeros((inputs.size + 1,) * 2), np.zeros(inputs.size + 1), [0.0]) for _ in beta]
    for row in found:
        h, g, loss = out[row["member"]]
        present = [i for i in range(len(ks)) if not row["level"] >> (len(ks) - 1 - i) & 1]
        at = [inputs.first[names[i]] + 1 + row[ks[i]] if row[ks[i]] >= 0 else None for i in present]
        if None in at:
            continue                       # an unknown category has no 0/1 input
        if not at:
            h[0, 0], g[0], loss[0] = row["w"], row["g"], row["loss"]
            for i in range(m):
                h[0, 1 + i] = h[1 + i, 0] = row[f"w{i}"]
                g[1 + i] = row[f"g{i}"]
            for i, j in _pairs(m):
                h[1 + i, 1 + j] = h[1 + j, 1 + i] = row[f"w{i}_{j}"]
        elif len(at) == 1:
            a = at[0]
            h[a, a] = h[0, a] = h[a, 0] = row["w"]
            g[a] = row["g"]
            for i in range(m):
                h[a, 1 + i] = h[1 + i, a] = row[f"w{i}"]
        else:
            h[at[0], at[1]] = h[at[1], at[0]] = row["w"]
    return [(h, g, loss[0]) for h, g, loss in out]


@dataclass
class _Descent:
    """Newton steps from ``at``; a step that does not lower the value is halved."""

    at: np.ndarray
    tol: float
    before: np.ndarray | None = None
    value: float = np.inf
    first: float | None = None
    done: bool = False
    lasts: list = field(default_factory=list)

    def take(self, value: float, gradient: np.ndarray, curvature: np.ndarray) -> None:
        size = float(np.linalg.norm(gradient))
        self.first = self.first if self.first is not None else max(size, 1e-12)
        if self.before is not None and value > self.value + 1e-12 * abs(self.value):
            if np.abs(self.at - self.before).max() < 1e-10:
                self.at, self.done = self.before, True
            else:
                self.at = (self.at + self.before) / 2
            return
        self.value = value
        if size <= self.tol * self.first or size < 1e-12:
            self.done = True
            return
        self.before = self.at
        self.at = self.at - np.linalg.solve(curvature, gradient)


def squared_hinge(rows: DataFrame, inputs: Inputs, members: int, cost: float, max_iter: int = 50,
                  tol: float = 1e-6) -> np.ndarray:
    """The minimisers of ``members`` problems (a row of ``theta`` each, the constant's last).
    ``rows``: ``encoded`` with ``member`` and the row weight ``c``."""
    a = inputs.scaling()
    runs = [_Descent(np.zeros(inputs.size + 1), tol) for _ in range(members)]
    for _ in range(max_iter):
        beta = np.array([run.at @ a for run in runs])
        for run, (h, g, loss) in zip(runs, hinge_sums(rows, inputs, beta)):
            if not run.done:
                run.take(run.at @ run.at / 2 + cost * loss, run.at - 2 * cost * (a @ g),
                         np.eye(len(a)) + 2 * cost * (a @ h @ a.T))
        if all(run.done for run in runs):
            break
    return np.array([run.at if run.done or run.before is None else run.before for run in runs])


def sigmoid(rows: DataFrame, members: int, max_iter: int = 50, tol: float = 1e-7) -> np.ndarray:
    """Per member (slope, offset) of the sigmoid that maps its margins ``f`` to probabilities.
    ``rows`` has member, y, f and the weight n. The targets are drawn in from 0 and 1 by the
    counts of the labels (Platt), so that separable margins have a finite slope."""
    n = {(r["member"], r["y"]): r["n"] for r in rows.groupBy("member", "y").agg(F.sum("n").alias("n")).collect()}
    high = [float((n.get((k, 1), 0) + 1) / (n.get((k, 1), 0) + 2)) for k in range(members)]
    low = [float(1 / (n.get((k, -1), 0) + 2)) for k in range(members)]
    member, f = F.col("member"), F.col("f")
    target = F.when(F.col("y") > 0, F.lit(high)[member]).otherwise(F.lit(low)[member])
    with_target = rows.withColumn("t", target)
    runs = [_Descent(np.array([0.0, float(np.log((n.get((k, 1), 0) + 1) / (n.get((k, -1), 0) + 1)))]), tol)
            for k in range(members)]
    for _ in range(max_iter):
        s, o = (F.lit([float(run.at[i]) for run in runs])[member] for i in (0, 1))
        u = s * f + o
        p = F.when(u >= 0, 1 / (1 + F.exp(-u))).otherwise(F.exp(u) / (1 + F.exp(u)))
        # log(1 + exp(u)) - t * u, without overflow
        loss = F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u))) - F.col("t") * u
        q = with_target.select("member", "n", "f", loss.alias("loss"), (p - F.col("t")).alias("d"),
                               (p * (1 - p)).alias("h"))
        sums = q.groupBy("member").agg(
            F.sum(F.expr("n * loss")).alias("loss"), F.sum(F.expr("n * d * f")).alias("gs"),
            F.sum(F.expr("n * d")).alias("go"), F.sum(F.expr("n * h * f * f")).alias("ss"),
            F.sum(F.expr("n * h * f")).alias("so"), F.sum(F.expr("n * h")).alias("oo"))
        seen = set()
        for r in sums.collect():
            seen.add(r["member"])
            run = runs[r["member"]]
            if not run.done:
                run.take(r["loss"], np.array([r["gs"], r["go"]]),
                         np.array([[r["ss"], r["so"]], [r["so"], r["oo"]]]) + 1e-10 * np.eye(2))
        if all(run.done for k, run in enumerate(runs) if k in seen):
            break
    return np.array([run.at if run.done or run.before is None else run.before for run in runs])


@dataclass
class LinearMember:
    """One fitted member on raw inputs: margin = intercept + numeric.x + the category's weight;
    probability = sigmoid(slope * margin + offset)."""

    intercept: float
    numeric: dict[str, float]
    cats: dict[str, dict[str, float]]
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def of(cls, inputs: Inputs, theta: np.ndarray, slope: float, offset: float) -> LinearMember:
        beta = theta @ inputs.scaling()
        m = len(inputs.numeric)
        num = {c: float(beta[1 + i] / inputs.scale[i]) for i, c in enumerate(inputs.numeric)}
        start = float(beta[0]) - sum(num[c] * float(inputs.mean[i]) for i, c in enumerate(inputs.numeric))
        cats = {c: {v: float(beta[inputs.first[c] + 1 + i]) for i, v in enumerate(vs)}
                for c, vs in inputs.cats.items()}
        assert m + sum(map(len, cats.values())) == inputs.size
        return cls(start, num, cats, float(slope), float(offset))

    def margin(self) -> F.Column:
        out = F.lit(self.intercept)
        for c, b in self.numeric.items():
            out = out + b * F.col(c).cast("double")
        for c, weights in self.cats.items():
            if weights:
                m = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
                out = out + F.coalesce(F.try_element_at(m, F.col(c).cast("string")), F.lit(0.0))
        return out

    def probability(self) -> F.Column:
        return 1 / (1 + F.exp(-(self.slope * self.margin() + self.offset)))

    def rows(self, member: int) -> list[tuple]:
        out = [(member, "intercept", "", "", self.intercept), (member, "slope", "", "", self.slope),
               (member, "offset", "", "", self.offset)]
        out += [(member, "numeric", c, "", b) for c, b in self.numeric.items()]
        return out + [(member, "category", c, v, b) for c, ws in self.cats.items() for v, b in ws.items()]

    ROWS = "member int, kind string, input string, value string, weight double"

    @classmethod
    def from_rows(cls, rows: list) -> LinearMember:
        one = {r["kind"]: r["weight"] for r in rows}
        cats: dict[str, dict[str, float]] = {}
        for r in rows:
            if r["kind"] == "category":
                cats.setdefault(r["input"], {})[r["value"]] = r["weight"]
        return cls(one["intercept"], {r["input"]: r["weight"] for r in rows if r["kind"] == "numeric"},
                   cats, one["slope"], one["offset"])
