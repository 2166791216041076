"""Boosted regression trees over blocks of binned rows.

The training rows are binned once (at most 32 bins a numeric column, one for each category) and
packed into blocks: one byte a column and the row's residual, a twelfth of what MLlib keeps for a
row with a slot for each category. A level of a tree is one pass over the blocks: each task sums
rows and residuals by (node, column, bin) and sends sums of fixed size; the best split of each
node follows from them. A category's split (it against the rest) reads its own bin, so all the
one-hot splits of a column cost one sum.

The scheme is that of MLlib's ``GBTRegressor`` with squared loss: the first tree fits the label, the
others twice the residual times the step; every tree sees its own sample of the rows.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.operators.features import MAX_CATEGORIES
from delaylake.operators.svm import complete
from delaylake.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks need no copy of this package

MAX_BINS = 32
CUT_ROWS = 100_000      # rows whose values the cuts are taken from
BLOCK_ROWS = 1 << 16
TASK_ROWS = 1 << 20
RESTATE = 5             # trees after which the residuals are kept anew
CUT = 50                # trees after which they are also written, to cut their lineage


@dataclass
class Grid:
    """The bins: ``cuts`` of each numeric column (a bin ends with its cut) and the ``values`` of each
    category column, in that order; the last bin of a category column is for unknown or null ones,
    and is a category of its own unless ``drop_last``."""

    numeric: list[str]
    cats: list[str]
    cuts: list[list[float]]
    values: list[list[str]]
    drop_last: bool = False

    @cached_property
    def sizes(self) -> list[int]:
        return [len(x) + 1 for x in (*self.cuts, *self.values)]

    @cached_property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    @property
    def width(self) -> int:
        return int(self.starts[-1])

    @property
    def dtype(self) -> type:
        return np.uint8 if max(self.sizes) <= 256 else np.uint16

    def inputs(self) -> list[F.Column]:
        """Numeric columns as doubles, category columns as the place of their value."""
        place = lambda c, vs: (F.array_position(F.lit(vs), F.col(c).cast("string")) if vs
                               else F.lit(0))
        return ([F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.numeric)]
                + [F.when(F.coalesce(place(c, vs), F.lit(0)) > 0, place(c, vs) - 1).otherwise(len(vs))
                   .cast("int").alias(f"k{i}") for i, (c, vs) in enumerate(zip(self.cats, self.values))])

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """A line of bins for each column."""
        out = np.empty((len(self.sizes), len(columns[0])), self.dtype)
        for i, x in enumerate(columns):
            out[i] = np.searchsorted(self.cuts[i], x, "left") if i < len(self.cuts) else x
        return out


def fit_grid(train: DataFrame, numeric: Sequence[str], cats: Sequence[str], drop_last: bool = False,
             max_bins: int = MAX_BINS, seed: int = 0) -> tuple[Grid, int]:
    """The grid and the number of rows: one pass for the categories, one for the cuts. Cuts lie, as
    MLlib's do, half way between the values of a sample of rows (``CUT_ROWS``, ten times MLlib's):
    all of them where a column has few, else about evenly many rows apart."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), c.cast("string").alias("v"))
                                for i, c in enumerate([*map(F.col, cats), F.lit("a row")])]))
    found = (train.select(pairs.alias("p")).groupBy("p.c", "p.v").agg(F.count(F.lit(1)).alias("n"))
             .limit((MAX_CATEGORIES + 1) * (len(cats) + 1)).collect())
    values = [sorted(r["v"] for r in found if r["c"] == i and r["v"] is not None) for i in range(len(cats))]
    for c, vs in zip(cats, values):
        if len(vs) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories")
    n = sum(r["n"] for r in found if r["c"] == len(cats))
    some = train.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    some = (some.sample(CUT_ROWS / n, seed) if n > CUT_ROWS else some).toPandas()
    return Grid(list(numeric), list(cats), [_cuts(some[c].to_numpy(), max_bins) for c in numeric], values,
                drop_last), n


def _cuts(x: np.ndarray, max_bins: int) -> list[float]:
    x = np.sort(x)
    last = np.flatnonzero(x[1:] > x[:-1])       # last row of each value but the largest
    if len(last) >= max_bins:
        last = last[np.unique(np.searchsorted(last, np.arange(1, max_bins) * len(x) / max_bins)
                              .clip(max=len(last) - 1))]
    return ((x[last] + x[last + 1]) / 2).tolist()


def _packed(batches: Iterator[pa.RecordBatch], grid: Grid, size: int) -> Iterator[pa.RecordBatch]:
    """Rows (inputs, then y) as blocks of at most ``size``: number, bins, residual (so far y)."""
    task, number, held, n = TaskContext.get().partitionId(), 0, [], 0

    def block(rows: pa.Table) -> pa.RecordBatch:
        *x, y = [c.to_numpy() for c in rows.columns]
        return pa.RecordBatch.from_pydict({
            "block": pa.array([task << 32 | number], pa.int64()),
            "bins": pa.array([grid.binned(x).tobytes()], pa.binary()),
            "r": pa.array([y.astype(np.float32).tobytes()], pa.binary())})

    for b in batches:
        while len(b):
            held.append(b.slice(0, size - n))
            b, n = b.slice(len(held[-1])), n + len(held[-1])
            if n == size:
                yield block(pa.Table.from_batches(held))
                number, held, n = number + 1, [], 0
    if held:
        yield block(pa.Table.from_batches(held))


BLOCK = "block long, bins binary, r binary"


def _each(batches: Iterator[pa.RecordBatch], grid: Grid) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for b in batches:
        for i in range(b.num_rows):
            r = np.frombuffer(b["r"][i].as_buffer(), np.float32)
            yield b["block"][i].as_py(), np.frombuffer(b["bins"][i].as_buffer(), grid.dtype).reshape(-1, len(r)), r


@dataclass
class Tree:
    """A tree as a heap: a row goes right where ``lo <= bin <= hi`` of the node's column, so a node with
    ``lo > hi`` sends all rows left. ``value`` has the leaves' minutes, times the tree's weight."""

    depth: int
    col: list[int]
    lo: list[int]
    hi: list[int]
    value: list[float]

    @classmethod
    def bare(cls, depth: int) -> Tree:
        n = 2 ** depth - 1
        return cls(depth, [0] * n, [1] * n, [0] * n, [0.0] * (n + 1))

    def places(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Each row's place among the nodes of a level."""
        n = bins.shape[1]
        at, every = np.zeros(n, np.intp), np.arange(n)
        for level in range(levels):
            right = np.zeros((2 ** level, n), bool)
            for j, k in enumerate(range(2 ** level - 1, 2 ** (level + 1) - 1)):
                if self.lo[k] <= self.hi[k]:
                    x = bins[self.col[k]]
                    right[j] = (x >= self.lo[k]) & (x <= self.hi[k])
            at = 2 * at + (right.ravel().take(at * n + every) if level else right[0])
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.asarray(self.value).take(self.places(bins, self.depth))


def _less(r: np.ndarray, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """The residuals after ``trees``."""
    return (r - sum(t.values(bins) for t in trees)).astype(np.float32) if trees else r


def _restated(batches: Iterator[pa.RecordBatch], grid: Grid, trees: Sequence[Tree]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rs = [_less(r, bins, trees).tobytes() for _, bins, r in _each([b], grid)]
        yield pa.RecordBatch.from_arrays([b["block"], b["bins"], pa.array(rs, pa.binary())], ["block", "bins", "r"])


def _summed(batches: Iterator[pa.RecordBatch], grid: Grid, trees: Sequence[Tree], tree: Tree, level: int,
            asked: np.ndarray, subsample: float, seed: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """Rows and residuals of a task by (node, column, bin), of the tree's sample: for the root, or for
    that child of each node above which ``asked`` names."""
    width = grid.width
    total = np.zeros((2, len(asked) * width))
    for block, bins, r in _each(batches, grid):
        at = tree.places(bins, level)
        node = at >> 1
        keep = at - 2 * node == asked[node]
        if subsample < 1:
            keep &= np.random.default_rng([*seed, block]).random(len(r), np.float32) < subsample
        rows = np.flatnonzero(keep)
        bins, at = bins.take(rows, 1), node[rows] * width
        r = _less(r[rows], bins, trees).astype(np.float64)
        for c, start in enumerate(grid.starts[:-1]):
            k = at + bins[c]
            k += start
            total[0] += np.bincount(k, minlength=total.shape[1])
            total[1] += np.bincount(k, r, total.shape[1])
    yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})


def _candidates(grid: Grid, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column, lo, hi) of each possible split, and ``sums`` (.., width) of the rows it sends right."""
    splits, right = [], []
    for c, (start, size) in enumerate(zip(grid.starts, grid.sizes)):
        s = sums[..., start:start + size]
        if c < len(grid.numeric):
            splits += [(c, k, size - 1) for k in range(1, size)]
            right.append(s[..., ::-1].cumsum(-1)[..., ::-1][..., 1:])
        else:
            last = size - grid.drop_last
            splits += [(c, k, k) for k in range(last)]
            right.append(s[..., :last])
    return np.array(splits).reshape(-1, 3), np.concatenate(right, -1)


def _grow(tree: Tree, level: int, grid: Grid, sums: np.ndarray, weight: float, min_rows: int) -> np.ndarray:
    """The best split of each node of the level, by the fall of the squared error; ``sums`` are
    rows and residuals by (node, bin). Both sides' values, for where the tree ends. Returns the child
    of each node that has fewer rows: those are summed next, the other's sums are what is left."""
    splits, right = _candidates(grid, sums)
    whole = sums[..., :grid.sizes[0]].sum(-1, keepdims=True)
    left = whole - right
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = right[1] ** 2 / right[0] + left[1] ** 2 / left[0] - whole[1] ** 2 / whole[0]
    gain = np.where((right[0] >= min_rows) & (left[0] >= min_rows), gain, -np.inf)
    mean = lambda s: float(weight * s[1] / s[0]) if s[0] > 0 else 0.0
    span = 2 ** (tree.depth - level)        # leaves below a node
    fewer = np.ones(sums.shape[1], np.intp)
    for j in range(sums.shape[1]):
        best = int(gain[j].argmax()) if gain.shape[1] else 0
        k = 2 ** level - 1 + j
        if level == 0:
            tree.value[0] = mean(whole[:, 0, 0])
        if gain.shape[1] and gain[j, best] > 1e-9:
            tree.col[k], tree.lo[k], tree.hi[k] = (int(v) for v in splits[best])
            tree.value[j * span] = mean(left[:, j, best])
            tree.value[j * span + span // 2] = mean(right[:, j, best])
            fewer[j] = right[0, j, best] <= left[0, j, best]
    return fewer


@dataclass
class BoostedTrees:
    """The fitted trees; scoring is one column. Rows with a missing numeric input are left out."""

    grid: Grid
    trees: list[Tree]

    def transform(self, df: DataFrame) -> DataFrame:
        grid, trees = self.grid, self.trees

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            bins = grid.binned([c.to_numpy() for c in columns])
            out = np.zeros(bins.shape[1])
            for t in trees:
                out += t.values(bins)
            return pd.Series(out)

        return complete(df, grid.numeric).withColumn("prediction", score(*grid.inputs()))

    def save(self, path: str) -> None:
        text = json.dumps({"grid": asdict(self.grid), "trees": [asdict(t) for t in self.trees]})
        (SparkSession.active().createDataFrame([(text,)], "model string").coalesce(1)
         .write.mode("overwrite").text(f"{path.rstrip('/')}/{FOLDER}"))

    @classmethod
    def load(cls, path: str) -> BoostedTrees:
        d = json.loads(SparkSession.active().read.text(f"{path.rstrip('/')}/{FOLDER}").first()[0])
        return cls(Grid(**d["grid"]), [Tree(**t) for t in d["trees"]])


FOLDER = "boosted-trees"


def boosted_trees(train: DataFrame, label: str, numeric: Sequence[str], cats: Sequence[str], max_iter: int,
                  max_depth: int, step: float, subsample: float, seed: int, min_rows: int = 1) -> BoostedTrees:
    rows = complete(train, numeric).where(F.col(label).isNotNull())
    grid, n = fit_grid(rows, numeric, cats, seed=seed)
    if n == 0:
        raise ValueError("no rows to learn from")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = min(BLOCK_ROWS, -(-n // (2 * cores)))
    rounds = -(-n // (TASK_ROWS * cores))       # whole rounds of the cores, of about even tasks

    def held(blocks: DataFrame, deal: bool = False) -> DataFrame:
        d = blocks.repartition(rounds * cores) if deal else blocks
        return d.persist(StorageLevel.MEMORY_AND_DISK)

    state = held(rows.select(*grid.inputs(), F.col(label).cast("double").alias("y"))
                 .mapInArrow(partial(_packed, grid=grid, size=size), BLOCK), deal=True)
    trees: list[Tree] = []
    recent: list[Tree] = []
    older = []
    for m in range(max_iter):
        if len(recent) == RESTATE:
            older.append(state)
            state = state.mapInArrow(partial(_restated, grid=grid, trees=recent), BLOCK)
            cut = m % CUT == 0
            state, recent = held(materialize(state, "residuals") if cut else state, deal=cut), []
        weight = 1.0 if m == 0 else 2 * step
        tree = Tree.bare(max_depth)
        asked, above = np.zeros(1, np.intp), None
        for level in range(max_depth):
            got = state.mapInArrow(partial(_summed, grid=grid, trees=recent, tree=tree, level=level, asked=asked,
                                           subsample=subsample, seed=(seed, m)), "sums binary").collect()
            sums = sum(np.frombuffer(g[0]) for g in got).reshape(2, len(asked), grid.width)
            if level:
                sums = np.where(asked[None, :, None, None] == np.arange(2)[None, None, :, None],
                                sums[:, :, None], (above - sums)[:, :, None]).reshape(2, -1, grid.width)
            asked, above = _grow(tree, level, grid, sums, weight, min_rows), sums
            while older:
                older.pop().unpersist()
        trees.append(tree)
        recent.append(tree)
    state.unpersist()
    return BoostedTrees(grid, trees)
