"""Random forest of two classes over blocks of binned rows (``operators.trees``).

MLlib grows all nodes of a forest by sums that every task sends for every node: millions of small
sums, many more bytes than the rows have. Here only nodes of more than ``UNIT_ROWS`` rows are split
that way (sums by tree, node, column and bin, added by Spark). The rows of a smaller node are
brought together once, by an exchange keyed on tree and node, and its subtree is grown where they
arrive, a level at a time. No task gets more than a node's rows, whatever the table's size, and trees are
taken in batches that bound what is exchanged at once.

The forest is MLlib's: a Poisson(1) count of each row in each tree, a random subset of the features
(a category is a feature) for each node, the Gini impurity of the weighted counts, the least
number of rows on each side, and a vote of each tree by its leaf's weighted share.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.operators.svm import complete
from delaylake.operators.trees import BLOCK, BLOCK_ROWS, Grid, _each, _packed, fit_grid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT_ROWS = 3_000_000       # rows of a node whose subtree is grown in one task: some 20 bytes each
BATCH_ROWS = 600_000_000    # rows of all trees of a batch: what is exchanged at once
NODES = 512                 # nodes whose sums are held at once


@dataclass
class Rule:
    """What a node's split is chosen by."""

    grid: Grid
    subset: int         # features tried at a node
    min_rows: int
    max_depth: int
    seed: int

    @property
    def features(self) -> int:
        return len(self.grid.numeric) + sum(len(v) + (not self.grid.drop_last) for v in self.grid.values)

    def tried(self, rng: np.random.Generator, nodes: int) -> np.ndarray:
        """The features of each node's subset (nodes, features)."""
        out = np.zeros((nodes, self.features), bool)
        if self.subset >= self.features:
            return ~out
        some = rng.random(out.shape, np.float32).argpartition(self.subset - 1, 1)[:, :self.subset]
        np.put_along_axis(out, some, True, 1)
        return out

    def best(self, sums: Callable[[int], tuple[np.ndarray, np.ndarray]], tried: np.ndarray):
        """Each node's best split: (gain, column, lo, hi) and the rows and weights by class (nodes, 2)
        of the whole and of its right side. ``sums`` gives a column's rows and weights
        (nodes, bins, classes)."""
        grid, m, feature = self.grid, len(tried), 0
        gain, split = np.full(m, -np.inf), np.zeros((3, m), np.int64)
        whole, right = (np.zeros((2, m, 2)) for _ in range(2))
        every = np.arange(m)
        for c, size in enumerate(grid.sizes):
            n, w = sums(c)
            if c == 0:
                whole = np.stack([n.sum(1), w.sum(1)])
            if c < len(grid.numeric):
                rn, rw = (x[:, ::-1].cumsum(1)[:, ::-1][:, 1:] for x in (n, w))
                ok, feature = tried[:, feature:feature + 1], feature + 1
                lo, hi = np.arange(1, size), np.full(size - 1, size - 1)
            else:
                last = size - grid.drop_last
                rn, rw = n[:, :last], w[:, :last]
                ok, feature = tried[:, feature:feature + last], feature + last
                lo = hi = np.arange(last)
            if not len(lo):
                continue
            count = rn[..., 0] + rn[..., 1]
            (a, b), (d, e) = ((rw[..., k] for k in (0, 1)), (whole[1][:, k:k + 1] - rw[..., k] for k in (0, 1)))
            with np.errstate(divide="ignore", invalid="ignore"):
                g = (a * a + b * b) / (a + b) + (d * d + e * e) / (d + e)
            fits = ok & (count >= self.min_rows) & (count <= whole[0].sum(1)[:, None] - self.min_rows)
            g = np.where(fits, g, -np.inf)
            j = g.argmax(1)
            better = g[every, j] > gain
            gain = np.where(better, g[every, j], gain)
            split = np.where(better, np.stack([np.full(m, c), lo[j], hi[j]]), split)
            right = np.where(better[None, :, None], np.stack([rn[every, j], rw[every, j]]), right)
        total = whole[1].sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gain / total - (whole[1] ** 2).sum(1) / total ** 2
        return np.where(gain > 1e-12, gain, -np.inf), split, whole, right

    def open(self, n: np.ndarray, depth: int) -> np.ndarray:
        """Whether nodes with these rows by class can be split further."""
        return (n.min(-1) > 0) & (n.sum(-1) >= 2 * self.min_rows) & (depth < self.max_depth)


NODE = np.dtype([("col", np.int16), ("lo", np.uint16), ("hi", np.uint16), ("left", np.int32), ("value", np.float32)])


def _leaves(at: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Nodes that send all rows to themselves."""
    out = np.zeros(len(at), NODE)
    out["lo"], out["left"], out["value"] = 1, at, share
    return out


def grown(rule: Rule, bins: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray, depth: int,
          rng: np.random.Generator) -> np.ndarray:
    """The subtree of a node's rows (class, count and weight of each), its root first; a node's
    children are neighbours. All nodes of a level are split together; rows are kept in their order."""
    per = [w[y == k] for k in (0, 1)]
    even = all(len(p) == 0 or p.min() == p.max() for p in per)      # the weight is the class's
    unit = np.array([p[0] if len(p) else 1.0 for p in per])
    whole = np.bincount(y, n, 2)
    share = np.bincount(y, n * w, 2)
    nodes = [_leaves(np.zeros(1, int), share[1:] / max(share.sum(), 1e-300))]
    first, made = 0, 1                  # number of the level's first node, and nodes so far
    at, m = np.zeros(len(y), np.intp), int(rule.open(whole[None], depth)[0])
    ids = np.zeros(1, int)              # the open nodes' numbers
    while m and len(at):
        ends = np.searchsorted(at, np.arange(0, m + NODES, NODES).clip(max=m))
        kept, splits, shares, numbers, open_ = [], [], [], [], []
        for a, (s, e) in zip(range(0, m, NODES), zip(ends, ends[1:])):
            k, here = min(NODES, m - a), at[s:e] - a
            yy, nn = y[s:e], n[s:e]

            def sums(c, here=here, s=s, e=e, k=k, yy=yy, nn=nn):
                size = rule.grid.sizes[c]
                i = here * size
                i += bins[c, s:e]
                i *= 2
                i += yy
                rows = np.bincount(i, nn, 2 * k * size).reshape(k, size, 2)
                return rows, rows * unit if even else np.bincount(i, nn * w[s:e], 2 * k * size).reshape(k, size, 2)

            gain, split, whole, right = rule.best(sums, rule.tried(rng, k))
            kept.append(gain > 0), splits.append(split)
            both = np.stack([whole - right, right], 2)          # (rows or weights, node, side, class)
            open_.append(rule.open(both[0], depth + 1))
            shares.append(both[1][..., 1] / np.maximum(both[1].sum(-1), 1e-300))
        kept, split = np.concatenate(kept), np.concatenate(splits, 1)
        share, open_ = np.concatenate(shares)[kept], np.concatenate(open_)[kept]
        left = made + 2 * (np.cumsum(kept) - 1)
        level = np.concatenate(nodes)
        into = ids[kept]
        for name, v in zip(("col", "lo", "hi"), split):
            level[name][into] = v[kept]
        level["left"][into] = left[kept]
        children = made + np.arange(2 * kept.sum())
        nodes = [level, _leaves(children, share.ravel())]
        made += len(children)
        ids = children[open_.ravel()]
        place = np.where(open_.ravel(), np.cumsum(open_.ravel()) - 1, -1)
        # rows of nodes that go on, in the order of their new nodes
        x = bins.ravel().take(split[0].take(at) * len(at) + np.arange(len(at)))
        side = (x >= split[1].take(at)) & (x <= split[2].take(at))
        to = np.full((len(kept), 2), -1)
        to[kept] = place.reshape(-1, 2)
        to = to.ravel().take(2 * at + side)
        stay = np.flatnonzero(to >= 0)
        to = to[stay]
        turn = np.argsort(to.astype(np.uint16) if len(ids) <= 1 << 16 else to, kind="stable")    # radix sort
        stay, at = stay[turn], to[turn]
        bins, y, n, w = bins.take(stay, 1), y[stay], n[stay], w[stay]
        m, depth = len(ids), depth + 1
    return np.concatenate(nodes)


def walked(tree: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """Each row's node after ``depth`` steps."""
    at, every = np.zeros(bins.shape[1], np.intp), np.arange(bins.shape[1])
    col, lo, hi, left = (np.ascontiguousarray(tree[k]) for k in ("col", "lo", "hi", "left"))
    for _ in range(depth):
        x = bins[col[at], every]
        at = left[at] + ((x >= lo[at]) & (x <= hi[at]))
    return at


def _drawn(rule: Rule, tree: int, block: int, bins: np.ndarray, r: np.ndarray):
    """The rows of a block that a tree has drawn: bins, class, count, weight."""
    n = np.random.default_rng([rule.seed, tree, block]).poisson(1.0, len(r))
    rows = np.flatnonzero(n)
    r = r[rows]
    return bins.take(rows, 1), (r > 0).astype(np.uint8), n[rows].astype(np.uint8), np.abs(r)


def _summed(batches: Iterator[pa.RecordBatch], rule: Rule, trees, wide) -> Iterator[pa.RecordBatch]:
    """Rows and weights by (tree, node, column, bin, class) of the nodes ``wide`` names for each tree."""
    grid, total = rule.grid, {}
    for block, bins, r in _each(batches, rule.grid):
        for t, ids in wide.items():
            b, y, n, w = _drawn(rule, t, block, bins, r)
            at = walked(trees[t][0], b, trees[t][1])
            for node in ids:
                rows = np.flatnonzero(at == node)
                s = total.setdefault((t, node), np.zeros((2, grid.width * 2)))
                for c, start in enumerate(grid.starts[:-1]):
                    i = 2 * (b[c, rows].astype(np.intp) + start) + y[rows]
                    s[0] += np.bincount(i, n[rows], s.shape[1])
                    s[1] += np.bincount(i, n[rows] * w[rows], s.shape[1])
    yield pa.RecordBatch.from_pydict({
        "tree": pa.array([t for t, _ in total], pa.int32()), "node": pa.array([k for _, k in total], pa.int32()),
        "sums": pa.array([s.tobytes() for s in total.values()], pa.binary())})


def _added(rows: pa.Table) -> pa.Table:
    s = sum(np.frombuffer(x.as_buffer()) for x in rows["sums"])
    return pa.table({"tree": rows["tree"][:1], "node": rows["node"][:1], "sums": pa.array([s.tobytes()], pa.binary())})


def _sent(batches: Iterator[pa.RecordBatch], rule: Rule, trees, units) -> Iterator[pa.RecordBatch]:
    """The drawn rows of a block for each of ``units``: (tree, node)."""
    for block, bins, r in _each(batches, rule.grid):
        for t, ids in units.items():
            b, y, n, w = _drawn(rule, t, block, bins, r)
            at = walked(trees[t][0], b, trees[t][1])
            found = [(node, np.flatnonzero(at == node)) for node in ids]
            found = [(node, rows) for node, rows in found if len(rows)]
            raw = lambda parts: pa.array([p.tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t] * len(found), pa.int32()), "node": pa.array([k for k, _ in found], pa.int32()),
                "depth": pa.array([trees[t][2][k] for k, _ in found], pa.int32()),
                "block": pa.array([block] * len(found), pa.int64()),
                "bins": raw([b.take(k, 1) for _, k in found]), "yn": raw([2 * n[k] + y[k] for _, k in found]),
                "w": raw([w[k] for _, k in found])})


_SENT = "tree int, node int, depth int, block long, bins binary, yn binary, w binary"


def _unit(rows: pa.Table, rule: Rule) -> pa.Table:
    rows = rows.sort_by("block")        # the same trees whichever task comes first
    get = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in rows[name]]
    yn, w = np.concatenate(get("yn", np.uint8)), np.concatenate(get("w", np.float32)).astype(np.float64)
    c = len(rule.grid.sizes)
    bins = np.concatenate([b.reshape(c, -1) for b in get("bins", rule.grid.dtype)], 1)
    tree, node, depth = (rows[k][0].as_py() for k in ("tree", "node", "depth"))
    out = grown(rule, bins, yn & 1, (yn >> 1).astype(np.float64), w, depth,
                np.random.default_rng([rule.seed, tree, node, 1]))
    return pa.table({"tree": rows["tree"][:1], "node": rows["node"][:1], "nodes": pa.array([out.tobytes()], pa.binary())})


@dataclass
class BlockForest:
    """The fitted trees, arrays of ``NODE``. Rows with a missing numeric input are left out."""

    grid: Grid
    max_depth: int
    trees: list[np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        grid, depth = self.grid, self.max_depth
        sent = df.sparkSession.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def share(*columns: pd.Series) -> pd.Series:
            bins = grid.binned([c.to_numpy() for c in columns])
            out = np.zeros(bins.shape[1])
            for t in sent.value:
                out += t["value"][walked(t, bins, depth)]
            return pd.Series(out / len(sent.value))

        p = F.col("__p")
        return (complete(df, grid.numeric).withColumn("__p", share(*grid.inputs()))
                .withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("__p"))

    def save(self, path: str) -> None:
        spec = json.dumps({"grid": asdict(self.grid), "max_depth": self.max_depth})
        (SparkSession.active().createDataFrame([(i, spec, bytearray(t.tobytes())) for i, t in enumerate(self.trees)],
                                               "tree int, spec string, nodes binary")
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{FOLDER}"))

    @classmethod
    def load(cls, path: str) -> BlockForest:
        rows = SparkSession.active().read.parquet(f"{path.rstrip('/')}/{FOLDER}").orderBy("tree").collect()
        spec = json.loads(rows[0]["spec"])
        return cls(Grid(**spec["grid"]), spec["max_depth"], [np.frombuffer(r["nodes"], NODE) for r in rows])


FOLDER = "block-forest"


def block_forest(train: DataFrame, label: str, weight: str | None, numeric: Sequence[str], cats: Sequence[str],
                 num_trees: int, max_depth: int, min_rows: int, seed: int) -> BlockForest:
    """``label`` is 0 or 1. A row's class and weight travel as one number: its sign is the class."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = complete(train, numeric).where(F.col(label).isNotNull() & (w > 0))
    grid, n = fit_grid(rows, numeric, cats, drop_last=True, seed=seed)
    if n == 0:
        raise ValueError("no rows to learn from")
    rule = Rule(grid, 0, min_rows, max_depth, seed)
    rule.subset = rule.features if num_trees == 1 else math.ceil(math.sqrt(rule.features))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = cores * -(-n // (4 * BLOCK_ROWS * cores))
    size = min(BLOCK_ROWS, -(-n // (4 * cores)))
    state = (rows.select(*grid.inputs(), F.when(F.col(label) == 1, w).otherwise(-w).alias("y"))
             .mapInArrow(partial(_packed, grid=grid, size=size), BLOCK)
             .repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK))
    per = max(1, BATCH_ROWS // n)
    forest: list[np.ndarray] = []
    for start in range(0, num_trees, per):
        forest += _batch(state, rule, range(start, min(num_trees, start + per)), n, cores)
    state.unpersist()
    return BlockForest(grid, max_depth, forest)


def _batch(state: DataFrame, rule: Rule, numbers: range, n: int, cores: int) -> list[np.ndarray]:
    """The trees of these numbers. ``trees``: nodes so far, steps to its deepest, each node's depth."""
    trees = {t: (_leaves(np.zeros(1, int), np.zeros(1)), 0, {0: 0}) for t in numbers}
    units: dict[int, list[int]] = {t: [] for t in numbers}
    wide = {t: [0] for t in numbers} if n > UNIT_ROWS else {}
    if not wide:
        units = {t: [0] for t in numbers}
    grid = rule.grid
    while wide:
        sums = (state.mapInArrow(partial(_summed, rule=rule, trees=trees, wide=wide), "tree int, node int, sums binary")
                .groupBy("tree", "node").applyInArrow(lambda parts: _added(parts), "tree int, node int, sums binary").collect())
        wide = {}
        for s in sorted(sums, key=lambda s: (s["tree"], s["node"])):
            t, k = s["tree"], s["node"]
            both = np.frombuffer(s["sums"]).reshape(2, 1, grid.width, 2)
            of = lambda c: both[:, :, grid.starts[c]:grid.starts[c + 1]]  # noqa: E731, B023
            gain, split, whole, right = rule.best(of, rule.tried(np.random.default_rng([rule.seed, t, k, 0]), 1))
            nodes, steps, depths = trees[t]
            nodes["value"][k] = whole[1, 0, 1] / max(whole[1, 0].sum(), 1e-300)
            if gain[0] <= 0:
                continue
            child, depth = len(nodes), depths[k] + 1
            sides = np.stack([whole - right, right])[:, :, 0]       # (side, rows or weights, class)
            for name, v in zip(("col", "lo", "hi"), split[:, 0]):
                nodes[name][k] = v
            nodes["left"][k] = child
            nodes = np.concatenate([nodes, _leaves(child + np.arange(2),
                                                   sides[:, 1, 1] / np.maximum(sides[:, 1].sum(1), 1e-300))])
            trees[t] = nodes, max(steps, depth), depths | {child: depth, child + 1: depth}
            for i, rows in enumerate(sides[:, 0]):
                if rule.open(rows[None], depth)[0]:
                    (wide.setdefault(t, []) if rows.sum() > UNIT_ROWS else units[t]).append(child + i)
    units = {t: ids for t, ids in units.items() if ids}
    out = {t: [nodes] for t, (nodes, _, _) in trees.items()}
    parts = max(cores, min(8 * cores, sum(map(len, units.values()))))
    found = (state.mapInArrow(partial(_sent, rule=rule, trees=trees, units=units), _SENT).repartition(parts, "tree", "node")
             .groupBy("tree", "node").applyInArrow(lambda unit: _unit(unit, rule), "tree int, node int, nodes binary"))
    for r in found.collect() if units else []:
        more = np.frombuffer(r["nodes"], NODE).copy()
        at = np.concatenate([[r["node"]], sum(map(len, out[r["tree"]])) + np.arange(len(more) - 1)])
        more["left"] = at[more["left"]]
        out[r["tree"]][0][r["node"]] = more[0]
        out[r["tree"]].append(more[1:])
    return [np.concatenate(out[t]) for t in numbers]
