"""Sharding by k-d tree partitioning, DataFrame operations only.

Documents are points of their metadata (language, source, log size, doc_id); documents of
equal text are one group and take the metadata of the one of least doc_id. A node that must
give ``m`` shards splits along its widest dimension (relative to the whole table) at the
weighted quantile that leaves ``m // 2`` shards' bytes on the left, until each leaf is one
shard: the law is ``bytes``. The quantiles of all nodes of a level are found together by
histograms, refined around the wanted bytes until the bin that holds the cut is below
``TOLERANCE`` of a shard or a single key; only these histograms (at most ``BINS`` rows a
round in all) reach the driver. A key is the dimension's value and a hash of the text, so a
group is cut only where it straddles a quantile with more than ``GROUP_TOLERANCE`` of a
shard, then by a hash of doc_id.

The metadata with the node of each document is written to the shared folder once a level.
Slots count through blocks of a shard (a hash of doc_id), each block's rows ranked by
themselves and offset by the sizes of the blocks before, so no task sees a whole shard.

Text metadata are numbered by rank among their distinct values, numbers are taken as they are.

Defined results: a null text has no bytes, size 16 and CRC 0; null metadata sort first;
repeated rows (equal id and text) fall into one shard, with slots of their own; an empty
table gives no rows; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm.base import staged
from delaylake.operators.evaluate import running_sum_before

N_SHARDS = 40
OVERHEAD = 16
DIMENSIONS = ("lang", "source", "size", "doc_id")
BINS = 1 << 15
TOLERANCE = 0.0005
GROUP_TOLERANCE = 0.005
BLOCK_ROWS = 20_000
_BITS = 31
_SPAN = (1 << _BITS) - 1


@dataclass
class Node:
    """Shards [shard, shard + m); once split: rows with key of ``dim`` below ``key``, or
    equal to it and tie at most ``tie``, go left."""

    shard: int
    m: int
    dim: str | None = None
    key: int = 0
    tie: int = 0
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def child(self) -> Column:
        """First shard of the side that a row of this node falls on."""
        k = F.col(f"k_{self.dim}")
        goes_left = (k < self.key) | ((k == self.key) & (F.col("tie") <= self.tie))
        return F.when(goes_left, self.left.shard).otherwise(self.right.shard)


def _number(c: Column) -> Column:
    """Order-preserving number of a metadata column that is a number or a date; null is least."""
    return F.coalesce(c.cast("double"), F.lit(float(-(1 << 62))))


def _ranks(docs: DataFrame, column: str) -> DataFrame:
    """``value, rank``: the distinct texts of a column, numbered in the order of their bytes, so
    that values that differ anywhere, however long they are, have coordinates of their own."""
    values = docs.select(F.col(column).alias("value")).where("value is not null").distinct()
    return running_sum_before(values.withColumn("one", F.lit(1).cast("long")), "value", "one", "rank").select(
        "value", F.col("rank").cast("double").alias("rank"))


def _points(docs: DataFrame, dimensions) -> DataFrame:
    size = F.coalesce(F.octet_length("text").cast("long"), F.lit(0)) + F.lit(OVERHEAD)
    base = docs.select("doc_id", *[d for d in dimensions if d not in ("size", "doc_id")],
                       size.alias("size"),
                       F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).alias("text_crc32"),
                       F.xxhash64("text").alias("text_hash"))
    texts = [d for d in dimensions if d != "size" and base.schema[d].dataType.simpleString() == "string"]
    for d in texts:      # a hot value's rows meet one row: a join that adaptive execution splits
        ranks = _ranks(docs, d).toDF(f"value_{d}", f"rank_{d}")
        base = base.join(ranks, F.col(d) == F.col(f"value_{d}"), "left").drop(f"value_{d}")
    values = [(F.log2(F.col("size").cast("double")) if d == "size" else
               F.coalesce(f"rank_{d}", F.lit(-1.0)) if d in texts else _number(F.col(d))).alias(f"v_{d}")
              for d in dimensions]
    own = base.select("doc_id", "size", "text_crc32", "text_hash", *values)
    group = "text_hash", "text_crc32", "size"
    first = own.groupBy(*group).agg(F.min(F.struct("doc_id", *[f"v_{d}" for d in dimensions])).alias("first"))
    raw = staged(own.drop(*[f"v_{d}" for d in dimensions]).join(first, list(group)).select(
        "doc_id", *group, F.xxhash64("doc_id", "text_hash").alias("tie"),
        *[F.col(f"first.v_{d}").alias(f"v_{d}") for d in dimensions]), "points")
    ends = raw.agg(*[f(f"v_{d}").alias(f"{n}_{d}") for d in dimensions
                     for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()

    def key(d):
        lo, hi = ends[f"lo_{d}"], ends[f"hi_{d}"]
        if lo is None or hi <= lo:
            at = F.lit(0).cast("long")
        else:
            at = F.floor((F.col(f"v_{d}") - lo) / (hi - lo) * _SPAN).cast("long")
        return (F.shiftleft(at, _BITS) + F.shiftrightunsigned("text_hash", 64 - _BITS)).alias(f"k_{d}")

    # two bits less, so that differences of ties fit into a long
    return raw.select("doc_id", "size", "text_crc32", F.shiftright("tie", 2).alias("tie"), *[key(d) for d in dimensions])


def _per_node(nodes: list[Node], value) -> Column:
    """``value(node)`` for the node of the row's ``node`` column."""
    out = F.lit(None)
    for n in nodes:
        out = F.when(F.col("node") == n.shard, value(n)).otherwise(out)
    return out


def _cut(placed: DataFrame, nodes: list[Node], column, want: dict, ranges: dict, least: float) -> dict:
    """For each node the bin of ``column(node)`` (within ``ranges``) in which the bytes summed
    from the low end reach ``want``, refined until it holds at most ``least`` bytes or is one
    value: shard -> (first value, last value, bytes below the bin, bytes in it)."""
    found, open_ = {}, {n.shard: (*ranges[n.shard], 0) for n in nodes}
    while open_:
        now = [n for n in nodes if n.shard in open_]
        bins = max(2, BINS // len(now))
        step = {n.shard: max(1, -(-(open_[n.shard][1] - open_[n.shard][0] + 1) // bins)) for n in now}
        rows = (placed.where(F.col("node").isin([n.shard for n in now]))
                .select("node", "size", _per_node(now, column).alias("x"),
                        *[_per_node(now, lambda n, f=f: F.lit(f(n))).alias(name) for name, f in (
                            ("lo", lambda n: open_[n.shard][0]), ("hi", lambda n: open_[n.shard][1]),
                            ("step", lambda n: step[n.shard]))])
                .where("x between lo and hi").groupBy("node", F.expr("(x - lo) div step").alias("bin"))
                .agg(F.sum("size").alias("bytes")).collect())
        by_node: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r["node"], r["bin"])):
            by_node.setdefault(r["node"], []).append((r["bin"], r["bytes"]))
        for n in now:
            lo, hi, below = open_.pop(n.shard)
            for at, weight in by_node[n.shard]:
                if below + weight >= want[n.shard] or at == by_node[n.shard][-1][0]:
                    break
                below += weight
            first = lo + at * step[n.shard]
            last = min(hi, first + step[n.shard] - 1)
            if first == last or weight <= least:
                found[n.shard] = (first, last, below, weight)
            else:
                open_[n.shard] = (first, last, below)
    return found


def _split(node: Node, spread: dict, stats, dimensions) -> None:
    half = node.m // 2
    node.left, node.right = Node(node.shard, half), Node(node.shard + half, node.m - half)
    node.dim = max(dimensions, key=lambda d: ((stats[f"hi_{d}"] - stats[f"lo_{d}"]) / spread[d],
                                              -dimensions.index(d)))


def place(points: DataFrame, n_shards: int, dimensions=DIMENSIONS) -> tuple[DataFrame, Node]:
    """``points`` with the leaf (``node``) of each row, and the tree. Each level takes one
    aggregate for the widths and a few bounded histograms for the cuts."""
    root, spread = Node(0, n_shards), None
    placed = points.withColumn("node", F.lit(0))
    while todo := [n for n in root.leaves() if n.m > 1]:
        stats = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *[f(f"k_{d}").alias(f"{n}_{d}") for d in dimensions for f, n in ((F.min, "lo"), (F.max, "hi"))])
            .collect()}
        todo = [n for n in todo if n.shard in stats]
        if not todo:
            break
        spread = spread or {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) for d in dimensions}
        for n in todo:
            _split(n, spread, stats[n.shard], dimensions)
        want = {n.shard: stats[n.shard]["bytes"] * n.left.m / n.m for n in todo}
        shard = min(stats[n.shard]["bytes"] / n.m for n in todo)
        cuts = _cut(placed, todo, lambda n: F.col(f"k_{n.dim}"), want,
                    {n.shard: (stats[n.shard][f"lo_{n.dim}"], stats[n.shard][f"hi_{n.dim}"]) for n in todo},
                    TOLERANCE * shard)
        heavy = [n for n in todo if cuts[n.shard][3] > GROUP_TOLERANCE * shard]
        for n in todo:
            first, last, below, weight = cuts[n.shard]
            n.key, n.tie = last, 1 << 62
            if want[n.shard] - below < below + weight - want[n.shard]:
                n.key, n.tie = first, -(1 << 62)  # the bin goes right as a whole
        if heavy:
            inside = _cut(placed, heavy, lambda n: F.when(F.col(f"k_{n.dim}") == cuts[n.shard][0], F.col("tie")),
                          {n.shard: want[n.shard] - cuts[n.shard][2] for n in heavy},
                          {n.shard: (-(1 << 61), (1 << 61) - 1) for n in heavy}, TOLERANCE * shard)
            for n in heavy:
                n.key, n.tie = cuts[n.shard][0], inside[n.shard][1]
        placed = staged(placed.withColumn(
            "node", F.coalesce(_per_node(todo, Node.child), F.col("node"))), "placed")
    return placed, root


def kd_sharding(docs: DataFrame, n_shards: int = N_SHARDS, dimensions=DIMENSIONS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law (``bytes``), shard, slot (from 0, gapless in
    the shard), grown_shard (null: the law is not ``key``)."""
    points = _points(docs, dimensions)
    points, _ = place(points, n_shards, dimensions)
    rows = points.agg(F.count("*")).first()[0]
    blocks = max(1, -(-rows // (n_shards * BLOCK_ROWS)))
    placed = (points.select("doc_id", "size", "text_crc32", "tie", F.col("node").alias("shard"))
              .withColumn("block", F.pmod("tie", F.lit(blocks)).cast("int")))
    sizes = placed.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "block",
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "block").orderBy("tie", "doc_id")
    return (placed.withColumn("rank", F.row_number().over(inside)).join(offsets, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
