"""Trie of conversation prefixes, rolled up by centroid decomposition.

Every distinct sequence of the first d turns (role, text) of a conversation is a node of depth
d, from the textless root; conversations that start with it are its members. A node is named
by its smallest member and its depth: that conversation's path runs through it.

1. Turns are numbered by a range sort over (conversation, turn); pieces of a long conversation
   are numbered apart and put together by their counts, so no conversation meets in one task.
2. A prefix is identified by two running XORs of 64-bit hashes of its (position, turn) pairs,
   taken over blocks of positions. One aggregate gives the nodes, one join every
   conversation's path (conversation, depth, owner of the node there).
3. Subtree sums (leaves, saved tokens) are rolled up along the parent edges by centroid
   decomposition. A component's centroid is its deepest node that holds at least half of it. The total
   of what lies under the centroid is added along the path from it to the component's top;
   then it is taken out, and the part above it and the subtrees of its children, none over
   half as large, are components of their own. A tree of any shape, a chain of a million turns
   or a root with a million children, is done in a logarithm of levels. Components over
   ``LOCAL_NODES`` are split by joins on the paths; smaller ones are packed into bins of about
   that many nodes and finished in tasks, by the same method on arrays.
4. The members that end in a node are hashed in numeric order as a stream of blocks of ids.

Defined results: turns stand in the order of ``turn`` (null first), then role, then text;
repeated rows are turns of their own; null roles and texts are empty; rows without a
conversation id are left out; other columns are never read. Without any conversation there
is no node, not even the root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm.base import Scratch, bounded_batches

LOCAL_NODES = 20_000
OPENING_STEP = 100      # conversation c opens with turns of the conversation c - c % 100
OPENING_TURNS = 6       # as many as crc32(c) % 6
_POSITIONS = 256        # positions of a conversation in one window
_IDS = 10_000           # ids joined into one string


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, pos, t1, t2, size``: turns in order from 1, hashes of (role, text), and the
    code points of the text."""
    order = ["conv_id", F.asc_nulls_first("turn")]
    text = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = (conversations.where("conv_id is not null")
            .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
            .select("conv_id", F.spark_partition_id().alias("piece"), text.alias("h"),
                    F.length("text").cast("long").alias("size"))
            .select("conv_id", "piece", F.xxhash64(F.lit(1), "h").alias("t1"),
                    F.xxhash64(F.lit(2), "h").alias("t2"), "size"))

    def count(batches):
        conv, n = None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            at = np.arange(len(ids))
            start = np.ones(len(ids), bool)
            start[1:] = ids[1:] != ids[:-1]
            if not len(ids):
                continue
            since = np.maximum.accumulate(np.where(start, at, 0))
            place = at - since
            if ids[0] == conv:
                place[:int(np.argmax(start[1:])) + 1 if start[1:].any() else len(ids)] += n
            conv, n = ids[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    found = scratch.write("turns", rows.mapInArrow(
        count, "conv_id long, piece int, t1 long, t2 long, size long, place long"))
    pieces = found.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    later = pieces.withColumn("before", F.sum("n").over(before)).where("before is not null").drop("n")
    return found.join(later, ["conv_id", "piece"], "left").select(
        "conv_id", (F.coalesce("before", F.lit(0)) + F.col("place") + 1).alias("pos"), "t1", "t2", "size")


def with_openings(turns: DataFrame, step: int = OPENING_STEP, most: int = OPENING_TURNS
                  ) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening of another: the turns (positions anew) and
    ``conv_id, len``, also of those left without turns."""
    lens = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = lens.select("conv_id", "n", F.expr(f"conv_id - conv_id % {step}").alias("base"),
                        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    convs = convs.join(lens.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = convs.select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"),
                         F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    head = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(
        convs.select("conv_id", "base", "h"), "base").where("pos <= h")
    tail = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").withColumn(
        "pos", F.col("taken") + F.col("pos") - F.col("h"))
    cols = ["conv_id", "pos", "t1", "t2", "size"]
    return head.select(cols).union(tail.select(cols)), convs.select(
        "conv_id", (F.col("taken") + F.col("own")).alias("len"))


def _prefix_keys(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, size, k1, k2``: keys of the prefix that ends with each turn."""
    one = (turns.withColumn("x1", F.xxhash64("pos", "t1", "t2")).withColumn("x2", F.xxhash64("t2", "pos", "t1"))
           .withColumn("block", F.floor((F.col("pos") - 1) / _POSITIONS)))
    sums = one.groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"c{i}")
                                              for i in (1, 2)])
    upto = Window.partitionBy("conv_id", "block").orderBy("pos")
    return (one.withColumn("r1", F.bit_xor("x1").over(upto)).withColumn("r2", F.bit_xor("x2").over(upto))
            .join(carry, ["conv_id", "block"])
            .select("conv_id", "pos", "size", F.expr("r1 ^ c1").alias("k1"), F.expr("r2 ^ c2").alias("k2")))


def _nodes_and_paths(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Nodes ``c, d, n_convs, size`` and paths ``conv_id, p, owner``; the root is (least
    conversation, 0)."""
    keys = scratch.write("prefixes", _prefix_keys(turns))
    groups = scratch.write("groups", keys.groupBy(F.col("pos").alias("d"), "k1", "k2").agg(
        F.min("conv_id").alias("c"), F.count("*").alias("n_convs"), F.min("size").alias("size")))
    root = convs.agg(F.min("conv_id").alias("c"), F.count("*").alias("n_convs")).where("c is not null").select(
        "c", F.lit(0).cast("long").alias("d"), "n_convs", F.lit(0).cast("long").alias("size"))
    nodes = scratch.write("nodes", groups.select("c", "d", "n_convs", "size").union(root))
    paths = keys.join(groups.select(F.col("d").alias("pos"), "k1", "k2", F.col("c").alias("owner")),
                      ["pos", "k1", "k2"]).select("conv_id", F.col("pos").alias("p"), "owner")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("p")).crossJoin(
        F.broadcast(root.select(F.col("c").alias("owner"))))
    paths = scratch.write("paths", paths.union(roots))
    scratch.drop("prefixes", "groups", "turns")
    return nodes, paths


def subtree_sizes(paths: DataFrame) -> DataFrame:
    """``c, d, n``: nodes of each subtree. A conversation owns the last part of its path; what it
    owns lies under every node before, and behind its own."""
    own = (paths.where("owner = conv_id").groupBy("conv_id")
           .agg(F.min("p").alias("first"), F.max("p").alias("last")))
    far = (paths.where("owner <> conv_id").join(own, "conv_id")
           .groupBy(F.col("owner").alias("c"), F.col("p").alias("d"))
           .agg(F.sum(F.expr("last - first + 1")).alias("far")))
    near = paths.where("owner = conv_id").join(own, "conv_id").select(
        F.col("conv_id").alias("c"), F.col("p").alias("d"), (F.col("last") - F.col("p") + 1).alias("near"))
    return near.join(far, ["c", "d"], "left").select("c", "d", (F.col("near") + F.coalesce("far", F.lit(0))).alias("n"))


def _split(parts: DataFrame, paths: DataFrame, values: list[str], scratch: Scratch
           ) -> tuple[DataFrame, DataFrame]:
    """One level over components that are too large: what is left in components, and the
    centroids taken out with their sums. ``parts`` has a node's c, d, its component's top
    (tc, td), its subtree's size in the component n, values and the sums found so far."""
    top = parts.where("c = tc and d = td").select("tc", "td", F.col("n").alias("total"))
    centroid = scratch.write("centroids", parts.join(top, ["tc", "td"]).where("2 * n >= total").groupBy("tc", "td")
                             .agg(F.max(F.struct("d", "c", "n")).alias("g"))
                             .select("tc", "td", F.col("g.c").alias("gc"), F.col("g.d").alias("gd"),
                                     F.col("g.n").alias("gn")))
    # the ancestors of every node at the centroid's depth and one below it
    deep = parts.join(centroid, ["tc", "td"])
    step = lambda name: paths.select(F.col("conv_id").alias("c"), F.col("p").alias(f"{name}_p"),
                                     F.col("owner").alias(name))
    placed = (deep.withColumn("at_p", F.when(F.col("d") >= F.col("gd"), F.col("gd")))
              .withColumn("child_p", F.when(F.col("d") > F.col("gd"), F.col("gd") + 1))
              .join(step("at"), ["c", "at_p"], "left").join(step("child"), ["c", "child_p"], "left")
              .withColumn("below", F.coalesce(F.col("at") == F.col("gc"), F.lit(False))))
    placed = scratch.write("placed", placed.drop("at", "at_p", "child_p"))
    totals = placed.where("below").groupBy("tc", "td").agg(*[F.sum(v).alias(f"total_{v}") for v in values])
    onward = (centroid.join(totals, ["tc", "td"])
              .join(paths.withColumnRenamed("conv_id", "gc"), "gc").where("p >= td and p <= gd")
              .select(F.col("owner").alias("c"), F.col("p").alias("d"), F.col("gn").alias("less"),
                      *[f"total_{v}" for v in values]))
    summed = placed.join(onward, ["c", "d"], "left")
    for v in values:
        summed = summed.withColumn(f"sum_{v}", F.col(f"sum_{v}") + F.coalesce(f"total_{v}", F.lit(0)))
    is_g = (F.col("c") == F.col("gc")) & (F.col("d") == F.col("gd"))
    sums = [f"sum_{v}" for v in values]
    out = summed.where(is_g).select("c", "d", *sums)
    lower = F.col("below")
    left = summed.where(~is_g).select(
        "c", "d", F.when(lower, F.col("child")).otherwise(F.col("tc")).alias("tc"),
        F.when(lower, F.col("gd") + 1).otherwise(F.col("td")).alias("td"),
        F.when(lower, F.col("n")).otherwise(F.col("n") - F.coalesce("less", F.lit(0))).alias("n"),
        "pc", *values, *sums)
    return left, out


def local_rollup(depth: np.ndarray, parent: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Subtree sums of a forest by centroid decomposition. ``parent`` is a position or -1."""
    n = len(depth)
    by_depth = np.argsort(depth, kind="stable")
    bounds = np.flatnonzero(np.diff(depth[by_depth])) + 1
    levels = np.split(by_depth, bounds) if n else []
    size = np.ones(n, np.int64)
    for level in reversed(levels):
        at = level[parent[level] >= 0]
        np.add.at(size, parent[at], size[at])
    # preorder places, so that a subtree is a range
    place = np.zeros(n, np.int64)
    for level in levels:
        order = level[np.argsort(parent[level], kind="stable")]
        before = np.cumsum(size[order]) - size[order]
        start = np.ones(len(order), bool)
        start[1:] = parent[order][1:] != parent[order][:-1]
        start |= parent[order] < 0
        rel = before - np.maximum.accumulate(np.where(start, before, 0))
        up = parent[order]
        place[order] = np.where(up >= 0, place[up] + 1 + rel, 0)
    width = size.copy()                     # of the whole subtree; size is that in the component
    top = np.arange(n)                      # of a node's component
    for level in levels:
        at = level[parent[level] >= 0]
        top[at] = top[parent[at]]
    out = [v.copy() * 0 for v in values]
    live = np.arange(n)
    while len(live):
        half = live[2 * size[live] >= size[top[live]]]
        half = half[np.lexsort((depth[half], top[half]))]
        last = np.ones(len(half), bool)
        last[:-1] = top[half][1:] != top[half][:-1]
        g = half[last]                      # one of each component
        of = np.full(n, -1)
        of[top[g]] = g
        mine = of[top[live]]
        below = (place[live] >= place[mine]) & (place[live] < place[mine] + width[mine])
        total = []
        for v in values:
            t = np.zeros(n, v.dtype)
            np.add.at(t, mine[below], v[live[below]])
            total.append(t)
        at, who, stop, less = g.copy(), g, top[g].copy(), size[g].copy()
        while len(at):                      # along the paths to the tops
            for o, t in zip(out, total):
                o[at] += t[who]
            size[at] -= less
            go = at != stop
            at, who, stop, less = parent[at[go]], who[go], stop[go], less[go]
        gone = np.zeros(n, bool)
        gone[g] = True
        new = live[below & (parent[live] == mine) & ~gone[live]]
        down = live[below & ~gone[live]]
        # the child of the centroid that a node lies under: the last one of its component before it
        new = new[np.lexsort((place[new], top[new]))]
        keys = top[new] * (n + 1) + place[new]
        order_tops = new
        found = np.searchsorted(keys, top[down] * (n + 1) + place[down], "right") - 1
        fresh = order_tops[found] if len(down) else down
        top[down] = fresh
        live = live[~gone[live]]
    return out


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], scratch: Scratch,
           local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``c, d`` and the subtree sums of ``values`` (as ``sum_...``). ``nodes`` has c, d and the
    parent's conversation ``pc``."""
    sums = [f"sum_{v}" for v in values]
    root = nodes.where("d = 0").select(F.col("c").alias("tc"))
    parts = nodes.join(subtree_sizes(paths), ["c", "d"]).crossJoin(F.broadcast(root)).select(
        "c", "d", "tc", F.lit(0).cast("long").alias("td"), "n", "pc", *values,
        *[F.lit(0).cast("long").alias(s) for s in sums])
    parts = scratch.write("parts", parts)
    small, done = [], []
    while True:
        tops = parts.where("c = tc and d = td").select("tc", "td", (F.col("n") > local_nodes).alias("large"))
        if tops.where("large").isEmpty():
            small.append(parts)
            break
        known = scratch.write("sized", parts.join(tops, ["tc", "td"]))
        small.append(known.where("not large").drop("large"))
        left, out = _split(known.where("large").drop("large"), paths, values, scratch)
        parts = scratch.write("parts", left)
        done.append(scratch.write("done", out))
        scratch.drop("placed", "centroids")
    rest = small[0].select(parts.columns)
    for more in small[1:]:
        rest = rest.union(more.select(parts.columns))
    total = rest.count()
    bins = -(-total // local_nodes) or 1

    def finish(table):
        table = table.combine_chunks()
        c, d, pc, tc, td = (table.column(x).to_numpy() for x in ("c", "d", "pc", "tc", "td"))
        place = {x: i for i, x in enumerate(zip(c.tolist(), d.tolist()))}
        is_top = (c == tc) & (d == td)
        parent = np.array([-1 if t else place[p, q] for t, p, q in
                           zip(is_top.tolist(), pc.tolist(), (d - 1).tolist())], np.int64)
        found = local_rollup(d, parent, [table.column(v).to_numpy().copy() for v in values])
        return pa.table({"c": c, "d": d, **{s: f + table.column(s).to_numpy() for s, f in zip(sums, found)}})

    rest = rest.withColumn("pc", F.coalesce("pc", F.lit(-1))).withColumn(
        "bin", F.expr(f"pmod(xxhash64(tc, td), {bins})"))
    out = rest.groupBy("bin").applyInArrow(
        finish, ", ".join(["c long", "d long", *(f"{s} long" for s in sums)]))
    for more in done:
        out = out.union(more.select(out.columns))
    return out


def ends_digests(ends: DataFrame) -> DataFrame:
    """``c, d, ends_sha256`` from ``c, d, conv_id``: SHA-256 of the ids in numeric order, joined
    by commas, read as a stream of blocks of ids."""
    blocks = (ends.withColumn("range", F.floor(F.col("conv_id") / _IDS))
              .groupBy("c", "d", "range").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .select("c", "d", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def digest(batches):
        node, h, out = None, None, []
        for batch in batches:
            for c, d, ids in zip(*(batch.column(x).to_pylist() for x in ("c", "d", "ids"))):
                if (c, d) != node:
                    if node is not None:
                        out.append((*node, h.hexdigest()))
                    node, h = (c, d), hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in zip(*out)], ["c", "d", "ends_sha256"])
                out = []
        if node is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (*node, h.hexdigest())], ["c", "d", "ends_sha256"])

    return (blocks.repartition("c", "d").sortWithinPartitions("c", "d", "range")
            .mapInArrow(digest, "c long, d long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, scratch: Scratch,
                local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. ``turns`` has conv_id, pos (from 1, without gaps), t1, t2, size; ``convs`` has
    conv_id and len of every conversation."""
    convs = scratch.write("convs", convs)
    nodes, paths = _nodes_and_paths(turns, convs, scratch)
    up = paths.select(F.col("conv_id").alias("c"), (F.col("p") + 1).alias("d"), F.col("owner").alias("pc"))
    edged = nodes.join(up, ["c", "d"], "left")
    children = (edged.where("d > 0").groupBy(F.col("pc").alias("c"), (F.col("d") - 1).alias("d"))
                .agg(F.count("*").alias("n_children")))
    tree = scratch.write("tree", edged.join(children, ["c", "d"], "left").select(
        "c", "d", "pc", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved")))
    sums = rollup(tree.select("c", "d", "pc", "leaf", "saved"), paths, ["leaf", "saved"], scratch, local_nodes)
    ends = ends_digests(convs.join(paths, (paths["conv_id"] == convs["conv_id"]) & (F.col("p") == F.col("len")))
                        .select(F.col("owner").alias("c"), F.col("p").alias("d"), convs["conv_id"]))
    empty = hashlib.sha256(b"").hexdigest()
    return tree.join(sums, ["c", "d"]).join(ends, ["c", "d"], "left").select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), "n_convs",
        "n_children", F.col("sum_leaf").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, openings: bool = True,
                      local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text), rebuilt with shared openings
    or as they are."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    turns = scratch.write("ordered", numbered_turns(plain, scratch))
    if openings:
        turns, convs = with_openings(turns)
    else:
        convs = turns.groupBy("conv_id").agg(F.count("*").alias("len"))
    return prefix_trie(turns, convs, scratch, local_nodes)
