"""MinHash near-dedup with odd sketches.

A document's set holds its distinct 5-word shingles; two documents link when the sets'
Jaccard similarity reaches ``percent``.

1. Every set gets ``bands * rows`` MinHash samples. The samples of a band give a bucket; all
   of them together are folded into an odd sketch: a bitmap in which every (function, sample)
   flips one bit, so that the XOR of two sketches has a bit for each sample that only one set
   has (but for those that meet). Its population count z estimates the similarity,
   ``1 + bits / (4 k) * ln(1 - 2 z / bits)`` for k samples, best where it is high.
2. Candidates share a bucket. A bucket is not expanded into its pairs: each class of equal
   sets meets the least class of its buckets (a star); the sketches drop most pairs, the full
   sets of the others are compared, and linked classes become components.
3. What is left are pairs of different components within a bucket. They are compared by
   sketch where they lie: a bucket of any size is cut into blocks, a task holds two blocks,
   and only pairs whose sketches pass leave it, once, at the first band that they share.
   Those are compared on full sets too.

A pair at the threshold misses all 48 bands of 8 with probability 3e-7, and fails the sketch
test, which allows five standard deviations, about as rarely; both fall fast above it. No
bucket, partner list or text is capped.

Defined results: null, empty and blank texts have no shingles and are linked with nothing
(their own component, kept); with fewer words than a shingle has, the whole sequence is one.
Rows without doc_id get their set size, no component, and are kept. Repeated rows are one
document, each returned; texts of one doc_id share a component. Other columns are never read.
Memory follows the longest text (a slice of 1 MB of text, one row at least, and 8 bytes a word
a few times over).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import Scratch, bounded_batches, packed, unpacked
from delaylake.llm.components import components
from delaylake.llm.jaccard_join import SHINGLE, shingle_sets

PERCENT = 85
BANDS, ROWS, BITS = 48, 8, 2048
DEVIATIONS = 5
BLOCK = 1500          # classes of a bucket that are compared with as many others in one task
_CHUNK = 1 << 14      # sketch pairs compared at once


def min_samples(value: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """k MinHash samples of each set; ``starts`` has the start of every (nonempty) set."""
    factor, shift = W.mix(np.arange(k, dtype=np.uint64), 31) | np.uint64(1), W.mix(np.arange(k, dtype=np.uint64), 32)
    out = np.empty((len(starts), k), np.uint64)
    x = W.mix(value, 30)
    for i in range(k if len(starts) else 0):
        out[:, i] = np.minimum.reduceat(x * factor[i] + shift[i], starts)
    return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(samples), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(samples), b, np.uint64)
        for r in range(rows):
            h = W.mix(h ^ samples[:, b * rows + r], 33 + r)
        out[:, b] = h
    return out.astype(np.int64)


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps (rows of bits / 8 bytes): the parity of the samples that hash to each bit."""
    n, k = samples.shape
    at = W.mix(samples + np.arange(k, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 34)
    at = (at % np.uint64(bits)).astype(np.int64) + np.arange(n)[:, None] * bits
    odd = np.bincount(at.ravel(), minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1)


def similarity(z: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Estimate of the Jaccard similarity from the population count of an XOR."""
    return 1 + bits / (4 * k) * np.log(np.maximum(1 - 2 * z / bits, 1e-9))


def floor_of(percent: int, k: int, bits: int) -> float:
    """The estimate that a pair at the threshold reaches, less ``DEVIATIONS`` standard ones:
    of the samples that agree, and of the bits on which differing ones meet."""
    t = percent / 100
    meet = (2 * k * (1 - t)) ** 2 / (2 * bits)
    return t - DEVIATIONS * math.sqrt(t * (1 - t) / k + meet / k ** 2)


def signatures(docs: DataFrame, k: int, bands: int, rows: int, bits: int) -> DataFrame:
    """``doc_id, n, key1, key2, bands, sketch``: set size, 128-bit key of the set, its buckets
    and odd sketch (null without shingles)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in W.slices(batches, "text"):
            _, value, first = shingle_sets(batch.column("text"), k)
            n = np.diff(first)
            some = n > 0
            samples = min_samples(value, first[:-1][some], bands * rows)
            keys = band_keys(samples, bands, rows)
            sketch = iter(odd_sketches(samples, bits)) if some.any() else iter(())
            ends = np.concatenate([[0], np.cumsum(some) * bands])
            sums = []
            for seed in (35, 36):
                c = np.zeros(len(value) + 1, np.uint64)
                np.cumsum(W.mix(value, seed), out=c[1:])
                sums.append(pa.array((c[first[1:]] - c[first[:-1]]).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), *sums,
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel())),
                 pa.array([next(sketch).tobytes() if s else None for s in some], pa.binary())],
                ["doc_id", "n", "key1", "key2", "bands", "sketch"])

    return docs.mapInArrow(run, f"doc_id {kind}, n long, key1 long, key2 long, "
                                "bands array<long>, sketch binary")


def _matrix(column, kind) -> np.ndarray:
    """A binary column of equal lengths as rows of ``kind``."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _sizes_allow(percent: int) -> F.Column:
    return F.expr(f"{percent} * n_u <= 100 * n_v and {percent} * n_v <= 100 * n_u")


def _sketched(pairs: DataFrame, classes: DataFrame, percent: int, k: int, bits: int) -> DataFrame:
    """The pairs ``u, v`` whose sizes and sketches allow the similarity."""
    kind = classes.schema["node"].dataType.simpleString()
    floor = floor_of(percent, k, bits)
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                                    F.col("sketch").alias(f"sketch_{c}"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                z = _counts(*(_matrix(batch.column(f"sketch_{c}"), np.uint64) for c in "uv"))
                at = pa.array(np.flatnonzero(similarity(z, k, bits) >= floor))
                yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in "uv"], ["u", "v"])

    return (pairs.join(side("u"), "u").join(side("v"), "v").where(_sizes_allow(percent))
            .select("u", "v", "sketch_u", "sketch_v").mapInArrow(run, f"u {kind}, v {kind}"))


def _linked(pairs: DataFrame, docs: DataFrame, scratch: Scratch, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    nodes = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
    texts = packed(docs.where("doc_id is not null and text is not null")
                   .select("doc_id", "text", F.xxhash64("text").alias("h")))
    bodies = scratch.write("bodies", texts.join(nodes, "doc_id").groupBy("doc_id", "h")
                           .agg(F.first("body").alias("body")))
    side = lambda c: bodies.select(F.col("doc_id").alias(c), F.col("body").alias(f"body_{c}"))

    def run(batches):
        for batch in unpacked(batches, columns=("body_u", "body_v")):
            _, x, fx = shingle_sets(batch.column("text_u"), k)
            _, y, fy = shingle_sets(batch.column("text_v"), k)
            ok = []
            for i in range(batch.num_rows):
                n, m = fx[i + 1] - fx[i], fy[i + 1] - fy[i]
                both = len(np.intersect1d(x[fx[i]:fx[i + 1]], y[fy[i]:fy[i + 1]], assume_unique=True))
                ok.append(n > 0 and m > 0 and 100 * both >= percent * (n + m - both))
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in "uv"], ["u", "v"])

    return (pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "body_u", "body_v")
            .mapInArrow(run, f"u {kind}, v {kind}"))


def _rest(shared: DataFrame, roots: DataFrame, classes: DataFrame, percent: int, k: int,
          bits: int) -> DataFrame:
    """Pairs of different components that share a bucket and whose sketches pass."""
    kind = classes.schema["node"].dataType.simpleString()
    floor = floor_of(percent, k, bits)
    at = shared.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    mixed = (at.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.count("*").alias("size"))
             .where("low <> high").select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    rows = (at.join(mixed, "bucket").join(classes.select("node", "n", "bands", "sketch"), "node")
            .withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
            .withColumn("near", F.explode(F.expr("sequence(0L, blocks - 1)")))
            .select("bucket", F.least("own", "near").alias("low"), F.greatest("own", "near").alias("high"),
                    "own", "node", "root", "n", "bands", "sketch"))

    def compare(key, table):
        bucket, low, high = (x.as_py() for x in key)
        table = table.combine_chunks()
        own, n = (table.column(c).to_numpy() for c in ("own", "n"))
        node, sketch = table.column("node"), _matrix(table.column("sketch"), np.uint64)
        root = table.column("root").combine_chunks().dictionary_encode()
        root = (root.chunk(0) if isinstance(root, pa.ChunkedArray) else root).indices.to_numpy()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        left = np.flatnonzero(own == low)
        right = np.flatnonzero(own == high)
        us, vs = [], []
        step = max(1, _CHUNK // max(1, len(right)))
        for a in range(0, len(left), step):
            x, y = (v.ravel() for v in np.meshgrid(left[a:a + step], right, indexing="ij"))
            may = (root[x] != root[y]) & (percent * n[x] <= 100 * n[y]) & (percent * n[y] <= 100 * n[x])
            if low == high:
                may &= x < y
            x, y = x[may], y[may]
            may = similarity(_counts(sketch[x], sketch[y]), k, bits) >= floor
            x, y = x[may], y[may]
            first = (bands[x] == bands[y]).argmax(axis=1)
            may = bands[x, first] == bucket
            us.append(x[may])
            vs.append(y[may])
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (us, vs))
        return pa.table({"u": node.take(pa.array(x)), "v": node.take(pa.array(y))})

    found = rows.groupBy("bucket", "low", "high").applyInArrow(compare, f"u {kind}, v {kind}")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def near_dedup(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
               rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links) and
    kept (it is that document)."""
    bounded_batches(docs.sparkSession)
    plain = docs.select("doc_id", "text")
    samples = bands * rows
    scratch = Scratch(docs.sparkSession)
    signed = scratch.write("signatures", signatures(plain, k, bands, rows, bits))
    known = signed.where("n > 0 and doc_id is not null")
    classes = scratch.write("classes", known.groupBy("key1", "key2", "n").agg(
        F.min(F.struct("doc_id", "bands", "sketch")).alias("rep")).select(
        "key1", "key2", "n", F.col("rep.doc_id").alias("node"), "rep.bands", "rep.sketch"))
    sizes = scratch.write("sizes", signed.select("doc_id", "n", "key1", "key2"))
    scratch.drop("signatures")

    held = classes.select(F.explode("bands").alias("bucket"), "node")
    hubs = (held.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
            .where("hub <> top").select("bucket", "hub"))
    shared = scratch.write("shared-buckets", held.join(hubs, "bucket"))
    stars = shared.where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    stars = scratch.write("star-pairs", _sketched(stars, classes, percent, samples, bits).distinct())
    links = scratch.write("star-links", _linked(stars, plain, scratch, k, percent))
    scratch.drop("bodies")
    roots = scratch.write("star-roots", components(links))

    rest = _rest(shared.select("bucket", "node"), roots, classes, percent, samples, bits)
    rest = scratch.write("rest-pairs", rest.join(stars, ["u", "v"], "left_anti"))
    more = scratch.write("rest-links", _linked(rest, plain, scratch, k, percent))
    scratch.drop("bodies", "shared-buckets", "star-pairs", "rest-pairs")

    named = scratch.write("named", sizes.where("n > 0 and doc_id is not null").join(
        classes.select("key1", "key2", "n", "node"), ["key1", "key2", "n"]).select("doc_id", "n", "node"))
    several = (named.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high"))
               .where("low <> high").select("doc_id"))
    same = named.join(several, "doc_id").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    roots = scratch.write("roots", components(links.union(more).union(same.where("u <> v"))))
    scratch.drop("classes", "star-links", "star-roots", "rest-links")
    found = named.join(roots, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id"))
    alone = sizes.where("n = 0 or doc_id is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
