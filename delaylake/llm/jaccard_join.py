"""N-gram Jaccard join by multiple-global-order filtering.

A document's set holds its distinct 5-word shingles; two documents link when the sets'
Jaccard similarity reaches ``percent``. If it does, the sets share a token in their prefixes
under every global order of the tokens; here several orders must agree before a pair is
verified:

1. Order by hash. Of each set the first ``n - ceil(t n) + l`` tokens are shuffled. A linked
   pair shares at least ``l`` of them (``l`` a sixteenth of the smaller set, plus 1), so a set
   needs that many that another set has too.
2. Order by frequency, rare first, among the whole sets that passed: a set's prefix is its
   first ``n - ceil(t n) + 1`` tokens, of which those no other set has are no help. Most sets
   have none left, and hot shingles come last. Pairs come from the tokens left, by places
   that leave enough tokens behind them for the overlap needed.
3. Further hash orders. Every token of step 2 carries the orders in whose prefix of its set it
   stands, so a candidate has, beside its tokens of step 2, the shared tokens of its prefix
   under each further order: short arrays, which are intersected on the pairs. A pair whose
   prefixes share nothing under one of the orders is dropped before any text is joined.

The sets of the pairs left are compared exactly. Equal sets are one class and enter once.

Only links between components not yet joined are wanted, so no group is expanded into all
its pairs: round 1 links each class to the least class that holds the same token (a star),
round 2 pairs, token by token, the classes outside the token's largest component with all
classes of other components there. Together they find every link that joins components;
no cap is set on a token's classes.

Defined results: null, empty and blank texts have no shingles and are linked with nothing
(component_id is their own doc_id); rows without doc_id get their own set size and no
component; repeated rows are one document, each returned; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import Scratch, bounded_batches, packed, unpacked
from delaylake.llm.components import components

SHINGLE = 5
PERCENT = 75
_ORDER = 7               # seed of the first hash order
_FURTHER = (7, 8, 9)     # seeds of the orders that filter pairs


def shingle_sets(texts, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, text after text: their rows, the hashes, and
    the bounds of each text. Fewer than ``k`` words are one shingle."""
    data, off = W.text_bytes(texts)
    w = W.split_words(W.LOWER[data], off)
    h = W.word_hashes(w)
    win = W.window_hashes(h, k)
    at = np.flatnonzero(W.window_mask(w.first, k, len(win)))
    row, value = W.row_of(w.first, len(h))[at], win[at]
    rows, values = [row], [value]
    for m in range(1, k):
        few = np.flatnonzero(w.counts == m)
        if len(few):
            rows.append(few)
            values.append(W.mix(W.window_hashes(h, m)[w.first[few]], 16 + m))
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return row, value, np.searchsorted(row, np.arange(len(off)))


def _required(n, percent: int):
    """Least overlap that a set of n needs with any linked set: ceil(t n)."""
    return -(-percent * n // 100)


def _slack(n):
    return n // 16 + 1


def _prefix(n, percent: int):
    return np.minimum(n, n - _required(n, percent) + _slack(n))


def _set_keys(value: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    out = []
    for seed in (5, 6):
        c = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(W.mix(value, seed), out=c[1:])
        out.append(pa.array((c[first[1:]] - c[first[:-1]]).astype(np.int64)))
    return out


def set_sizes(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n, key1, key2``: set size and a 128-bit key of the set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in W.slices(batches, "text"):
            _, value, first = shingle_sets(batch.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), *_set_keys(value, first)],
                ["doc_id", "n", "key1", "key2"])

    return docs.mapInArrow(run, f"doc_id {kind}, n long, key1 long, key2 long")


def _in_prefix(value: np.ndarray, row: np.ndarray, first: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """Whether each token is among the first ``length`` of its set under the hash order."""
    order = np.lexsort((W.mix(value, seed), row))
    out = np.empty(len(row), bool)
    out[order] = np.arange(len(row)) - first[row] < length[row]
    return out


def _tokens(classes: DataFrame, k: int, percent: int, prefix: bool) -> DataFrame:
    """``token, doc_id`` of the (packed) text that stands for each class: the prefix under
    the first hash order; or the whole set, with ``orders``, the bits of the further orders in
    whose prefix the token stands."""
    kind = classes.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in unpacked(batches):
            row, value, first = shingle_sets(batch.column("text"), k)
            n = np.diff(first)
            take = (np.array(_set_keys(value, first)[0]) == np.array(batch.column("key1")))[row]
            orders = np.zeros(len(row), np.int8)
            if prefix:
                take &= _in_prefix(value, row, first, _prefix(n, percent), _ORDER)
            else:
                for bit, seed in enumerate(_FURTHER):
                    orders |= (_in_prefix(value, row, first, n - _required(n, percent) + 1, seed) << bit).astype(np.int8)
            columns = [pa.array(value[take].astype(np.int64)), batch.column("doc_id").take(pa.array(row[take]))]
            if not prefix:
                columns.append(pa.array(orders[take]))
            yield pa.RecordBatch.from_arrays(columns, ["token", "doc_id", "orders"][:len(columns)])

    return classes.select("doc_id", "body", "key1").mapInArrow(
        run, f"token long, doc_id {kind}" + ", orders tinyint" * (not prefix))


def _shared(found: DataFrame) -> DataFrame:
    """``token, held``: the tokens that more than one class holds, and how many do."""
    return found.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")


def _candidates(docs: DataFrame, sizes: DataFrame, scratch: Scratch, k: int, percent: int
                ) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, alone, tokens, order0, order1, ...``: classes with tokens left after both
    filters, how many tokens nobody else has (first in the order of frequency), the tokens
    left, and the shared tokens of the prefix under each further order. And ``doc_id, body``
    of the classes that passed the first filter."""
    need = F.expr(f"cast(ceil({percent} * n / 100) as long)")
    slack = F.floor(need / 16) + 1  # of the smallest set that may link
    reps = (sizes.where("n > 0 and doc_id is not null").groupBy("key1", "key2", "n")
            .agg(F.min("doc_id").alias("doc_id")))
    # both joins on doc_id plan the same exchange of the packed texts
    whole = packed(docs.where("doc_id is not null and text is not null")).where("doc_id is not null")
    found = _tokens(whole.join(reps, "doc_id"), k, percent, prefix=True)
    first = (found.join(_shared(found).select("token"), "token").groupBy("doc_id")
             .agg(F.count("*").alias("held")).join(reps, "doc_id").where(F.col("held") >= slack)
             .select("doc_id", "n", "key1"))
    passed = scratch.write("first-filter", whole.join(first, "doc_id").select("doc_id", "n", "key1", "body"))
    found = _tokens(passed, k, percent, prefix=False)
    further = [F.expr(f"transform(filter(held, x -> x.orders & {1 << bit} <> 0), x -> x.token)").alias(f"order{bit}")
               for bit in range(len(_FURTHER))]
    lists = (found.join(_shared(found), "token").groupBy("doc_id")
             .agg(F.array_sort(F.collect_set(F.struct("held", "token", "orders"))).alias("held"))
             .join(passed.select("doc_id", "n"), "doc_id")
             .withColumn("left", (F.size("held") - need + 1).cast("int")).where("left > 0")
             .select("doc_id", "n", (F.col("n") - F.size("held")).alias("alone"),
                     F.expr("transform(slice(held, 1, left), x -> x.token)").alias("tokens"), *further))
    return scratch.write("candidates", lists), passed.select("doc_id", "body")


def _agreeing(pairs: DataFrame, cand: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose prefixes share a token under every further order."""
    names = [f"order{bit}" for bit in range(len(_FURTHER))]
    side = lambda c: cand.select(F.col("doc_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in names])
    all_ = F.lit(True)
    for x in names:
        all_ = all_ & F.arrays_overlap(f"{x}_u", f"{x}_v")
    return pairs.join(side("u"), "u").join(side("v"), "v").where(all_).select("u", "v")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose sets reach the similarity."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    a = texts.select(F.col("doc_id").alias("u"), F.col("body").alias("body_u"))
    b = texts.select(F.col("doc_id").alias("v"), F.col("body").alias("body_v"))

    def run(batches):
        for batch in unpacked(batches, columns=("body_u", "body_v")):
            _, x, fx = shingle_sets(batch.column("text_u"), k)
            _, y, fy = shingle_sets(batch.column("text_v"), k)
            ok = [_linked(x[fx[i]:fx[i + 1]], y[fy[i]:fy[i + 1]], percent)
                  for i in range(batch.num_rows)]
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("u").take(at), batch.column("v").take(at)],
                                             ["u", "v"])

    return (pairs.join(a, "u").join(b, "v").select("u", "v", "body_u", "body_v")
            .mapInArrow(run, f"u {kind}, v {kind}"))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _pairs(a: str, b: str) -> list[F.Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def class_components(cand: DataFrame, texts: DataFrame, scratch: Scratch, k: int, percent: int) -> DataFrame:
    """``node, root`` of the candidate classes that link with another."""
    held = cand.select("doc_id", "n", "alone", F.posexplode("tokens").alias("at", "token")).select(
        "doc_id", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("rest"), "token")
    # sizes, and what is left from this place on, must allow the overlap
    fits = F.expr(f"{percent} * n <= 100 * m and {percent} * m <= 100 * n and "
                  f"{100 + percent} * least(rest, near_rest) >= {percent} * (n + m)")
    hubs = held.groupBy("token").agg(F.min(F.struct("doc_id", "n", "rest")).alias("hub")).select(
        "token", F.col("hub.doc_id").alias("hub"), F.col("hub.n").alias("m"), F.col("hub.rest").alias("near_rest"))
    stars = held.join(hubs, "token").where((F.col("doc_id") != F.col("hub")) & fits).select(
        *_pairs("doc_id", "hub")).distinct()
    stars = scratch.write("star-pairs", _agreeing(stars, cand))
    links = scratch.write("star-links", _verified(stars, texts, k, percent))
    roots = scratch.write("star-roots", components(links))

    at = held.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "token", "doc_id", "n", "rest", F.coalesce("root", "doc_id").alias("root"))
    per_root = at.groupBy("token", "root").agg(F.count("*").alias("size"))
    main = (per_root.groupBy("token").agg(F.max_by("root", "size").alias("main"),
                                          F.count("*").alias("roots")).where("roots > 1")
            .select("token", "main"))
    mixed = scratch.write("mixed-tokens", at.join(main, "token"))
    other = mixed.where("root <> main")
    rest = (other.join(mixed.select("token", F.col("doc_id").alias("near"), F.col("n").alias("m"),
                                    F.col("rest").alias("near_rest"), F.col("root").alias("near_root")), "token")
            .where((F.col("root") != F.col("near_root")) & fits)
            .select(*_pairs("doc_id", "near")).distinct()
            .join(stars, ["u", "v"], "left_anti"))
    rest = scratch.write("rest-pairs", _agreeing(rest, cand))
    scratch.drop("mixed-tokens", "star-pairs", "candidates")
    more = scratch.write("rest-links", _verified(rest, texts, k, percent))
    scratch.drop("rest-pairs", "first-filter")
    roots = scratch.write("roots", components(links.union(more)))
    scratch.drop("star-links", "star-roots", "rest-links")
    return roots


def jaccard_join(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    bounded_batches(docs.sparkSession)
    plain = docs.select("doc_id", "text")
    scratch = Scratch(docs.sparkSession)
    sizes = scratch.write("set-sizes", set_sizes(plain, k))
    cand, texts = _candidates(plain, sizes, scratch, k, percent)
    roots = class_components(cand, texts, scratch, k, percent).withColumnRenamed("node", "class_id")
    classes = (sizes.where("doc_id is not null").groupBy("key1", "key2", "n")
               .agg(F.min("doc_id").alias("class_id")).join(roots, "class_id", "left")
               .select("key1", "key2", "n", F.coalesce("root", "class_id").alias("root")))
    named = sizes.join(classes, ["key1", "key2", "n"], "left")
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), None).when(F.col("n") == 0, F.col("doc_id"))
        .otherwise(F.col("root")).alias("component_id"))
