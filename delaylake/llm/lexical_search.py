"""Ranked lexical search, accumulator-limited and term at a time.

The documents are indexed once for the terms of the queries: per document its length and the
query terms in it with their counts. Documents are then ranked where they lie. A task takes a
block of documents, turns it into posting lists, and works off each query's terms, the rarest
in the whole corpus first, in an array of accumulators (a partial score per document of the
block). A term's bound is its weight times the largest impact that it has in any document.
Once the bounds of the terms that remain add to less than the k-th best score so far, no
document without an accumulator can reach it: no more are created, and the remaining, commoner
terms only update the survivors, whose scores end up exact.

The k-th best so far is the largest of three: among the partial scores of the block, among the
finished ones of the task's earlier blocks, and of a first pass over a sixteenth of the
documents (whose k-th best is no more than that of all). The last keeps what tasks send small:
about 16 k rows a query in all, whatever their number.

Scores are integers, so results do not depend on blocks or order. Terms match by hash, then
byte by byte. A query's terms and the statistics of a group of queries (``GROUP_BYTES`` of
terms) are broadcast; more queries take more groups, one pass over the documents each.

Defined results: every row is a document, repeated ones too (equal scores by doc_id, those
without doc_id last, equal rows in any order); null and empty texts have no terms, are not
counted and never returned; the terms of a repeated item_id are united, rows without item_id
are no queries; a query without a known term returns nothing. Other columns are never read.
Memory follows the longest text and the longest query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import Scratch, bounded_batches

TOP = 50
GROUP_BYTES = 16 << 20   # of distinct (query, term) pairs: bytes of terms, and 16 for each pair
BLOCK_POSTINGS = 1 << 21
SEED = 16                # the first pass ranks the documents whose hash is divisible by this
# Characters of terms: digits, letters a-z (after lower-casing A-Z) and all beyond ASCII.
_MEMBERS = W.ALNUM


def query_terms(queries: DataFrame, id_column: str) -> DataFrame:
    """``item, term``: the distinct terms of every query."""
    kind = queries.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in W.slices(batches, "text"):
            data, off = W.text_bytes(batch.column("text"))
            w = W.split_words(W.LOWER[data], off, _MEMBERS)
            row = W.row_of(w.first, len(w.starts))
            terms = [w.text(i, i + 1).decode() for i in range(len(w.starts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").take(pa.array(row)), pa.array(terms, pa.string())], ["item", "term"])

    plain = queries.select(F.col(id_column).alias("item"), "text").where("item is not null and text is not null")
    return plain.mapInArrow(run, f"item {kind}, term string").distinct()


class Vocabulary:
    """The terms of a group of queries as sorted hashes and their bytes."""

    def __init__(self, terms: list[str]):
        text = pa.array(terms, pa.string())
        data, off = W.text_bytes(text)
        # one word a row, so every term is one run
        words = W.Words(data, off, off[:-1], off[1:], np.arange(len(off)))
        h = W.word_hashes(words)
        self.order = np.argsort(h, kind="stable")
        self.hashes = h[self.order]
        self.data, self.starts, self.lens = data, off[:-1], np.diff(off)
        same = np.unique(self.hashes, return_counts=True)[1] if len(h) else np.ones(1, np.int64)
        self.most = int(same.max())

    def find(self, w: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that are terms, and which ones."""
        if not len(w.starts) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = W.word_hashes(w)
        first = np.searchsorted(self.hashes, h)
        lens = w.ends - w.starts
        at, which = [], []
        for step in range(self.most):
            slot = np.minimum(first + step, len(self.hashes) - 1)
            p = np.flatnonzero(self.hashes[slot] == h)
            t = self.order[slot[p]]
            fits = self.lens[t] == lens[p]
            p, t = p[fits], t[fits]
            ends = np.cumsum(lens[p])
            inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lens[p], lens[p])
            differs = (w.data[np.repeat(w.starts[p], lens[p]) + inside]
                       != self.data[np.repeat(self.starts[t], lens[p]) + inside])
            bad = np.zeros(len(p), bool)
            bad[np.repeat(np.arange(len(p)), lens[p])[differs]] = True
            at.append(p[~bad])
            which.append(t[~bad])
        return np.concatenate(at), np.concatenate(which)


def indexed(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id, n, terms, counts`` of every row with a term: its length in terms, the query
    terms in it and how often they stand there. ``vocabulary`` is broadcast."""

    def run(batches):
        own = vocabulary.value
        size = max(1, len(own.lens))
        for batch in W.slices(batches, "text"):
            data, off = W.text_bytes(batch.column("text"))
            w = W.split_words(W.LOWER[data], off, _MEMBERS)
            at, which = own.find(w)
            row = np.searchsorted(w.first, at, "right") - 1
            pairs, counts = np.unique(row * size + which, return_counts=True)
            ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size)
            some = pa.array(np.flatnonzero(w.counts > 0))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v.astype(np.int32)))
                     for v in (pairs % size, counts)]
            yield pa.RecordBatch.from_arrays(
                [c.take(some) for c in (batch.column("doc_id"), pa.array(w.counts, pa.int64()), *lists)],
                ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


@dataclass
class Postings:
    """A block of documents: per posting its document (row of the block) and impact, by term."""

    docs: np.ndarray
    impact: np.ndarray
    first: np.ndarray

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first[term], self.first[term + 1]
        return self.docs[a:b], self.impact[a:b]


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 50 + (50 * n * N) div L."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 62:
        return np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 50 + 50 * n * n_docs // max(1, n_terms)


def impacts(count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * count // (1000 * count + 20 * norm)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def postings(batch, n_docs: int, n_terms: int, size: int) -> Postings:
    lists = batch.column("terms")
    terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = batch.column("n").to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), lists.value_lengths().to_numpy(zero_copy_only=False))
    impact = impacts(counts, length_norm(n, n_docs, n_terms)[row])
    order = np.argsort(terms, kind="stable")
    return Postings(row[order], impact[order], np.searchsorted(terms[order], np.arange(size + 1)))


class Accumulators:
    """Partial scores of one query at a time over a block of documents."""

    def __init__(self, n: int):
        self.score = np.zeros(n, np.int64)
        self.made = np.zeros(n, bool)

    def run(self, terms, weights, bounds, block: Postings, k: int, least: int) -> np.ndarray:
        """Rows of the block that have an accumulator in the end, with exact scores in
        ``score``. ``terms`` rarest first; ``least`` is a k-th best score known before."""
        remaining = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
        creating, best = True, 0
        for i, t in enumerate(terms):
            if creating and remaining[i] < max(least, best):
                creating = remaining[i] >= max(least, self._kth(k))
            docs, impact = block.of(t)
            gain = weights[i] * impact
            if not creating:
                old = self.made[docs]
                docs, gain = docs[old], gain[old]
            elif weights[i]:
                self.made[docs] = True
            if len(docs):
                self.score[docs] += gain
                best = max(best, int(self.score[docs].max()))
        return np.flatnonzero(self.made)

    def _kth(self, k: int) -> int:
        live = self.score[self.made]
        return int(np.partition(live, len(live) - k)[len(live) - k]) if len(live) >= k else 0

    def clear(self, rows: np.ndarray) -> None:
        self.score[rows] = 0
        self.made[rows] = False


@dataclass
class Group:
    """What a group of queries is ranked with: the terms of each (rarest first), weights and
    bounds, the corpus's size and known k-th best scores."""

    items: list
    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    n_docs: int
    n_terms: int
    size: int
    least: np.ndarray


def _blocks(batches):
    """Batches put together up to a number of postings."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= BLOCK_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _best(score, missing, doc, k):
    """The first k by falling score, then doc_id (nulls last)."""
    if len(score) > 4 * k:
        enough = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        enough = np.arange(len(score))
    order = enough[np.lexsort((doc[enough], missing[enough], -score[enough]))[:k]]
    return score[order], missing[order], doc[order]


def ranked(index: DataFrame, group, k: int, kind: str) -> DataFrame:
    """``item, doc_id, score``: each task's best k documents of each query of the (broadcast)
    group, less those below a known k-th best."""

    def run(batches):
        g = group.value
        least = g.least.copy()
        top: list[tuple | None] = [None] * len(g.items)
        for table in _blocks(batches):
            if not table.num_rows:
                continue
            batch = table.to_batches()[0]
            block = postings(batch, g.n_docs, g.n_terms, g.size)
            ids = batch.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            live = Accumulators(batch.num_rows)
            for q in range(len(g.items)):
                a, b = g.first[q], g.first[q + 1]
                rows = live.run(g.terms[a:b], g.weights[a:b], g.bounds[a:b], block, k, int(least[q]))
                score = live.score[rows]
                good = (score > 0) & (score >= least[q])
                found = (score[good], missing[rows[good]], doc[rows[good]])
                live.clear(rows)
                if len(found[0]):
                    if top[q] is not None:
                        found = tuple(np.concatenate(p) for p in zip(top[q], found))
                    top[q] = _best(*found, k)
                    if len(top[q][0]) == k:
                        least[q] = max(least[q], top[q][0][-1])
        for q, found in enumerate(top):
            if found is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g.items[q]] * len(found[0])).cast(item_type),
                     pa.array(found[2], mask=found[1]), pa.array(found[0])], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    item_type = to_arrow_type(StructType.fromDDL(f"item {kind}")["item"].dataType)
    return index.mapInArrow(run, f"item {kind}, doc_id long, score long")


def _first_k(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query, in two steps, so that no task gathers all that tasks sent."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = found.withColumn("part", F.expr("pmod(xxhash64(doc_id), 32)"))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    part = part.where(F.col("rank") <= k).drop("rank", "part")
    whole = part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return whole.where(F.col("rank") <= k)


def _statistics(index: DataFrame, n_docs: int, n_terms: int, size: int) -> dict[int, tuple[int, int]]:
    """Of each query term that occurs: its document frequency and largest impact."""

    def run(batches):
        df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            p = postings(batch, n_docs, n_terms, size)
            here = np.flatnonzero(np.diff(p.first))
            df[here] += np.diff(p.first)[here]
            if len(here):
                most[here] = np.maximum(most[here], np.maximum.reduceat(p.impact, p.first[:-1][here]))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at]), pa.array(most[at])],
                                         ["term", "df", "most"])

    rows = (index.mapInArrow(run, "term long, df long, most long").groupBy("term")
            .agg(F.sum("df").alias("df"), F.max("most").alias("most")).collect())
    return {r["term"]: (r["df"], r["most"]) for r in rows}


def _grouped(pairs: list, stats: dict, ids: dict, n_docs: int, n_terms: int) -> Group:
    """Queries with their known terms, rarest first (equal ones in the order of the terms)."""
    by_item: dict = {}
    for item, term in pairs:
        if ids[term] in stats:
            by_item.setdefault(item, []).append((stats[ids[term]][0], term))
    items, terms, first = [], [], [0]
    for item, known in by_item.items():
        items.append(item)
        terms += [ids[t] for _, t in sorted(known)]
        first.append(len(terms))
    weights = [weight(n_docs, stats[t][0]) for t in terms]
    bounds = [w * stats[t][1] for w, t in zip(weights, terms)]
    return Group(items, np.array(first), np.array(terms, np.int64), np.array(weights, np.int64),
                 np.array(bounds, np.int64), n_docs, n_terms, len(ids), np.zeros(len(items), np.int64))


def _search_group(docs: DataFrame, pairs: list, k: int, kind: str, scratch: Scratch) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted({p["term"] for p in pairs})
    ids = {t: i for i, t in enumerate(terms)}
    index = scratch.write("index", indexed(docs, spark.sparkContext.broadcast(Vocabulary(terms))))
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    stats = _statistics(index, n_docs, n_terms, len(terms))
    group = _grouped([(p["item"], p["term"]) for p in pairs], stats, ids, n_docs, n_terms)
    some = index.where(F.expr(f"pmod(xxhash64(doc_id), {SEED}) = 0"))
    seeds = _first_k(ranked(some, spark.sparkContext.broadcast(group), k, kind), k)
    known = {r["item"]: r["score"] for r in seeds.where(F.col("rank") == k).collect()}
    group.least = np.array([known.get(item, 0) for item in group.items], np.int64)
    return scratch.write("ranked", _first_k(ranked(index, spark.sparkContext.broadcast(group), k, kind), k))


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_column: str = "item_id",
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every query."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    kind = queries.schema[id_column].dataType.simpleString()
    wanted = scratch.write("query-terms", query_terms(queries, id_column))
    total = wanted.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    groups = max(1, -(-2 * total // group_bytes)) if total > group_bytes else 1
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    found = []
    for i in range(groups):
        part = wanted.where(F.expr(f"pmod(xxhash64(item), {groups})") == i).orderBy("item", "term")
        found.append(_search_group(plain, part.collect(), k, kind, scratch))
        scratch.drop("index")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select(F.col("item").alias(id_column), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
