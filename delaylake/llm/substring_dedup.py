"""Substring dedup by De Bruijn compaction.

Every ``k`` consecutive words of a document are an edge of the De Bruijn graph (its nodes are
the k-1 words shared by neighbours). A word is removed when it lies in a window whose words
also start earlier: in a document of smaller doc_id, or before in the same document.

1. Copies. Documents of equal text collapse to the one of smallest id; each copy's windows
   all start earlier, so it needs no graph.
2. Anchors. Of each window only its least 5-gram hash is shuffled (about one word in nine).
   Equal windows have equal anchors, so only windows whose anchor stands in two documents
   can repeat; the others never become edges.
3. Edges. One row per candidate window and document: hash, place, and a hash of its
   neighbours in the path. An aggregate with a map-side part gives each edge its first
   document and place, and whether all its occurrences have the same neighbours.
4. Compaction. Neighbouring unbranched edges of one first document are one path, found by
   place; a branching edge is a path of its own. Every occurrence of a path starts with its
   head, so joining the edges to the heads alone yields all repeated spans.
5. Verification. The span's words at its source coordinates and at each occurrence must have
   the same 128-bit digest, else nothing is removed there.

Repeats inside a document are found by the document's own windows and compared word by word
with the window they repeat. All joins on doc_id read
the same exchange of the texts; a hot edge or anchor is pre-aggregated and its join side is
an ordinary exchange that adaptive execution splits.

Defined results: null and empty texts have no words and lose none; rows without doc_id are
judged by themselves and are no source for others; repeated rows (same doc_id and text) are
one document and each is returned; different texts of one doc_id are documents of their own,
in the order of a hash of the text (their ids are then compared with that hash); texts shorter than ``k`` words lose nothing; other columns
are never read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches, packed, schema_ddl, unpacked

K = 20
GRAM = 5


def _words(batch: pa.RecordBatch) -> tuple[W.Words, np.ndarray]:
    w = W.split_words(*W.text_bytes(batch.column("text")))
    return w, W.word_hashes(w)


def _anchors(w: W.Words, h: np.ndarray, k: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Least gram hash of every window, and the windows that lie in one row."""
    least, span, want = W.window_hashes(h, gram), 1, k - gram + 1
    while span < want:
        step = min(span, want - span)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        span += step
    return least, np.flatnonzero(W.window_mask(w.first, k, len(least)))


def _firsts(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Of each (row, value) the index of the first equal one."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return out


def _repeats_inside(w: W.Words, at: np.ndarray, row: np.ndarray, win: np.ndarray, k: int) -> np.ndarray:
    """Windows (of those at ``at``) whose words stand earlier in the row, compared word by word:
    a run of neighbours that repeats a run of neighbours is compared in one piece."""
    first = at[_firsts(row[at], win[at])]
    again, source = at[first != at], first[first != at]
    if not len(again):
        return again
    breaks = np.flatnonzero((np.diff(again) != 1) | (np.diff(source) != 1)) + 1
    good = np.ones(len(again), bool)
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(again)]):
        p, q, n = int(again[a]), int(source[a]), b - a
        if w.text(p, p + n + k - 1) != w.text(q, q + n + k - 1):
            good[a:b] = [w.text(p + i, p + i + k) == w.text(q + i, q + i + k) for i in range(n)]
    return again[good]


def _distinct(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Indices of the first of each (row, value)."""
    order = np.lexsort((value, row))  # stable: equal ones stay in place order
    r, v = row[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.sort(order[new])


def _digest(w: W.Words, a: int, b: int) -> bytes:
    return hashlib.blake2b(w.text(a, b), digest_size=16).digest()


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id, copy_key`` of the documents whose text an earlier document has."""
    ids = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("copy_key"))
    first = ids.groupBy("copy_key").agg(F.min("doc_id").alias("first_id"))
    return (ids.join(first, "copy_key").where("doc_id <> first_id")
            .groupBy("doc_id").agg(F.min("copy_key").alias("copy_key")))


def repeated_anchors(docs: DataFrame, copied: DataFrame, k: int, gram: int) -> DataFrame:
    """``doc_id, anchors``: those of its anchors that another document has too. ``docs`` is
    ``packed``, here and below, but for ``copies``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in unpacked(batches):
            w, h = _words(batch)
            least, at = _anchors(w, h, k, gram)
            row, v = W.row_of(w.first, len(h))[at], least[at]
            new = np.ones(len(v), bool)
            new[1:] = (row[1:] != row[:-1]) | (v[1:] != v[:-1])
            row, v = row[new], v[new]
            one = _distinct(row, v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[one].astype(np.int64)), batch.column("doc_id").take(pa.array(row[one]))],
                ["anchor", "doc_id"])

    found = (docs.join(copied, "doc_id", "left").where("copy_key is null")
             .mapInArrow(run, f"anchor long, doc_id {kind}"))
    shared = found.groupBy("anchor").agg(F.count("*").alias("held")).where("held > 1").select("anchor")
    return found.join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))


def edges(docs: DataFrame, copied: DataFrame, k: int, gram: int) -> DataFrame:
    """``edge, doc_id, pos, around``: the windows with a repeated anchor, the first of equal
    ones in a document; ``around`` hashes the neighbouring edges in the document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in unpacked(batches):
            w, h = _words(batch)
            least, at = _anchors(w, h, k, gram)
            marks = np.unique(np.concatenate(
                [np.zeros(0, np.int64), *(np.array(x, np.int64) for x in
                                          batch.column("anchors").to_pylist() if x)])).astype(np.uint64)
            at = at[np.isin(least[at], marks)]
            win, row = W.window_hashes(h, k), W.row_of(w.first, len(h))
            at = at[_distinct(row[at], win[at])]
            line = np.zeros(len(win) + 2, np.uint64)
            line[at + 1] = win[at]
            around = W.mix(W.mix(line[at], 2) + line[at + 2], 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(win[at].astype(np.int64)), batch.column("doc_id").take(pa.array(row[at])),
                 pa.array(at - w.first[row[at]], pa.int32()), pa.array(around.astype(np.int64))],
                ["edge", "doc_id", "pos", "around"])

    return (docs.join(repeated_anchors(docs, copied, k, gram), "doc_id")
            .mapInArrow(run, f"edge long, doc_id {kind}, pos int, around long"))


def paths(docs: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Compacted unbranched paths of repeated edges: ``head`` edge, number of edges ``n``,
    source coordinates and the digest of the source's words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    repeated = (found.groupBy("edge").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("pos", "doc_id").alias("pos"),
        F.count("*").alias("held"), (F.min("around") == F.max("around")).alias("unbranched"))
        .where("held > 1").drop("held"))
    by_place = Window.partitionBy("doc_id").orderBy("pos")
    joined = (F.col("unbranched") & F.lag("unbranched").over(by_place)
              & (F.lag("pos").over(by_place) == F.col("pos") - 1))
    path = F.sum(F.when(joined, 0).otherwise(1)).over(by_place)
    compact = (repeated.withColumn("path", path).groupBy("doc_id", "path")
               .agg(F.min("pos").alias("pos"), F.count("*").cast("int").alias("n"),
                    F.min_by("edge", "pos").alias("head"))
               .groupBy("doc_id").agg(F.collect_list(F.struct("head", "pos", "n")).alias("paths")))

    def run(batches):
        for batch in unpacked(batches):
            w = W.split_words(*W.text_bytes(batch.column("text")))
            out = []
            for i, (doc, ps) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                              batch.column("paths").to_pylist())):
                for p in ps:
                    a = int(w.first[i]) + p["pos"]
                    b = min(a + p["n"] + k - 1, int(w.first[i + 1]))
                    out.append((p["head"], p["n"], doc, p["pos"], _digest(w, a, b)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("head", "n", "source_id", "source_pos", "digest"), x)) for x in out],
                pa.schema([("head", pa.int64()), ("n", pa.int32()),
                           ("source_id", batch.schema.field("doc_id").type),
                           ("source_pos", pa.int32()), ("digest", pa.binary())]))

    return (docs.join(compact, "doc_id")
            .mapInArrow(run, f"head long, n int, source_id {kind}, source_pos int, digest binary"))


def repeated_spans(docs: DataFrame, copied: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """Of packed documents and their ``copies``: ``doc_id, pos, n, source_id, source_pos, digest``: the ``n + k - 1`` words from ``pos``
    repeat those at the source coordinates, if their digest agrees."""
    found = edges(docs, copied, k, gram)
    return (found.select("edge", "doc_id", "pos")
            .join(paths(docs, found, k).withColumnRenamed("head", "edge"), "edge")
            .where("doc_id <> source_id")
            .select("doc_id", "pos", "n", "source_id", "source_pos", "digest"))


def substring_dedup(docs: DataFrame, k: int = K, gram: int = GRAM,
                    with_text: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the columns ``carry``, n_words, n_removed, kept_sha256 and, if asked
    for, kept_text (the kept words joined by one space, or the text as it was if none went;
    null for a null text)."""
    bounded_batches(docs.sparkSession)
    plain = docs.select("doc_id", "text", *carry)
    whole = plain.where("doc_id is not null and text is not null")
    hashes = whole.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    several = not hashes.where("low <> high").isEmpty()
    if several:      # ids get a hash of the text beside them
        pair = F.struct("doc_id", F.xxhash64("text").alias("h"))
        plain = plain.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), pair))
        whole = plain.where("doc_id is not null and text is not null")
    names = ["doc_id", *carry, "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text]

    def cut(batches):
        for batch in batches:
            w, h = _words(batch)
            win, row = W.window_hashes(h, k), W.row_of(w.first, len(h))
            at = np.flatnonzero(W.window_mask(w.first, k, len(win)))
            again = _repeats_inside(w, at, row, win, k)
            delta = np.zeros(len(h) + 1, np.int32)
            np.add.at(delta, again, 1)
            np.add.at(delta, again + k, -1)
            raw = [t.encode() for t in batch.column("text").to_pylist()]
            keys = batch.column("copy_key").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                a, b = int(w.first[i]), int(w.first[i + 1])
                if keys[i] is not None and b - a >= k and hashlib.sha256(raw[i]).digest() == keys[i]:
                    delta[a] += 1
                    delta[b] -= 1
                    continue
                for s in spans or ():
                    c, d = a + s["pos"], a + s["pos"] + s["n"] + k - 1
                    if d <= b and _digest(w, c, d) == s["digest"]:
                        delta[c] += 1
                        delta[d] -= 1
            kept = np.cumsum(delta[:-1]) == 0
            gone = np.concatenate([[0], np.cumsum(~kept)])
            n_gone = gone[w.first[1:]] - gone[w.first[:-1]]
            texts = []
            for i, t in enumerate(raw):
                ws = t.split()
                if n_gone[i]:
                    ws = compress(ws, kept[w.first[i]:w.first[i + 1]].tolist())
                texts.append(b" ".join(ws))
            cols = [batch.column("doc_id"), *(batch.column(c) for c in carry),
                    pa.array(w.counts, pa.int64()), pa.array(n_gone, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
            if with_text:
                cols.append(pa.array([t if gone_ else r for t, r, gone_ in zip(texts, raw, n_gone)],
                                     pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names)

    span = F.struct("pos", "n", "digest")
    # (said again after packing, so that inner and outer joins plan the same exchange)
    copied, bodies = copies(whole), packed(whole).where("doc_id is not null")
    spans = repeated_spans(bodies, copied, k, gram).groupBy("doc_id").agg(F.collect_list(span).alias("spans"))
    schema = schema_ddl(plain.drop("text"), "n_words long, n_removed long, kept_sha256 string"
                        + ", kept_text string" * with_text)
    joined = bodies.join(copied, "doc_id", "left").join(spans, "doc_id", "left")
    rest = plain.where("doc_id is null and text is not null").select(
        "*", F.lit(None).cast("binary").alias("copy_key"),
        F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    blank = plain.where("text is null").select(
        "doc_id", *carry, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"),
        *[F.lit(None).cast("string").alias("kept_text")] * with_text)
    out = (joined.mapInArrow(lambda it: cut(unpacked(it)), schema)
           .union(rest.mapInArrow(lambda it: cut(W.slices(it, "text")), schema)).union(blank))
    return out.withColumn("doc_id", F.col("doc_id.doc_id")) if several else out
