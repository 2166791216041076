"""Benchmark decontamination: hash set of normalised test n-grams, scanned over token
windows of the training documents.

Words are lower-cased (A-Z) runs of digits, letters a-z and non-ASCII characters. A test
window is ``n`` consecutive words of an item; an item of fewer words, but not none, is one
window. The set of window hashes is broadcast while its size stays under
``max_broadcast_windows`` (checked before it is fetched); beyond that the windows of the
documents are joined to it by a shuffle. Every hash hit is compared word by word.

Defined results: null and empty texts have no words and are clean; null item ids and item
texts add no windows; documents may repeat or have null ids (each row is judged by itself);
with an empty benchmark nothing is hit; other columns, whatever their names, are kept out
of the way and never read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches, schema_ddl

N_WORDS = 13
SHARE_PERCENT = 5
MAX_BROADCAST_WINDOWS = 2_000_000


def _normalised(texts) -> W.Words:
    data, off = W.text_bytes(texts)
    return W.split_words(W.LOWER[data], off, W.ALNUM)


def benchmark_windows(benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """One row per distinct (window text, item): its hash, length in words and item id."""

    def windows(batches):
        for batch in W.slices(batches, "text"):
            w = _normalised(batch.column("text"))
            h, ids = W.word_hashes(w), batch.column("item_id").to_pylist()
            out: list[tuple] = []
            for i, item in enumerate(ids):
                a, b = int(w.first[i]), int(w.first[i + 1])
                k = min(n, b - a)
                if item is None or k == 0:
                    continue
                for p, v in enumerate(W.window_hashes(h[a:b], k)):
                    out.append((int(v.astype(np.int64)), k, w.text(a + p, a + p + k), str(item)))
            cols = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                   pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())],
                                  ["hash", "len", "gram", "item"])

    return (benchmark.select("item_id", "text").where("text is not null")
            .mapInArrow(windows, "hash long, len int, gram binary, item string").distinct())


class GramSet:
    """Sorted hashes per window length, behind a 2^20-bit table that most windows fail."""

    def __init__(self, rows):
        by_len = defaultdict(lambda: defaultdict(set))
        self.grams = defaultdict(set)
        for r in rows:
            by_len[r["len"]][r["hash"]].add(r["item"])
            self.grams[(r["len"], r["hash"], bytes(r["gram"]))].add(r["item"])
        self.lens = {}
        for k, v in by_len.items():
            hs = np.sort(np.array(list(v), np.int64).astype(np.uint64))
            bits = np.zeros(1 << 20, bool)
            bits[hs >> np.uint64(44)] = True
            self.lens[k] = (hs, bits)

    def find(self, w: W.Words, h: np.ndarray):
        """(first word, length, items) of every verified occurrence."""
        for k, (hs, bits) in self.lens.items():
            win = W.window_hashes(h, k)
            at = np.flatnonzero(bits[win >> np.uint64(44)])
            if not len(at):
                continue
            v = win[at]
            j = np.minimum(np.searchsorted(hs, v), len(hs) - 1)
            at = at[hs[j] == v]
            at = at[W.window_mask(w.first, k, len(win))[at]]
            for p in at.tolist():
                items = self.grams.get((k, int(win[p].astype(np.int64)), w.text(p, p + k)))
                if items:
                    yield p, k, items


_RESULT = ("n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, "
           "contaminated boolean")


def _verdicts(w: W.Words, found, share_percent: int) -> list[pa.Array]:
    n, rows = len(w.starts), len(w.first) - 1
    d = np.zeros(n + 1, np.int32)
    items: dict[int, set] = defaultdict(set)
    where, what = [], []
    for p, k, names in found:
        d[p] += 1
        d[p + k] -= 1
        where.append(p)
        what.append(names)
    for i, names in zip(np.searchsorted(w.first, where, "right") - 1, what):
        items[int(i)] |= names
    hit = np.concatenate([[0], np.cumsum(np.cumsum(d[:n]) > 0)])
    n_hit = hit[w.first[1:]] - hit[w.first[:-1]]
    names = [sorted(items.get(i, ())) for i in range(rows)]
    return [pa.array(w.counts, pa.int64()), pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in names], pa.int64()), pa.array(names, pa.list_(pa.string())),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
            pa.array((n_hit > 0) & (100 * n_hit >= share_percent * w.counts), pa.bool_())]


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS,
                  share_percent: int = SHARE_PERCENT,
                  max_broadcast_windows: int = MAX_BROADCAST_WINDOWS,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Returns ``doc_id, text`` and the columns ``carry`` with n_words, n_hit (words inside an occurring window),
    n_items, items (sorted ids), items_sha256 and contaminated (at least
    ``share_percent`` of the words are hit)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    grams = benchmark_windows(benchmark, n)
    rows = grams.limit(max_broadcast_windows + 1).collect()
    if len(rows) > max_broadcast_windows:
        return _by_shuffle(docs, grams, share_percent, carry)
    shared = spark.sparkContext.broadcast(rows)
    cache: list[GramSet] = []

    def scan(batches):
        if not cache:
            cache.append(GramSet(shared.value))
        for batch in W.slices(batches, "text"):
            w = _normalised(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *_verdicts(w, cache[0].find(w, W.word_hashes(w)), share_percent)],
                [*batch.schema.names, *(c.split()[0] for c in _RESULT.split(", "))])

    plain = docs.select("doc_id", "text", *carry)
    return plain.mapInArrow(scan, schema_ddl(plain, _RESULT))


def _found_by_shuffle(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``docs`` (with a text) and ``found``, the verified occurrences (first word, length, item)
    in each text, for a benchmark beyond the broadcast bound: the hashes of the documents'
    windows are joined to those of the set; the words of the hits alone are compared. What is
    gathered per text is bounded by its length."""
    bounded_batches(docs.sparkSession)
    plain = docs.withColumn("text_key", F.sha2("text", 256))
    lens = [r["len"] for r in grams.select("len").distinct().collect()]  # 1 to n

    def windows(batches):
        for batch in W.slices(batches, "text"):
            w = _normalised(batch.column("text"))
            h = W.word_hashes(w)
            row = W.row_of(w.first, len(h))
            for k in lens:
                win = W.window_hashes(h, k)
                at = np.flatnonzero(W.window_mask(w.first, k, len(win)))
                for part in np.array_split(at, max(1, len(at) // 50_000)):
                    yield pa.record_batch(
                        [batch.column("text_key").take(pa.array(row[part])),
                         pa.array(part - w.first[row[part]], pa.int64()),
                         pa.array(np.full(len(part), k), pa.int32()),
                         pa.array(win[part].astype(np.int64))],
                        ["text_key", "pos", "len", "hash"])

    distinct = plain.where("text is not null").groupBy("text_key").agg(F.first("text").alias("text"))
    hits = (distinct.mapInArrow(windows, "text_key string, pos long, len int, hash long")
            .join(grams, ["hash", "len"])
            .groupBy("text_key").agg(F.collect_list(F.struct("pos", "len", "item", "gram")).alias("hits")))
    occurrence = "array<struct<pos:long,len:int,item:string>>"

    def verify(batches):
        for batch in W.slices(batches, "text"):
            w = _normalised(batch.column("text"))
            out = []
            for i, hs in enumerate(batch.column("hits").to_pylist()):
                a = int(w.first[i])
                out.append([{"pos": x["pos"], "len": x["len"], "item": x["item"]} for x in hs
                            if w.text(a + x["pos"], a + x["pos"] + x["len"]) == bytes(x["gram"])])
            kind = pa.list_(pa.struct([("pos", pa.int64()), ("len", pa.int32()), ("item", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(out, kind)], ["text_key", "found"])

    found = distinct.join(hits, "text_key").mapInArrow(verify, f"text_key string, found {occurrence}")
    return plain.join(found, "text_key", "left").drop("text_key")


def _by_shuffle(docs: DataFrame, grams: DataFrame, share_percent: int,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """``decontaminate`` by ``_found_by_shuffle``."""
    plain = docs.select("doc_id", "text", *carry)

    def apply(batches):
        for batch in W.slices(batches, "text"):
            w = _normalised(batch.column("text"))
            hits = [(int(w.first[i]) + f["pos"], f["len"], {f["item"]})
                    for i, fs in enumerate(batch.column("found").to_pylist()) for f in fs or ()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *_verdicts(w, hits, share_percent)],
                [*batch.schema.names[:-1], *(c.split()[0] for c in _RESULT.split(", "))])

    return (_found_by_shuffle(plain, grams).select("doc_id", "text", *carry, "found")
            .mapInArrow(apply, schema_ddl(plain, _RESULT)))


def _without(data: np.ndarray, begin: int, end: int, w: W.Words, spans: list[tuple[int, int]]) -> str:
    """Bytes [begin, end) of a text without those of the words [a, b) of each span."""
    kept, pos = [], begin
    for a, b in sorted(spans):
        s, e = int(w.starts[a]), int(w.ends[b - 1])
        kept.append(data[pos:max(s, pos)].tobytes())
        pos = max(pos, e)
    return b"".join([*kept, data[pos:end].tobytes()]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS,
                 max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Documents with the bytes of hit words cut out (``doc_id, text``)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    plain = docs.select("doc_id", "text")
    grams = benchmark_windows(benchmark, n)
    rows = grams.limit(max_broadcast_windows + 1).collect()
    whole = len(rows) <= max_broadcast_windows
    shared = spark.sparkContext.broadcast(rows if whole else [])
    cache: list[GramSet] = []

    def spans_of(batch, w):
        at = defaultdict(list)
        if whole:
            if not cache:
                cache.append(GramSet(shared.value))
            for p, k, _ in cache[0].find(w, W.word_hashes(w)):
                at[int(np.searchsorted(w.first, p, "right")) - 1].append((p, p + k))
        else:
            for i, fs in enumerate(batch.column("found").to_pylist()):
                a = int(w.first[i])
                if fs:
                    at[i] = [(a + f["pos"], a + f["pos"] + f["len"]) for f in fs]
        return at

    def cut(batches):
        for batch in W.slices(batches, "text"):
            data, off = W.text_bytes(batch.column("text"))
            w = _normalised(batch.column("text"))
            texts = batch.column("text").to_pylist()
            for i, spans in spans_of(batch, w).items():
                texts[i] = _without(data, int(off[i]), int(off[i + 1]), w, spans)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    source = plain if whole else _found_by_shuffle(plain, grams).select("doc_id", "text", "found")
    return source.mapInArrow(cut, plain.schema)
