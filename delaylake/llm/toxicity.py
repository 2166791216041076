"""Toxicity: a linear-chain CRF tags toxic tokens; forward-backward marginals give document
scores and the offending offsets.

Fitting judges markers on all labelled texts, in Spark, and learns weights from a bounded sample
(``per_class`` documents and ``max_bytes`` of text for each label, distinct texts):

1. Markers. A word, or the first 4 or 6 bytes of words, marks toxic texts when it stands between
   different neighbours in toxic texts more often than their share of all tokens lets chance do:
   with b such places in toxic texts and g in others the likelihood ratio bounds the probability,
   and of all names of a kind the marks are chosen at a false discovery rate of ``FALSE_MARKS``
   (Benjamini and Hochberg). They stand in two toxic texts at least and ``MIN_LIFT`` times as
   often as in others, so that the plain words of a language with somewhat more toxic texts are
   none. The evidence needed does not grow with the table: rare wording counts by itself.
   (Places with the same neighbours, as in near copies, count once; equal texts too.) Tokens of
   toxic texts that are marked count as toxic, all others as clean.
2. The CRF, on the lines of the sample with a toxic token, those of the rarest marks first, and
   as many others, with the token, its neighbours, its beginnings, its ending and its length as
   features. Marks found in fewer than ``EXAMPLES`` places of the sample bring pieces of the
   texts that have them.
3. The document score: a logistic regression on the summed marginals and the largest one,
   against the documents' labels, its constant moved from the sample's share of toxic
   documents to that of all labelled ones.

Tokens are lower-cased runs of digits, letters a-z and non-ASCII characters; a sequence is a
line. Whole texts are tagged.

Defined results: null and empty texts have no token and the score of no toxic token; without
labels of both kinds every score is 0; equal rows get equal results; other columns are never
read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake.llm import crf
from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches, labelled_sample, packed, restored, staged, text_slices

PER_CLASS = 2000
MAX_BYTES = 5 << 20
MIN_LIFT = 5.0
FALSE_MARKS = 0.05
EXAMPLES = 8
FIT_LINES = 5000
_ID_BITS = 26
SPAN_AT = 0.5
_WORD_BITS, _NEAR_BITS, _END_BITS = 16, 12, 12
_STEMS = (4, 6)
_LENGTHS = (2, 4, 6, 9, 13)
_NEAR = 1 << _WORD_BITS
_END = _NEAR + 2 * (1 << _NEAR_BITS)
_STEM = _END + (1 << _END_BITS)
_LENGTH = _STEM + len(_STEMS) * (1 << _END_BITS)
N_FEATURES = _LENGTH + len(_LENGTHS) + 2


class Tokens:
    """Tokens of a slice's rows with their lines and features."""

    def __init__(self, texts):
        data, off = W.text_bytes(texts)
        data = W.LOWER[data]
        self.words = w = W.split_words(data, off, W.ALNUM)
        self.hashes = h = W.word_hashes(w)
        breaks = np.unique(np.concatenate([off[:-1], np.flatnonzero(data == 0x0A)]))
        bounds = np.unique(np.searchsorted(w.starts, np.append(breaks, len(data))))
        self.lines = bounds if len(h) else np.zeros(1, np.int64)
        if len(h) and (self.lines[0] != 0 or self.lines[-1] != len(h)):
            self.lines = np.unique(np.concatenate([[0], self.lines, [len(h)]]))
        first = np.zeros(len(h), bool)
        first[self.lines[:-1]] = True
        last = np.roll(first, -1)
        near = (W.mix(h, 31) >> np.uint64(64 - _NEAR_BITS)).astype(np.int64)
        before, after = np.roll(near, 1), np.roll(near, -1)
        before[first], after[last] = 0, 0
        tail = np.zeros(len(h), np.uint64)
        for back in (1, 2, 3):
            at = np.maximum(w.ends - back, w.starts)
            tail = tail * np.uint64(257) + data[at].astype(np.uint64) if len(h) else tail
        self.stems = []
        for size in _STEMS:
            stem = np.zeros(len(h), np.uint64)
            for j in range(size):
                at = np.minimum(w.starts + j, w.ends - 1)
                inside = w.starts + j < w.ends
                stem = stem * np.uint64(257) + np.where(inside, data[at] if len(h) else 0, 0).astype(np.uint64)
            self.stems.append(W.mix(stem, 33 + size))
        self.around = W.mix(np.where(first, 0, np.roll(h, 1)), 40) + W.mix(np.where(last, 0, np.roll(h, -1)), 41)
        ending = (W.mix(tail, 32) >> np.uint64(64 - _END_BITS)).astype(np.int64)
        self.slots = np.stack([
            (W.mix(h, 30) >> np.uint64(64 - _WORD_BITS)).astype(np.int64),
            _NEAR + before, _NEAR + (1 << _NEAR_BITS) + after, _END + ending,
            *[_STEM + i * (1 << _END_BITS) + (x >> np.uint64(64 - _END_BITS)).astype(np.int64)
              for i, x in enumerate(self.stems)],
            _LENGTH + np.searchsorted(_LENGTHS, w.ends - w.starts, "left"),
            np.full(len(h), N_FEATURES - 1)], axis=1).astype(np.int32)


@dataclass
class Model:
    chain: crf.Chain
    score: np.ndarray

    def scores(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = _document_features(p, first)
        return 1 / (1 + np.exp(-np.clip(x @ self.score, -30, 30)))


def _document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(p)])
    total = total[first[1:]] - total[first[:-1]]
    most = np.zeros(len(first) - 1)
    some = np.diff(first) > 0
    if some.any():
        most[some] = np.maximum.reduceat(p, first[:-1][some])
    return np.stack([np.log1p(total), most, np.ones(len(most))], axis=1)


def _places(t: Tokens, kind: int, toxic: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """A token for each name of the kind, its neighbours and label (of ``keep`` only)."""
    name = (t.hashes, *t.stems)[kind]
    at = np.arange(len(name)) if keep is None else np.flatnonzero(np.isin(name, keep))
    n, c, r = name[at], t.around[at], toxic[at]
    order = np.lexsort((c, n, r))
    n, c, r = n[order], c[order], r[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (c[1:] != c[:-1]) | (r[1:] != r[:-1])
    return at[order[new]]


def _known_texts(docs: DataFrame, labels: DataFrame, where: Column | None) -> DataFrame:
    """Labelled texts (h, label, text), equal texts once, with the label of their least doc_id.
    A bitmap of hashed ids (of fixed size, false hits go in the join) keeps the texts of others
    out of the exchange, where texts are compressed; the result is written once, compressed."""
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    known = (known if where is None else known.where(where)).groupBy("doc_id").agg(F.min("label").alias("label"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).where("text is not null")
    first = (texts.select("doc_id", "h").join(known, "doc_id")
             .groupBy("h").agg(F.min(F.struct("doc_id", "label")).alias("m"))
             .select("h", "m.doc_id", "m.label"))
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << _ID_BITS))
    maps = (known.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    ids = np.zeros((1 << _ID_BITS) // 8 + 8192, np.uint8)
    for r in maps:
        part = np.frombuffer(r["bits"], np.uint8)
        at = r["k"] * 4096
        ids[at:at + len(part)] |= part
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def near(batches):
        for batch in batches:
            k, pos = batch.column("k").to_numpy(zero_copy_only=False), batch.column("pos").to_numpy(zero_copy_only=False)
            hit = shared.value[k * 4096 + pos // 8] >> (pos % 8).astype(np.uint8) & 1
            yield batch.filter(pa.array(hit == 1)).select(["doc_id", "h", "text"])

    bounded_batches(docs.sparkSession)
    marked = texts.withColumn("bit", bit).select(
        "doc_id", "h", "text", F.bitmap_bucket_number("bit").alias("k"),
        F.bitmap_bit_position("bit").alias("pos"))
    likely = marked.mapInArrow(near, texts.select("doc_id", "h", "text").schema)
    return restored(staged(packed(likely).join(first, ["doc_id", "h"]).select("h", "label", "body"),
                           "toxicity-texts"))


def _slices_of(batches):
    """Tokens of slices, with their rows and whether they are of a toxic text."""
    for batch in W.slices(batches, "text"):
        t = Tokens(batch.column("text"))
        row = W.row_of(t.words.first, len(t.hashes))
        yield batch, t, row, batch.column("label").to_numpy(zero_copy_only=False)[row] == 1


def _evidence(b: Column, g: Column, share: float) -> Column:
    """Minus the log of a bound on the probability of b or more toxic places among b + g."""
    n = b + g
    e = (F.when(b > 0, b * F.log(b / (n * share))).otherwise(0.0)
         + F.when(g > 0, g * F.log(g / (n * (1 - share)))).otherwise(0.0))
    return F.when(b > n * share, e).otherwise(0.0)


def _least_evidence(evidence: np.ndarray, counts: np.ndarray, tested: int) -> float:
    """Benjamini-Hochberg bound; ``evidence`` falls, ``counts`` are of names with that much."""
    k = np.cumsum(counts)
    ok = np.flatnonzero(evidence >= np.log(tested / (FALSE_MARKS * np.maximum(k, 1))))
    return float(evidence[ok[-1]]) if len(ok) else np.inf


def find_marks(known: DataFrame) -> list[np.ndarray]:
    """Hashes of the marks: words, then the stems of each size. Names are counted by their
    occurrences first; only those that come near the bound are counted by places."""
    spark = known.sparkSession
    kinds = range(1 + len(_STEMS))
    columns = ["kind", "name", "bad", "good"]

    def count(batches):
        for _, t, _, toxic in _slices_of(batches):
            parts = [(np.full(1, -1), np.zeros(1, np.uint64), np.array([toxic.sum()]), np.array([(~toxic).sum()]))]
            for kind in kinds:
                at = _places(t, kind, toxic)
                u, of = np.unique((t.hashes, *t.stems)[kind][at], return_inverse=True)
                parts.append((np.full(len(u), kind), u, np.bincount(of, toxic[at], len(u)),
                              np.bincount(of, ~toxic[at], len(u))))
            kind, name, bad, good = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind.astype(np.int32)), pa.array(name.view(np.int64)),
                 pa.array(bad.astype(np.int64)), pa.array(good.astype(np.int64))], columns)

    names = staged(known.mapInArrow(count, "kind int, name long, bad long, good long")
                   .groupBy("kind", "name").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
                   .where("bad + good > 1"), "toxicity-names")
    total = names.where("kind = -1").first()
    if total is None or not total["bad"] or not total["good"]:
        return [np.zeros(0, np.uint64) for _ in kinds]
    share = total["bad"] / (total["bad"] + total["good"])
    b, g = F.col("bad"), F.col("good")
    odds = share / (1 - share)
    lift = (b + 0.5) / (g + 0.5) / odds
    names = names.where("kind >= 0").withColumn("evidence", _evidence(b, g, share))
    tested = dict(names.where((b + g) * -np.log(share) >= -np.log(FALSE_MARKS))
                  .groupBy("kind").count().collect())
    near = names.where(lift >= MIN_LIFT / 2)
    hist = near.groupBy("kind", F.floor(F.col("evidence") * 4).alias("e")).count().collect()
    wanted = F.lit(False)
    for kind in tested:
        h = sorted(((r["e"] / 4, r["count"]) for r in hist if r["kind"] == kind), reverse=True)
        if h:
            least = _least_evidence(*np.array(h).T, tested[kind])
            least = min(least, np.log(tested[kind] / FALSE_MARKS))
            wanted |= (F.col("kind") == kind) & (F.col("evidence") >= float(least - 3))
    found = near.where(wanted).select("kind", "name").collect()
    marks = [np.sort(np.array([r["name"] for r in found if r["kind"] == kind], np.int64).view(np.uint64))
             for kind in kinds]
    shared = spark.sparkContext.broadcast(marks)

    def places(batches):
        for batch, t, row, toxic in _slices_of(batches):
            h = batch.column("h").to_numpy(zero_copy_only=False)[row]
            for kind in kinds:
                at = _places(t, kind, toxic, shared.value[kind])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), kind, np.int32)),
                     pa.array((t.hashes, *t.stems)[kind][at].view(np.int64)),
                     pa.array(t.around[at].view(np.int64)), pa.array(toxic[at]), pa.array(h[at])],
                    ["kind", "name", "around", "toxic", "h"])

    exact = (known.mapInArrow(places, "kind int, name long, around long, toxic boolean, h long")
             .groupBy("kind", "name", "around", "toxic").agg(F.min("h").alias("h"))
             .groupBy("kind", "name").agg(
                 F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"),
                 F.min(F.when(F.col("toxic"), F.col("h"))).alias("one"),
                 F.max(F.when(F.col("toxic"), F.col("h"))).alias("other"))
             .where((F.col("one") != F.col("other")) & (lift >= MIN_LIFT))
             .select("kind", "name", _evidence(b, g, share).alias("e")).collect())
    out = []
    for kind in kinds:
        e = sorted(((r["e"], r["name"]) for r in exact if r["kind"] == kind), reverse=True)
        v = np.array([x for x, _ in e])
        least = _least_evidence(v, np.ones(len(v)), max(1, tested.get(kind, 0)))
        out.append(np.sort(np.array([n for x, n in e if x >= least], np.int64).view(np.uint64)))
    return out


def _mark_numbers(t: Tokens, marks: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of toxic texts with a mark and the number of the mark, for each kind in turn."""
    at, number, base = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for name, m in zip((t.hashes, *t.stems), marks):
        hit = np.flatnonzero(toxic & np.isin(name, m))
        at.append(hit)
        number.append(base + np.searchsorted(m, name[hit]))
        base += len(m)
    return np.concatenate(at), np.concatenate(number)


def _pieces(known: DataFrame, marks: list[np.ndarray], rare: np.ndarray) -> list[str]:
    """For every mark numbered in ``rare`` up to ``EXAMPLES`` pieces of lines of toxic texts, of
    40 tokens about the mark at most; ``FIT_LINES`` in all, a first one of every mark first."""
    shared = known.sparkSession.sparkContext.broadcast((marks, rare))

    def run(batches):
        marks, rare = shared.value
        for batch, t, row, toxic in _slices_of(batches):
            at, number = _mark_numbers(t, marks, toxic)
            keep = np.isin(number, rare)
            at, number = at[keep], number[keep]
            key = W.mix(t.around[at], 50)
            part = (key % np.uint64(EXAMPLES)).astype(np.int64)
            order = np.lexsort((key, part, number))
            at, number, key, part = at[order], number[order], key[order], part[order]
            new = np.ones(len(at), bool)
            new[1:] = (number[1:] != number[:-1]) | (part[1:] != part[:-1])
            at, number, key, part = at[new], number[new], key[new], part[new]
            line = np.searchsorted(t.lines, at, "right") - 1
            a, b = np.maximum(at - 20, t.lines[line]), np.minimum(at + 20, t.lines[line + 1])
            texts = [t.words.text(i, j).decode("utf8", "replace")[:4096] for i, j in zip(a.tolist(), b.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(part), pa.array(key.view(np.int64)), pa.array(texts, pa.string())],
                ["number", "part", "key", "piece"])

    found = (known.where("label = 1").mapInArrow(run, "number long, part long, key long, piece string")
             .groupBy("number", "part").agg(F.min(F.struct("key", "piece")).alias("m")))
    return list(dict.fromkeys(r["piece"] for r in found.orderBy("part", "number").select("m.piece")
                              .limit(FIT_LINES).collect()))


def _fit_lines(t: Tokens, at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and labels of the lines to fit, and the lines' lengths: those with a toxic token,
    rare marks first, and as many others."""
    y = np.zeros(len(t.slots), bool)
    y[at] = True
    line = np.searchsorted(t.lines, at, "right") - 1
    order = np.lexsort((line, number))
    turn = np.zeros(len(at), np.int64)  # how many tokens of the mark came before
    turn[order] = np.arange(len(at)) - np.searchsorted(number[order], number[order], "left")
    with_, first = np.unique(line[np.argsort(turn, kind="stable")], return_index=True)
    with_ = with_[np.argsort(first, kind="stable")][:FIT_LINES]
    c = np.concatenate([[0], np.cumsum(y)])
    without = np.flatnonzero(c[t.lines[1:]] == c[t.lines[:-1]])
    without = without[:: max(1, len(without) // max(1000, len(with_)))][:FIT_LINES]
    lines = np.sort(np.concatenate([with_, without]))
    size = (t.lines[1:] - t.lines[:-1])[lines]
    first = np.cumsum(size) - size
    at = np.repeat(t.lines[:-1][lines] - first, size) + np.arange(size.sum())
    return t.slots[at], y[at], size


@dataclass
class _Sample:
    """Tokens of a list of texts, worked out slice by slice: features, lines, rows, and which
    tokens of toxic texts are marks."""

    slots: np.ndarray
    lines: np.ndarray
    first: np.ndarray
    at: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, texts: list[str], toxic: np.ndarray, marks: list[np.ndarray]) -> _Sample:
        slots, lines, counts, ats, numbers, n = [], [np.zeros(1, np.int64)], [], [], [], 0
        for part in text_slices(texts):
            t = Tokens(pa.array(texts[part], pa.large_string()))
            at, number = _mark_numbers(t, marks, toxic[part][W.row_of(t.words.first, len(t.hashes))])
            slots.append(t.slots)
            lines.append(t.lines[1:] + n)
            counts.append(t.words.counts)
            ats.append(at + n)
            numbers.append(number)
            n += len(t.hashes)
        at, number = np.concatenate(ats), np.concatenate(numbers)
        kind = np.searchsorted(np.cumsum([len(m) for m in marks]), number, "right")
        order = np.lexsort((at, kind))
        return cls(np.concatenate(slots), np.concatenate(lines),
                   np.concatenate([[0], np.cumsum(np.concatenate(counts))]), at[order], number[order])

    def document_features(self, chain: crf.Chain) -> np.ndarray:
        """Of each text, from the marginals of a bounded number of tokens at a time."""
        out, a, rows = [], 0, len(self.first) - 1
        while a < rows:
            b = max(a + 1, int(np.searchsorted(self.first, self.first[a] + (1 << 18), "right")) - 1)
            i, j = self.first[a], self.first[b]
            lines = self.lines[np.searchsorted(self.lines, i):np.searchsorted(self.lines, j) + 1] - i
            p = crf.marginals(chain.emissions(self.slots[i:j]), lines, chain.pairs)
            out.append(_document_features(p, self.first[a:b + 1] - i))
            a = b
        return np.concatenate(out)


def fit_toxicity(docs: DataFrame, labels: DataFrame, where: Column | None = None,
                 per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model | None:
    """Tagger and score from labelled documents, None without both labels."""
    rows = list({r["text"]: r for r in
                 labelled_sample(docs, labels, "toxic", per_class, max_bytes, where)}.values())
    if len({r["label"] for r in rows}) < 2:
        return None
    known = _known_texts(docs, labels, where)
    marks = find_marks(known)
    texts, toxic = [r["text"] for r in rows], np.array([r["label"] == 1 for r in rows])
    del rows
    t = _Sample.of(texts, toxic, marks)
    del texts
    parts = [_fit_lines(t, t.at, t.number)]
    rare = np.flatnonzero(np.bincount(t.number, minlength=sum(map(len, marks))) < EXAMPLES)
    if len(rare):
        pieces = _pieces(known, marks, rare)
        if pieces:
            m = _Sample.of(pieces, np.ones(len(pieces), bool), marks)
            parts.append(_fit_lines(m, m.at, m.number))
    slots, y, size = (np.concatenate(c) for c in zip(*parts))
    chain = crf.fit(slots, y, np.concatenate([[0], np.cumsum(size)]), N_FEATURES, steps=80, l2=1e-6)
    x = t.document_features(chain)
    weight = crf.fit_logistic(x, toxic.astype(float))
    known = labels.where("toxic in (0, 1)")
    of = dict((known if where is None else known.where(where)).groupBy("toxic").count().collect())
    weight[-1] += np.log(of[1] / of[0]) - np.log(toxic.sum() / (~toxic).sum())
    return Model(chain, weight)


def toxicity(docs: DataFrame, model: Model | None, span_at: float = SPAN_AT,
             with_spans: bool = True) -> DataFrame:
    """Per row: doc_id, score (0 to 1) and, if asked for, spans: byte offsets in the UTF-8
    text and the largest marginal of runs of neighbouring tokens tagged toxic."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    names = ["doc_id", "score", *["spans"] * with_spans]
    kind_spans = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        m = shared.value
        for batch in W.slices(batches, "text"):
            t = Tokens(batch.column("text"))
            n = batch.num_rows
            if m is None:
                p, score = np.zeros(len(t.hashes)), np.zeros(n)
            else:
                p = crf.marginals(m.chain.emissions(t.slots), t.lines, m.chain.pairs)
                score = m.scores(p, t.words.first)
            cols = [batch.column("doc_id"), pa.array(score)]
            if with_spans:
                cols.append(pa.array(_spans(t, p, span_at, n), kind_spans))
            yield pa.RecordBatch.from_arrays(cols, names)

    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, score double"
                            + ", spans array<struct<begin:long,end:long,p:double>>" * with_spans)


def _spans(t: Tokens, p: np.ndarray, span_at: float, n: int) -> list[list[tuple]]:
    w = t.words
    out: list[list[tuple]] = [[] for _ in range(n)]
    before = -2
    for i in np.flatnonzero(p >= span_at).tolist():
        r = int(np.searchsorted(w.first, i, "right")) - 1
        s, e = int(w.starts[i] - w.offsets[r]), int(w.ends[i] - w.offsets[r])
        if before == i - 1 and out[r]:
            s, _, q = out[r].pop()
            out[r].append((s, e, max(q, float(p[i]))))
        else:
            out[r].append((s, e, float(p[i])))
        before = i
    return out
