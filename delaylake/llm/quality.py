"""Quality rules: base rules, and a linear-chain CRF that labels the lines of a document as
content or boilerplate (Viterbi); the share of content decides.

The CRF is fitted on a bounded sample of labelled documents (``per_class`` documents and
``max_bytes`` of text for each label): every line of a document of quality 0 counts as
boilerplate, of quality 1 as content. Its features are binned shares of symbols, capitals,
digits, marks, repeated words, lengths and places, so nothing of the text's wording or its
language is learned.

Defined results: null and empty texts have no words, fail the base rules and are not kept;
without labels of both kinds there is no model and the base rules alone decide; equal rows
get equal results; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from delaylake.llm import crf
from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches, labelled_sample, schema_ddl, text_slices

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
MIN_CONTENT_SHARE = 0.5
PER_CLASS = 1500
MAX_BYTES = 5 << 20

_SYMBOL = W._lut(b"#*$%&|<>")
_UPPER = W._lut(range(0x41, 0x5B))
_LOWER = W._lut(range(0x61, 0x7B))
_DIGIT = W._lut(range(0x30, 0x3A))
_MARK = W._lut(b"!?=_~^@\\{}[]+")
_STOP = W._lut(b".!?:\"')")
_BINS = {  # upper bounds of the bins of each feature
    "symbols": (0.0, 0.01, 0.03, 0.08, 0.2),
    "capitals": (0.1, 0.3, 0.6, 0.9),
    "digits": (0.0, 0.03, 0.1, 0.3),
    "marks": (0.0, 0.02, 0.06, 0.15),
    "repeats": (0.1, 0.25, 0.5, 0.75),
    "words": (2, 5, 10, 25, 100),
    "word_length": (2, 3.5, 5, 8, 12),
    "wide": (0.0, 0.05, 0.2, 0.5),
}
_FLAGS = ("again", "stopped", "head", "tail", "always")
_AT = dict(zip(_BINS, np.cumsum([0, *(len(b) + 1 for b in _BINS.values())])))
_FLAG_AT = sum(len(b) + 1 for b in _BINS.values())
N_FEATURES = _FLAG_AT + 2 * len(_FLAGS)


class Lines:
    """Lines with a word of a slice's rows, with their features and the base counts."""

    def __init__(self, texts):
        data, off = W.text_bytes(texts)
        self.words = w = W.split_words(data, off)
        self.rows = rows = len(off) - 1
        cut = np.flatnonzero(data == 0x0A)
        begin = np.unique(np.concatenate([off[:-1], cut + 1]))
        begin = begin[begin < len(data)] if len(data) else begin[:0]
        bounds = np.searchsorted(w.starts, np.append(begin, len(data)))
        has = np.diff(bounds) > 0
        self.begin, self.w0, self.w1 = begin[has], bounds[:-1][has], bounds[1:][has]
        stop = np.append(begin, len(data))[1:][has]
        self.first = np.searchsorted(self.begin, off)
        self.hashes = h = W.word_hashes(w)
        self._repeats(h)
        self._duplicates(data, off)
        inside = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        per_word = inside[w.ends] - inside[w.starts]
        self.word_chars = self._by_row(per_word)
        self.line_chars = self._by_line(per_word)
        self.n_symbols = self._span(_SYMBOL[data], off[:-1], off[1:])
        count = lambda mask: self._span(mask, self.begin, stop)
        n, nw = np.maximum(self.line_chars, 1), self.w1 - self.w0
        letters = count(_UPPER[data] | _LOWER[data])
        line = np.repeat(np.arange(len(nw)), nw)
        order = np.lexsort((h, line))
        same = np.zeros(len(h), bool)
        if len(h):
            a, b = order[1:], order[:-1]
            same[a] = (h[a] == h[b]) & (line[a] == line[b])
        values = {
            "symbols": count(_SYMBOL[data]) / n,
            "capitals": count(_UPPER[data]) / np.maximum(letters, 1),
            "digits": count(_DIGIT[data]) / n,
            "marks": count(_MARK[data]) / n,
            "repeats": self._by_line(same) / nw,
            "words": nw,
            "word_length": n / nw,
            "wide": count(data >= 0x80) / n,
        }
        last = data[w.ends[self.w1 - 1] - 1] if len(nw) else data[:0]
        place = np.arange(len(nw))
        of = W.row_of(self.first, len(nw))
        flags = (self.again, _STOP[last] > 0, place == self.first[of],
                 place == self.first[of + 1] - 1, np.ones(len(nw), bool))
        self.slots = np.stack(
            [_AT[k] + np.searchsorted(_BINS[k], v, "left") for k, v in values.items()]
            + [_FLAG_AT + 2 * i + f.astype(np.int64) for i, f in enumerate(flags)], axis=1)

    def _span(self, mask, a, b):
        c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return c[b] - c[a]

    def _by_row(self, per_word):
        return self._span(per_word, self.words.first[:-1], self.words.first[1:])

    def _by_line(self, per_word):
        return self._span(per_word, self.w0, self.w1)

    def _repeats(self, h):
        """Words in a window of REPEAT_WINDOW words that is found twice or more in the row."""
        w = self.words
        win = W.window_hashes(h, REPEAT_WINDOW)
        at = np.flatnonzero(W.window_mask(w.first, REPEAT_WINDOW, len(win)))
        row = W.row_of(w.first, len(h))[at]
        order = np.lexsort((win[at], row))
        v, r = win[at][order], row[order]
        eq = (v[1:] == v[:-1]) & (r[1:] == r[:-1]) if len(v) else np.zeros(0, bool)
        twice = np.zeros(len(v), bool)
        twice[1:] |= eq
        twice[:-1] |= eq
        self.n_repeat = self._by_row(W.covered(len(h), at[order][twice], REPEAT_WINDOW))

    def _duplicates(self, data, off):
        """``again``: lines equal, byte for byte, to an earlier line of the row."""
        again = np.zeros(len(self.begin), bool)
        for i in range(self.rows):
            a, b = int(self.first[i]), int(self.first[i + 1])
            if b - a < 2:
                continue
            raw = data[off[i]:off[i + 1]].tobytes()
            seen = set()
            for j, s in zip(range(a, b), (self.begin[a:b] - off[i]).tolist()):
                e = raw.find(b"\n", s)
                line = raw[s:] if e < 0 else raw[s:e]
                if line in seen:
                    again[j] = True
                seen.add(line)
        self.again = again
        c = np.concatenate([[0], np.cumsum(again)])
        self.n_dup = c[self.first[1:]] - c[self.first[:-1]]


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                max_bytes: int = MAX_BYTES) -> crf.Chain | None:
    """Line labeller from labelled documents, None without both labels."""
    rows = list({r["text"]: r for r in
                 labelled_sample(docs, labels, "quality", per_class, max_bytes)}.values())
    if len({r["label"] for r in rows}) < 2:
        return None
    texts, bad = [r["text"] for r in rows], np.array([r["label"] == 0 for r in rows])
    del rows
    slots, lines = [], []
    for part in text_slices(texts):
        x = Lines(pa.array(texts[part], pa.large_string()))
        slots.append(x.slots.astype(np.int16))
        lines.append(np.diff(x.first))
    lines = np.concatenate(lines)
    return crf.fit(np.concatenate(slots), np.repeat(bad, lines), np.concatenate([[0], np.cumsum(lines)]), N_FEATURES)


_RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, content_share double, boilerplate_lines array<int>, kept boolean")


def quality(docs: DataFrame, chain: crf.Chain | None,
            min_content_share: float = MIN_CONTENT_SHARE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, text`` and the columns ``carry`` with the base counts, base_failed, the share of the words' characters
    that stand in content lines, the boilerplate lines (numbered from 0 among the lines with
    a word) and kept."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in W.slices(batches, "text"):
            x = Lines(batch.column("text"))
            junk = (crf.viterbi(chain.emissions(x.slots), x.first, chain.pairs) if chain
                    else np.zeros(len(x.begin), bool))
            kept_chars = x._span(np.where(junk, 0, x.line_chars), x.first[:-1], x.first[1:])
            share = np.where(x.word_chars > 0, kept_chars / np.maximum(x.word_chars, 1), 0.0)
            n = x.words.counts
            failed = (n < MIN_WORDS) | (100 * x.n_repeat > MAX_REPEAT_PERCENT * n)
            at = np.flatnonzero(junk)
            of = W.row_of(x.first, len(junk))[at]
            junk_lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of, np.arange(x.rows + 1)), pa.int32()),
                pa.array(at - x.first[of], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n, pa.int64()), pa.array(x.word_chars, pa.int64()),
                 pa.array(x.n_symbols, pa.int64()), pa.array(x.n_dup, pa.int64()),
                 pa.array(x.n_repeat, pa.int64()), pa.array(failed), pa.array(share), junk_lists,
                 pa.array(~failed & (share >= min_content_share))],
                [*batch.schema.names, *(c.split()[0] for c in _RESULT.split(", "))])

    plain = docs.select("doc_id", "text", *carry)
    return plain.mapInArrow(run, schema_ddl(plain, _RESULT))
