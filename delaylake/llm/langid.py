"""Language identification by cross-parsing entropy.

Per language a suffix automaton of a bounded labelled sample is built. A text is parsed from
left to right into the longest phrases that occur in the sample; the language whose sample
needs the fewest phrases per symbol wins (a tie goes to the language first in the alphabet).
Many segments of text are parsed in lock-step: the automata, completed by what happens where
no phrase goes on, are one table of next states.

Symbols are the bytes of the lower-cased text: a-z and bytes of non-ASCII characters that a
sample holds each by themselves, runs of all else (blanks, digits, marks) as one gap. Texts
are parsed whole, in segments of ``SEGMENT`` symbols.

The sample: every language has one, of the first ``per_lang`` labelled documents in the order
of a hash of doc_id, at most ``max_bytes`` each, as long as their bytes sum to at most
``max_bytes``; where these leave room, the beginnings of longer documents fill it. Texts are
parsed against the automata of ``GROUP`` languages at a time.

Defined results: null texts and texts without a letter are ``und`` with score 0; so are all
texts when there is no labelled document; with one language all others get it with score 1;
equal rows get equal results; other columns are never read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches

PER_LANG = 200
MAX_BYTES = 32 << 10
GROUP = 16
BLOCK_BYTES = 16 << 20
SEGMENT = 512
UNKNOWN = "und"
_LETTER = W._lut([*range(0x41, 0x5B), *range(0x61, 0x7B)])


def training_texts(docs: DataFrame, where: Column, per_lang: int = PER_LANG,
                   max_bytes: int = MAX_BYTES) -> dict[str, list[str]]:
    """The bounded sample: language -> texts."""
    texts = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("h")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & where)
    known = (texts.select("doc_id", "lang", "h", F.octet_length("text").alias("size")).where("size > 0")
             .groupBy("doc_id", "lang", "h").agg(F.min("size").alias("size")))
    first = Window.partitionBy("lang").orderBy(
        F.col("size") > max_bytes, F.xxhash64("doc_id"), F.col("doc_id"), F.col("h"))
    rows = (known.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang)
            .orderBy("lang", "n").collect())
    ids, room, seen = [], {}, set()
    for r in rows:
        left = room.setdefault(r["lang"], max_bytes)
        n = r["size"] if r["size"] <= max_bytes else left // 4 * 4
        if 0 < n <= left and (r["lang"], r["h"]) not in seen:
            seen.add((r["lang"], r["h"]))
            room[r["lang"]] -= n
            # a character has at most four bytes
            ids.append((r["doc_id"], r["lang"], r["h"], r["size"] if r["size"] <= max_bytes else n // 4))
    if not ids:
        return {}
    picked = docs.sparkSession.createDataFrame(
        ids, known.select("doc_id", "lang", "h", F.col("size").alias("n_chars_taken").cast("int")).schema)
    found = (texts.join(F.broadcast(picked), ["doc_id", "lang", "h"])
             .select("doc_id", "lang", "h", F.expr("substring(text, 1, n_chars_taken)").alias("text"))
             .groupBy("doc_id", "lang", "h").agg(F.first("text").alias("text")).collect())
    of = {(r["doc_id"], r["lang"], r["h"]): r["text"] for r in found}
    out: dict[str, list[str]] = {}
    for i in ids:
        out.setdefault(i[1], []).append(of[i[:3]])
    return dict(sorted(out.items()))


class Symbols:
    """Byte -> symbol: 0 pads, 1 is a gap, then a-z, then the samples' other bytes, and one
    for the bytes that no sample has."""

    def __init__(self, samples: list[bytes]):
        self.of = np.full(256, 1, np.uint8)
        self.of[0x61:0x7B] = np.arange(2, 28)
        seen = sorted({b for s in samples for b in s if b >= 0x80})
        self.of[0x80:] = 28 + len(seen)
        self.of[seen] = np.arange(28, 28 + len(seen))
        self.size = 29 + len(seen)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the rows' bytes and the rows' bounds, runs of gaps made one."""
        s = self.of[data]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 1) | (s[:-1] != 1)
        keep[off[:-1][off[:-1] < len(s)]] = True
        return s[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the states; state 0 is the start."""
    go, link, size = [{}], [-1], [0]
    last = 0
    for c in symbols:
        cur = len(go)
        go.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go


class Parser:
    """Automata of all languages in one table: 4 * next state + phrases ended."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        raw = [" ".join(texts[k]).lower().encode() for k in self.langs]
        self.symbols = Symbols(raw)
        a, tables, self.start, base = self.symbols.size, [], [], 0
        for sample in raw:
            data = np.frombuffer(sample, np.uint8)
            s, _ = self.symbols(data, np.array([0, len(data)]))
            go = suffix_automaton(s.tolist())
            t = np.full((len(go), a), -1, np.int64)
            for i, edges in enumerate(go):
                for c, j in edges.items():
                    t[i, c] = 4 * (base + j)
            begin = np.where(t[0] >= 0, t[0], 4 * base + 1)  # an unseen symbol is a phrase
            miss = t < 0
            t = np.where(miss, begin + 1, t)  # the phrase ends before the symbol
            t[0] = begin
            t[:, 0] = 4 * (base + np.arange(len(go)))
            tables.append(t)
            self.start.append(base)
            base += len(go)
        self.table = np.concatenate(tables).astype(np.int32).ravel()

    def phrases(self, s: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Phrases of each row (by language, by row)."""
        n = np.diff(bounds)
        parts = -(-n // SEGMENT)
        row = np.repeat(np.arange(len(n)), parts)
        k = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = bounds[:-1][row] + k * SEGMENT
        size = np.minimum(SEGMENT, bounds[1:][row] - begin)
        out = np.zeros((len(self.langs), len(n)), np.int64)
        order = np.argsort(-size, kind="stable")
        a = self.symbols.size
        for c in range(0, len(order), 4096):
            at = order[c:c + 4096]
            longest = int(size[at[0]])
            place = np.minimum(begin[at] + np.arange(longest)[:, None], len(s) - 1)
            grid = np.where(np.arange(longest)[:, None] < size[at], s[place], 0).astype(np.int32)
            state = np.repeat(np.array(self.start, np.int32)[:, None], len(at), axis=1)
            first = state.copy()
            count = np.zeros(state.shape, np.int32)
            for symbols in grid:
                v = self.table[state * a + symbols]
                count += v & 3
                state = v >> 2
            count += state != first  # the phrase under way
            for i in range(len(self.langs)):
                out[i] += np.bincount(row[at], count[i], len(n)).astype(np.int64)
        return out


_PARSERS: dict[tuple[str, int], Parser] = {}  # the last one, per Python worker


def _blocks(batches):
    """Lists of slices of ``BLOCK_BYTES`` of text or more, the last one of less."""
    block, size = [], 0
    for batch in W.slices(batches, "text"):
        block.append(batch)
        size += batch.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def identify(docs: DataFrame, texts: dict[str, list[str]], group: int = GROUP) -> DataFrame:
    """Per row: doc_id, lang_pred, score (1 - fewest / next fewest phrases) and n_phrases
    (fewest). With more than ``group`` languages a worker holds the automata of one group at a
    time and keeps of each row the two fewest counts."""
    spark = docs.sparkSession
    bounded_batches(spark)
    langs = sorted(texts)
    groups = [{k: texts[k] for k in langs[i:i + group]} for i in range(0, len(langs), group)]
    shared = spark.sparkContext.broadcast(groups)
    key = uuid.uuid4().hex

    def parser_of(g):
        if (key, g) not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key, g] = Parser(shared.value[g])
        return _PARSERS[key, g]

    def single(batches):
        for batch in W.slices(batches, "text"):
            yield [batch]

    def run(batches):
        for block in (single if len(groups) < 2 else _blocks)(batches):
            states = [None] * len(block)
            for g in range(len(groups)):
                parser = parser_of(g)
                for i, batch in enumerate(block):
                    data, off = W.text_bytes(pc.utf8_lower(batch.column("text")))
                    n = parser.phrases(*parser.symbols(data, off))
                    best, two = n.argmin(axis=0) + g * group, np.sort(n, axis=0)[:2]
                    if states[i] is not None:
                        was, before = states[i]
                        best = np.where(two[0] < before[0], best, was)  # a tie: the first name
                        two = np.sort(np.concatenate([before, two]), axis=0)[:2]
                    states[i] = best, two
            for batch, state in zip(block, states):
                yield named(batch, state)

    def named(batch, state):
        column = batch.column("text")
        data, off = W.text_bytes(pc.utf8_lower(column))
        c = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
        letter = c[off[1:]] > c[off[:-1]]
        for i in np.flatnonzero(~letter & (off[1:] > off[:-1])).tolist():
            letter[i] = any(ch.isalpha() for ch in column[i].as_py() or "")
        best = np.zeros(len(letter), np.int64)
        score, fewest = np.zeros(len(letter)), np.zeros(len(letter), np.int64)
        if state is not None:
            best, two = state
            fewest = two[0]
            rest = two[1] if len(two) > 1 else np.zeros(len(letter))
            score = np.where(rest > 0, 1 - fewest / np.maximum(rest, 1), float(len(langs) == 1))
        ok = letter & (state is not None)
        names = langs or [UNKNOWN]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([names[b] if o else UNKNOWN for b, o in zip(best, ok)]),
             pa.array(np.where(ok, score, 0.0)), pa.array(np.where(ok, fewest, 0))],
            ["doc_id", "lang_pred", "score", "n_phrases"])

    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_phrases long")
