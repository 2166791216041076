"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A pre-token (a match of the split pattern) is a row of byte symbols. The leaves of the tree
hold the merge rank of the pair that starts at each live position; an inner node holds the
leftmost leaf of least rank below it. A merge takes the root's leaf, joins it with its right
neighbour and updates the at most three leaves that changed, each in logarithmic time, so a
pre-token of n bytes takes O(n log n) whatever its content. Short pre-tokens are merged many
at a time, one tree per row of a matrix (``Batch``); long ones by ``merge_bytes``. Pre-tokens
repeat, so a task keeps the ids of the recent ones in a bounded table (a full table is
emptied; results do not depend on it).

Defined results: null and empty texts have no tokens and decode to nothing; equal rows and
equal ids are encoded one by one; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from delaylake.llm import words as W
from delaylake.llm.base import bounded_batches

TABLE_ENTRIES = 400_000
TABLE_MAX_CHARS = 16
_NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a ``.tiktoken`` file (base64, rank per line)."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merges the leftmost pair of least rank until none is left."""
    n = len(piece)
    if piece in ranks:
        return [ranks[piece]]
    if n < 2:
        return [ranks[piece]]
    size = 1
    while size < n:
        size *= 2
    get = ranks.get
    # A key is rank * size + position: the least key is the leftmost pair of least rank.
    tree = [_NONE] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r * size + i
    for v in range(size - 1, 0, -1):
        a, b = tree[2 * v], tree[2 * v + 1]
        tree[v] = a if a < b else b
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def put(i: int, key: int) -> None:
        v = size + i
        tree[v] = key
        v >>= 1
        while v:
            a, b = tree[2 * v], tree[2 * v + 1]
            least = a if a < b else b
            if tree[v] == least:
                return
            tree[v] = least
            v >>= 1

    def pair(i: int) -> int:
        j = end[i]
        r = get(piece[i:end[j]]) if j < n else None
        return _NONE if r is None else r * size + i

    while tree[1] != _NONE:
        i = tree[1] % size
        j = end[i]
        end[i] = end[j]
        if end[j] < n:
            before[end[j]] = i
        put(j, _NONE)
        put(i, pair(i))
        h = before[i]
        if h >= 0:
            put(h, pair(h))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Batch:
    """The same merges for many pre-tokens of at most ``size`` bytes in lock-step: row r of
    the matrix ``tree`` is the segment tree of pre-token r."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.full(256, -1, np.int64)
        pairs = {}
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte[token[0]] = rank
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair of ids, -1 where there is none."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(ok & (self.keys[at] == key), self.merged[at], -1)

    def merge(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, row after row, and the number of each row."""
        k = len(pieces)
        lens = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(k, size)
        place = np.arange(size)
        sym = np.where(place < lens[:, None], self.byte[raw], -1)
        end = np.broadcast_to(place + 1, (k, size)).copy()
        before = np.broadcast_to(np.arange(-1, size), (k, size + 1)).copy()
        tree = np.full((k, 2 * size), _NONE, np.int64)
        r = self.rank(sym[:, :-1], sym[:, 1:], place[1:] < lens[:, None])
        tree[:, size:-1] = np.where(r >= 0, r * size + place[:-1], _NONE)
        top = size
        while top > 1:
            tree[:, top // 2:top] = np.minimum(tree[:, top:2 * top:2], tree[:, top + 1:2 * top:2])
            top //= 2

        def put(rows, at, keys):
            v = size + at
            tree[rows, v] = keys
            while True:
                v = v >> 1
                if not v[0]:
                    return
                tree[rows, v] = np.minimum(tree[rows, 2 * v], tree[rows, 2 * v + 1])

        def pair(rows, i):
            j = end[rows, i]
            r = self.rank(sym[rows, i], sym[rows, np.minimum(j, size - 1)], j < lens[rows])
            return np.where(r >= 0, r * size + i, _NONE)

        rows = np.arange(k)
        while True:
            rows = rows[tree[rows, 1] != _NONE]
            if not len(rows):
                break
            root = tree[rows, 1]
            i = root % size
            j = end[rows, i]
            sym[rows, i], sym[rows, j] = root // size, -1
            end[rows, i] = end[rows, j]
            before[rows, end[rows, j]] = i
            put(rows, j, _NONE)
            put(rows, i, pair(rows, i))
            h = before[rows, i]
            left = h >= 0
            if left.any():
                put(rows[left], h[left], pair(rows[left], h[left]))
        live = sym >= 0
        return sym[live], live.sum(axis=1)


class Encoder:
    """Encodes texts by ``ranks`` and the split ``pattern``; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.table: dict[str, tuple[list[int], str]] = {}
        self.batch = Batch(ranks)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def keep(self, s: str, ids: list[int]) -> None:
        self.table[s] = ids, " ".join(map(str, ids))

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of new short pre-tokens into the table."""
        if len(self.table) + len(pieces) > TABLE_ENTRIES:
            self.table.clear()
        classes: dict[int, list[str]] = {}
        for s in pieces:
            raw = s.encode()
            if raw in self.ranks:
                self.keep(s, [self.ranks[raw]])
            else:
                classes.setdefault(max(8, 1 << (len(raw) - 1).bit_length()), []).append(s)
        for size, group in classes.items():
            for a in range(0, len(group), 1 << 12):
                part = group[a:a + (1 << 12)]
                flat, counts = self.batch.merge([s.encode() for s in part], size)
                ids, at = flat.tolist(), 0
                for s, c in zip(part, counts.tolist()):
                    self.keep(s, ids[at:at + c])
                    at += c

    def encode_all(self, texts: list[str]):
        """For each text its ids, and the same in decimal joined by one space."""
        split = [self.split(t) for t in texts]
        table = self.table
        new = {s for pieces in split for s in pieces
               if s not in table and len(s) <= TABLE_MAX_CHARS}
        if new:
            if len(table) + len(new) > TABLE_ENTRIES:
                new |= {s for pieces in split for s in pieces if len(s) <= TABLE_MAX_CHARS}
            self.learn(new)
        for pieces in split:
            ids: list[int] = []
            parts: list[str] = []
            get, extend, append = table.get, ids.extend, parts.append
            for s in pieces:
                entry = get(s)
                if entry is None:
                    own = merge_bytes(s.encode(), self.ranks)
                    entry = own, " ".join(map(str, own))
                extend(entry[0])
                append(entry[1])
            yield ids, " ".join(parts)

    def encode(self, text: str) -> tuple[list[int], str]:
        return next(self.encode_all([text]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(load_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``doc_id``, n_tokens, ids, ids_sha256 (of the decimal ids joined by one space) and
    decoded_sha256 (of the bytes that the ids decode to). ``path`` is the vocabulary file,
    which every worker reads from its own installation."""
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256"]

    def run(batches):
        enc = encoder(path, pattern)
        for batch in W.slices(batches, "text", 1 << 20):
            n, ids_out, ids_sha, dec_sha = [], [], [], []
            for ids, joined in enc.encode_all([t or "" for t in batch.column("text").to_pylist()]):
                n.append(len(ids))
                if with_ids:
                    ids_out.append(pa.array(ids, pa.int32()))
                ids_sha.append(hashlib.sha256(joined.encode()).hexdigest())
                dec_sha.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            cols = [batch.column("doc_id"), pa.array(n, pa.int64())]
            if with_ids:
                off = pa.array([0, *_running(n)], pa.int32())
                cols.append(pa.ListArray.from_arrays(off, pa.concat_arrays(ids_out)))
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())], names)

    plain = docs.select("doc_id", "text")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, n_tokens long, {'ids array<int>, ' * with_ids}"
                                 "ids_sha256 string, decoded_sha256 string")


def _running(counts: list[int]):
    total = 0
    for c in counts:
        total += c
        yield total


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ids; bytes that are not UTF-8 become U+FFFD, null ids null."""
    bounded_batches(encoded.sparkSession)

    def run(batches):
        enc = encoder(path, "")
        for batch in batches:
            texts = [None if ids is None else enc.decode(ids).decode("utf-8", "replace")
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    plain = encoded.select("doc_id", "ids")
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, text string")
