"""Word splitting and 64-bit hashing of Arrow string columns with numpy.

All functions work on one slice of an Arrow batch inside a Spark task. A slice is
bounded by ``max_bytes`` (one row at least), so memory follows the longest text and not
the batch. Hashes depend on the word's bytes alone, so they agree between tasks.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BLOCK = 1 << 20
_LONG_WORD = 1 << 16
_M_BYTE = 0x9E3779B97F4A7C15
_M_WORD = 0xD1342543DE82EF95


def _lut(members) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(members)] = 1
    return t


# Bytes that belong to a word: everything but blank and \t \n \v \f \r.
VISIBLE = _lut(set(range(256)) - {0x20, *range(0x09, 0x0E)})
# Digits, a-z and every byte of a non-ASCII character (after lower-casing A-Z).
ALNUM = _lut({*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)})
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """Words of a slice: byte ranges [starts, ends) of ``data``; the words of row i are
    first[i] .. first[i+1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, a: int, b: int) -> bytes:
        """Words a..b (exclusive) joined by one space."""
        d = self.data
        return b" ".join(d[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b]))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)     # where the C library has it


def release() -> None:
    """Gives the memory that a finished partition has freed back to the system: the worker that
    waits for its next task, beside others on the executor, is small."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and row offsets into them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    bufs = texts.buffers()
    if n == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1]
    off = off.astype(np.int64)
    data = (np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]] if bufs[2] is not None
            else np.zeros(0, np.uint8))
    return data, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into row ranges of at most ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        _, off = text_bytes(batch.column(column))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
    release()


def split_words(data: np.ndarray, off: np.ndarray, members: np.ndarray = VISIBLE) -> Words:
    """Maximal runs of ``members`` bytes; a run never crosses a row."""
    n = len(data)
    keep = members[data]
    prev = np.empty(n, np.uint8)
    prev[:1] = 0
    prev[1:] = keep[:-1]
    prev[off[:-1][off[:-1] < n]] = 0
    starts = np.flatnonzero(keep > prev)
    nxt = np.empty(n, np.uint8)
    nxt[-1:] = 0
    nxt[:-1] = keep[1:]
    nxt[off[1:][off[1:] > 0] - 1] = 0
    ends = np.flatnonzero(keep > nxt) + 1
    return Words(data, off, starts, ends, np.searchsorted(starts, off))


class _Powers:
    """m^i and m^-i modulo 2^64, grown on demand."""

    def __init__(self, m: int):
        self.m, self.inv = m, pow(m, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            for name, m in (("up", self.m), ("down", self.inv)):
                p = np.full(size, m, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTE, _WORD = _Powers(_M_BYTE), _Powers(_M_WORD)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """splitmix64 finalizer; ``seed`` gives independent orders of the same hashes."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of every word's bytes (polynomial prefix sums per block, then mixed;
    words over 64 KiB by BLAKE2b)."""
    n = len(w.starts)
    out = np.empty(n, np.uint64)
    lens = w.ends - w.starts
    long = np.flatnonzero(lens > _LONG_WORD)
    a = 0
    while a < n:
        lo = int(w.starts[a])
        b = max(a + 1, int(np.searchsorted(w.ends, lo + _BLOCK, "right")))
        nxt = long[np.searchsorted(long, a)] if len(long) and long[-1] >= a else n
        if nxt == a:
            word = w.data[lo:int(w.ends[a])].tobytes()
            out[a] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            a += 1
            continue
        b = min(b, int(nxt))
        seg = w.data[lo:int(w.ends[b - 1])]
        up, down = _BYTE.get(len(seg) + 1)
        c = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum((seg.astype(np.uint64) + np.uint64(1)) * up[:len(seg)], out=c[1:])
        s, e = w.starts[a:b] - lo, w.ends[a:b] - lo
        out[a:b] = mix((c[e] - c[s]) * down[s] + lens[a:b].astype(np.uint64))
        a = b
    return out


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries of ``h`` (windows may cross rows; see
    ``window_mask``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for a in range(0, n, _BLOCK):
        m = min(_BLOCK, n - a)
        part = h[a:a + m + k - 1]
        up, down = _WORD.get(len(part) + 1)
        c = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=c[1:])
        out[a:a + m] = mix((c[k:] - c[:-k]) * down[:m], 1)
    return out


def window_mask(first: np.ndarray, k: int, n_windows: int) -> np.ndarray:
    """True where the k entries from here lie in one row."""
    ok = np.zeros(n_windows + 1, np.int32)
    a, b = first[:-1], first[1:] - k + 1
    good = b > a
    np.add.at(ok, a[good], 1)
    np.add.at(ok, b[good], -1)
    return np.cumsum(ok[:n_windows]) > 0


def row_of(first: np.ndarray, n: int) -> np.ndarray:
    """Row of each of n entries laid out by ``first``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]


def covered(n: int, at: np.ndarray, k) -> np.ndarray:
    """True for the entries of [0, n) inside [a, a+k) for any a in ``at``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1)
    np.add.at(d, at + k, -1)
    return np.cumsum(d[:n]) > 0
