"""Words of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A word is a run of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.
In UTF-8 every byte of a character beyond ASCII is at least 0x80, so words can be found byte by byte.
Work goes in pieces of a quarter megabyte, cut between words, so memory is bounded by the longest word
and by the word list of one document, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = (((_BYTES >= 48) & (_BYTES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128))
IS_SOLID = _BYTES > 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all others."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))[LOWER]


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when needed and not sent with tasks."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            up = np.full(size, _BASE, np.uint64)
            down = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of some documents: ``offsets[i]:offsets[i + 1]`` are those of document ``i``.

    ``starts`` and ``ends`` are byte positions inside ``data``; ``base[i]`` is where document ``i`` begins.
    """

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    base: np.ndarray
    data: np.ndarray
    prefixes: dict[int, np.ndarray]
    suffixes: dict[int, np.ndarray]

    def text(self, k: int) -> str:
        return LOWER[self.data[self.starts[k]:self.ends[k]]].tobytes().decode("utf-8", "replace")


def _piece(data: np.ndarray, at: int, breaks: np.ndarray, word: np.ndarray, prefix, suffix):
    """Words of one stretch of bytes. ``breaks`` are positions where a document begins."""
    flag = word[data]
    before = np.empty_like(flag)
    before[0] = False
    before[1:] = flag[:-1]
    before[breaks] = False
    starts = np.flatnonzero(flag & ~before)
    after = np.empty_like(flag)
    after[-1] = False
    after[:-1] = flag[1:]
    inner = breaks[breaks > 0]
    after[inner - 1] = False
    ends = np.flatnonzero(flag & ~after) + 1
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    pre = {k: mix((total[np.minimum(starts + k, ends)] - total[starts]) * down[starts] + np.uint64(k)) for k in prefix}
    suf = {}
    for k in suffix:
        first = np.maximum(ends - k, starts)
        suf[k] = mix((total[ends] - total[first]) * down[first] + np.uint64(64 + k))
    return hashes, starts + at, ends + at, pre, suf


def _cuts(data: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about CHUNK bytes that end between words."""
    lo = 0
    while lo < len(data):
        hi = min(lo + CHUNK, len(data))
        while hi < len(data):
            near = data[hi - 1:hi + 4096]
            gap = np.flatnonzero(~word[near])
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(hi + 4096, len(data))
        yield lo, hi
        lo = hi


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return offsets, data


def words(column: pa.Array, solid: bool = False, prefix: tuple[int, ...] = (), suffix: tuple[int, ...] = ()) -> Iterator[tuple[int, int, Words]]:
    """Give (first document, end, words) for runs of documents of about CHUNK bytes.

    ``solid`` takes runs without white space as words instead. Hashes of the first or last k bytes
    of each word come with ``prefix`` and ``suffix``.
    """
    word = IS_SOLID if solid else IS_WORD
    offsets, data = utf8_buffers(column)
    n, lo = len(column), 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        begin, end = int(offsets[lo]), int(offsets[hi])
        part, docs = data[begin:end], offsets[lo:hi + 1] - begin
        parts = []
        for a, b in _cuts(part, word):
            inside = docs[(docs >= a) & (docs < b)] - a
            parts.append(_piece(part[a:b], a, inside, word, prefix, suffix))
        if parts:
            hashes, starts, ends = (np.concatenate([p[i] for p in parts]) for i in range(3))
            pre = {k: np.concatenate([p[3][k] for p in parts]) for k in prefix}
            suf = {k: np.concatenate([p[4][k] for p in parts]) for k in suffix}
        else:
            hashes, starts, ends = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            pre, suf = {k: hashes for k in prefix}, {k: hashes for k in suffix}
        yield lo, hi, Words(hashes, starts, ends, np.searchsorted(starts, docs), docs, part, pre, suf)
        lo = hi


class Lookup:
    """From 64-bit hashes to row numbers by open addressing; -1 where unknown."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("keys must be unique")
        self.bits = max(8, int(len(keys) * 2 - 1).bit_length() if len(keys) else 8)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        mask = (1 << self.bits) - 1
        at, todo = (keys & np.uint64(mask)).astype(np.int64), np.arange(len(keys))
        while len(todo):
            free = todo[self.rows[at[todo]] < 0]
            self.rows[at[free]] = free
            self.keys[at[free]] = keys[free]
            kept = self.rows[at[free]] == free
            todo = np.concatenate([np.setdiff1d(todo, free, assume_unique=True), free[~kept]])
            at[todo] = (at[todo] + 1) & mask

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << self.bits) - 1)
        at = (hashes & mask).astype(np.int64)
        found = np.where(self.keys[at] == hashes, self.rows[at], np.int32(-1))
        open_ = np.flatnonzero((self.keys[at] != hashes) & (self.rows[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & int(mask)
            key, row = self.keys[at[open_]], self.rows[at[open_]]
            hit = (key == hashes[open_]) & (row >= 0)
            found[open_[hit]] = row[hit]
            open_ = open_[~hit & (row >= 0)]
        return found
