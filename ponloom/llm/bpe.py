"""Token counts by merging byte pairs, without making tokens.

A text is cut into pieces by the tokenizer's pattern. The bytes of a piece are a linked list of symbols; a heap gives the adjacent
pair whose merge has the lowest rank, leftmost first, until no pair can be merged. The count of a piece is its
number of bytes less the number of merges. Counts of pieces are remembered in each Python worker, up to a bound.

Special strings of the vocabulary count as one token each, as the library does by default. Null texts count as empty: 0
bytes, 0 tokens.
"""

from __future__ import annotations

import heapq
import json
import sys
from types import ModuleType

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from ponloom.llm.frames import with_result

#: Fixed value: the pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 400_000
RESULT = T.StructType([T.StructField("n_tokens", T.LongType())])


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level file: printable Latin-1 is itself, the others follow from U+0100 on."""
    plain = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Counter:
    """Merges of one vocabulary file. Symbols are numbers that never leave this class."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, symbols = spec["model"]["vocab"], byte_symbols()
        self.byte = [0] * 256
        for character, byte in symbols.items():
            self.byte[byte] = vocabulary[character]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocabulary[left] << 20 | vocabulary[right]] = rank, vocabulary[left + right]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols that are left of one piece."""
        pairs = self.pairs
        symbol = [self.byte[b] for b in piece.encode("utf-8")]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = pairs.get(symbol[i] << 20 | symbol[i + 1])
            if found:
                heap.append(found[0] << 40 | i)
        heapq.heapify(heap)
        left = n
        while heap:
            entry = heapq.heappop(heap)
            i = entry & (1 << 40) - 1
            j = after[i]
            if symbol[i] < 0 or j >= n:
                continue
            found = pairs.get(symbol[i] << 20 | symbol[j])
            if not found or found[0] != entry >> 40:
                continue
            symbol[i], symbol[j] = found[1], -1
            left -= 1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                found = pairs.get(symbol[i] << 20 | symbol[j])
                if found:
                    heapq.heappush(heap, found[0] << 40 | i)
            h = before[i]
            if h >= 0:
                found = pairs.get(symbol[h] << 20 | symbol[i])
                if found:
                    heapq.heappush(heap, found[0] << 40 | h)
        return left

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for piece in self.pattern.findall(text):
            n = known.get(piece)
            if n is None:
                n = self.merged(piece)
                if len(piece) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


def _of_worker(path: str) -> Counter:
    """The counter of this Python worker, which outlives its tasks."""
    store = sys.modules.setdefault("_ponloom_counters", ModuleType("_ponloom_counters"))
    counters = store.__dict__.setdefault("counters", {})
    if path not in counters:
        counters[path] = Counter(path)
    return counters[path]


def token_counts(docs: DataFrame, path: str, text_col: str = "text", name: str = "tokens") -> DataFrame:
    """Add a struct with the number of tokens that the byte-level BPE file at ``path``, readable on every executor, gives a text."""

    def compute(column: pa.Array) -> dict:
        counter = _of_worker(path)
        return {"n_tokens": [counter.count(t.as_py() or "") for t in column]}

    return with_result(docs, text_col, name, RESULT, compute)
