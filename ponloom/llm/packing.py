"""Packing of whole documents into sequences of a fixed number of tokens, by best-fit decreasing.

A document's ids are those of the tokenizer file plus one separator id. Documents longer than a window are first cut into full
windows; each rest is a piece. Best fit decreasing takes pieces from the longest to the shortest and puts each into the
tightest open window, found in a segment tree over remaining capacities. Windows with equal remaining capacity are
interchangeable, and so are pieces of equal length: the plan needs only how many pieces there are of each length, at
most one number per possible length, however many documents there are, and says for the r-th piece of a length where it goes.

Null and empty texts are documents of one id, the separator. Repeated rows and null ids are packed like any others.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ponloom.llm.bpe import PATTERN, byte_symbols
from ponloom.operators.lineage import stored

WINDOW = 1024
SEPARATOR = 0
#: Fixed value: tiktoken's pattern fails on a run of about a million characters of white space. Every run of twice this length fills a block.
SPACE_BLOCK = 100_000


class Tokenizer:
    """Ids of a byte-level BPE file, special strings inside texts as its added tokens.

    Texts with a very long run of white space go to the tokenizers library, all others to tiktoken, which gives the same ids sooner.
    """

    def __init__(self, path: str):
        import tiktoken

        self._path, self._library = path, None
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self._encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens=special)

    def ids(self, text: str) -> list[int]:
        if any(text[at:at + SPACE_BLOCK].isspace() for at in range(0, len(text) - SPACE_BLOCK + 1, SPACE_BLOCK)):
            if self._library is None:
                import tokenizers

                self._library = tokenizers.Tokenizer.from_file(self._path)
            return self._library.encode(text, add_special_tokens=False).ids
        return self._encoding.encode(text, allowed_special="all")


class OpenWindows:
    """How many windows are open at each remaining capacity, as a segment tree of sums."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = np.zeros(2 * self.leaves, np.int64)

    def add(self, remaining: int, count: int) -> None:
        at = self.leaves + remaining
        while at:
            self.tree[at] += count
            at >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` with an open window."""
        at = self.leaves + need
        if self.tree[at]:
            return need
        while at > 1:
            if not at & 1 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


@dataclass(frozen=True)
class Place:
    """Pieces number ``rank`` to ``rank + count`` of a length go to sequences from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], size: int = WINDOW) -> tuple[list[Place], int]:
    """Best-fit decreasing over numbers of pieces by length; also how many sequences there are."""
    open_ = OpenWindows(size)
    groups: dict[int, list[tuple[int, int]]] = {}
    places: list[Place] = []
    sequences = 0

    def put(remaining: int, first: int, count: int) -> None:
        if remaining and count:
            groups.setdefault(remaining, []).append((first, count))
            open_.add(remaining, count)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = open_.tightest(length)
            if remaining is None:
                # As many windows as are needed, each filled before the next one opens.
                remaining, first, count = size, sequences, -(-left // (size // length))
                sequences += count
            else:
                first, count = groups[remaining].pop()
                open_.add(remaining, -count)
            # One window takes pieces while they fit, as it stays the tightest.
            each = remaining // length
            full = min(count, left // each)
            for k in range(each if full else 0):
                places.append(Place(length, rank, full, first, size - remaining + k * length))
                rank += full
            left -= full * each
            put(remaining - each * length, first, full)
            first, count = first + full, count - full
            if count and 0 < left < each:
                for k in range(left):
                    places.append(Place(length, rank, 1, first, size - remaining + k * length))
                    rank += 1
                put(remaining - left * length, first, 1)
                first, count, left = first + 1, count - 1, 0
            put(remaining, first, count)
    return places, sequences


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(id, start, length, doc_tokens, ids, part, nth): ids as little-endian unsigned 32-bit numbers; ``nth`` counts the pieces of
    one length that a task made, so that ``part``, ``length`` and ``nth`` name a piece. Written to the shared folder.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length", "doc_tokens")),
        T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, made = Tokenizer(path), Counter()
        part = TaskContext.get().partitionId()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out: list[tuple] = []
                for row, text in enumerate(batch.column(1)):
                    ids = np.array([*tokenizer.ids(text.as_py() or ""), SEPARATOR], "<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start:start + size]
                        out.append((row, start, len(piece), len(ids), piece.tobytes(), made[len(piece)]))
                        made[len(piece)] += 1
                column = lambda k, t: pa.array([o[k] for o in out], t)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(column(0, pa.int64())), column(1, pa.int64()), column(2, pa.int64()), column(3, pa.int64()),
                    column(4, pa.binary()), pa.array(np.full(len(out), part, np.int32)), column(5, pa.int64()),
                ], names=[f.name for f in schema.fields])

    return stored(rows.mapInArrow(run, schema), "pieces")


def place(cut: DataFrame, size: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to pieces (columns length, part, nth and any others)."""
    made = stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, sequences = plan(counts, size)
    table: dict[int, list[Place]] = {}
    for p in places:
        table.setdefault(p.length, []).append(p)
    lookup = {
        length: tuple(np.array([getattr(p, c) for p in found], np.int64) for c in ("rank", "sequence", "offset"))
        for length, found in table.items()
    }
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = made.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("_rank", F.col("_before") + F.col("nth")).drop("_before", "part", "nth")
    schema = T.StructType([*ranked.drop("_rank").schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            values, begin = np.unique(length[order], return_index=True)
            for value, at, to in zip(values.tolist(), begin, [*begin[1:], len(order)]):
                here = order[at:to]
                ranks, first, offs = lookup[value]
                k = np.searchsorted(ranks, rank[here], "right") - 1
                sequence[here], offset[here] = first[k] + rank[here] - ranks[k], offs[k]
            kept = batch.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Pieces with their ids, sequence and offset."""
    return place(pieces(docs, path, id_col, text_col, size), size)
