"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 64-bit hash of their text and, within it, by a hash of the id and of the row's place in the input, so equal texts
are neighbours. Probes, candidate boundaries in that order, are counted exactly over all partitions: how many bytes lie below each.
Around every target the probes draw closer until a boundary is found whose count is within the tolerance. Only counts below
probes come to the driver. Then rows are exchanged once, to ranges inside the shards, and each range starts where the ones before it end.

A boundary is the end of a group of equal texts where one lies within the tolerance, and else cuts through a group, also through rows that are
alike in all columns. So a shard can miss its share by more only through one long text. Null texts have no bytes and lie together;
null ids are one id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ponloom.llm.frames import unused
from ponloom.operators.lineage import stored

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
PROBES = 16
#: Bytes of text that a task of the exchange gets, about.
RANGE_BYTES = 64 << 20


@dataclass
class Target:
    """A boundary to be found: the bytes that should lie below it, and the interval known to hold it with the bytes below its ends."""

    bytes: int
    slack: float
    below_high: int
    below_low: int = 0
    low: int = LOWEST
    high: int = HIGHEST
    text: int | None = None
    found: tuple[int, int] | None = None

    def settle(self) -> None:
        """Take the nearer end of the interval."""
        if self.found is None:
            key = self.low if self.bytes - self.below_low <= self.below_high - self.bytes else self.high
            self.found = (key, LOWEST) if self.text is None else (self.text, key)

    def settle_if_near(self) -> None:
        if min(self.bytes - self.below_low, self.below_high - self.bytes) <= self.slack:
            self.settle()


def _cells(bounds: np.ndarray, text: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """How many of the sorted boundaries lie at or below each row."""
    low, high = np.searchsorted(bounds[:, 0], text, "left"), np.searchsorted(bounds[:, 0], text, "right")
    number = low.copy()
    inside = np.flatnonzero(high > low)
    inside = inside[np.argsort(low[inside], kind="stable")]
    for rows in np.split(inside, np.flatnonzero(np.diff(low[inside])) + 1) if len(inside) else ():
        first, last = low[rows[0]], high[rows[0]]
        number[rows] += np.searchsorted(bounds[first:last, 1], ids[rows], "right")
    return number


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in names]


def _below(rows: DataFrame, asked: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Exact bytes of the rows below each boundary, summed by every task before the shuffle."""
    bounds = np.array(sorted(set(asked)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            text, ids, size = _columns(batch, "text_key", "id_key", "size")
            np.add.at(total, _cells(bounds, text, ids), size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "bytes"])

    sums = rows.mapInArrow(run, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    cells = np.zeros(len(bounds) + 1, np.int64)
    for r in sums.collect():
        cells[r["cell"]] = r["bytes"]
    return dict(zip(map(tuple, bounds.tolist()), np.cumsum(cells)[:-1].tolist()))


def _refine(rows: DataFrame, targets: list[Target]) -> None:
    """Probe the intervals of all targets together until each has a boundary within its slack or no inner point is left."""
    while todo := [t for t in targets if t.found is None and t.high - t.low > 1]:
        asked = []
        for t in todo:
            step = max(1, (t.high - t.low) // (PROBES + 1))
            probes = [t.low + step * k for k in range(1, PROBES + 1) if t.low + step * k < t.high]
            asked.append([(p, LOWEST) if t.text is None else (t.text, p) for p in probes])
        below = _below(rows, [p for a in asked for p in a])
        for t, probes in zip(todo, asked):
            for p in probes:
                key = p[0] if t.text is None else p[1]
                if below[p] > t.bytes:
                    t.high, t.below_high = key, below[p]
                    break
                t.low, t.below_low = key, below[p]
            t.settle_if_near()


def splitters(rows: DataFrame, targets: list[Target]) -> list[tuple[int, int]]:
    """Boundaries (text hash, id hash), in order, for rows with text_key, id_key and size."""
    _refine(rows, targets)
    cut = [t for t in targets if t.found is None]
    if cut:
        # The rows with text_key = low hold the target: go on inside these groups of equal texts.
        texts = rows.sparkSession.createDataFrame([(x,) for x in sorted({t.low for t in cut})], "text_key long")
        # At most one text for each target.
        ends = rows.join(F.broadcast(texts), "text_key", "left_semi").groupBy("text_key").agg(F.min("id_key").alias("a"), F.max("id_key").alias("b"))
        found = {r["text_key"]: (r["a"], r["b"]) for r in ends.collect()}
        for t in cut:
            t.text = t.low
            first, last = found.get(t.text, (LOWEST, LOWEST))
            t.low, t.high = first, min(last + 1, HIGHEST)
            t.settle_if_near()
        _refine(rows, cut)
        for t in cut:
            t.settle()
    return [t.found for t in targets]


def _with_shard(rows: DataFrame, bounds: list[tuple[int, int]], text_key: str, id_key: str) -> DataFrame:
    """Add, as ``shard``, how many boundaries lie at or below each row."""
    edges = np.array(bounds, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = _cells(edges, *_columns(batch, text_key, id_key))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number.astype(np.int32))], names=[*batch.schema.names, "shard"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType())]))


def shard(docs: DataFrame, shards: int = 8, tolerance: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with size (UTF-8 bytes of the text plus one), shard and slot, which replace columns of these names.

    Each boundary between shards lies within half of ``tolerance`` times a shard's share of the bytes from its place.
    """
    text = F.col(text_col)
    docs = docs.drop("size", "shard", "slot")
    a, b, part, nth = (unused(docs, c) for c in ("_text_key", "_id_key", "_part", "_nth"))
    keyed = docs.withColumns({
        a: F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()), b: F.xxhash64(F.lit("id"), F.col(id_col), F.monotonically_increasing_id()),
        "size": (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long"),
    })
    narrow = stored(keyed.select(F.col(a).alias("text_key"), F.col(b).alias("id_key"), "size"), "keys")
    total = narrow.agg(F.sum("size").alias("b")).first()["b"] or 0
    share = total / shards
    found = splitters(narrow, [Target(round(share * k), tolerance / 2 * share, total) for k in range(1, shards)])
    # Inside the shards the rows are dealt by ranges of the same order, as many as there are tasks' worth of bytes.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    order = ["shard", a, b]
    exchanged = _with_shard(keyed, sorted(found), a, b).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Written with its range and its place there, from which the slots follow.
    placed = stored(exchanged.withColumns({part: F.spark_partition_id(), nth: F.monotonically_increasing_id()}), "shards")
    ranges = placed.groupBy("shard", part).agg(F.count("*").alias("n"), F.min(nth).alias("first"))
    # One row for each range of a shard.
    before = F.sum("n").over(Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.select("shard", part, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_start"))
    return placed.join(starts, ["shard", part]).withColumn("slot", (F.col("_start") + F.col(nth)).cast("long")).drop(part, nth, a, b, "_start")
