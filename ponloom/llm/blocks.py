"""Pairs that share a bucket, verified block by block and counted without being listed.

Items have one key in each of several bands; items with equal keys in a band share a bucket and are compared. A pair is
looked at once: in the first band in which its keys agree. A bucket of any size is cut into blocks by hash, and each
pair of blocks is a task's work of bounded size. What comes back is linear in the blocks: the weight of the links of each
item and the edges of a spanning forest of the links found there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

GROUP = ["band", "key", "left", "right"]


def shared_buckets(items: DataFrame) -> DataFrame:
    """(band, key, item, n) for items (item, keys array<long>) in buckets of two or more.

    Of buckets with the same members, as near copies have in most bands, the one of the first band stays. They are known
    by size and two 64-bit fingerprints of their members.
    """
    rows = items.select("item", F.posexplode("keys").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"))
    first = buckets.filter("n >= 2").groupBy("n", "x", "y").agg(F.min("band").alias("band"))
    # The key follows by joining back: hash aggregation handles only fixed-width minima.
    kept = buckets.filter("n >= 2").join(first, ["n", "x", "y", "band"], "left_semi").select("band", "key", "n")
    return rows.join(kept, ["band", "key"])


def block_pairs(members: DataFrame, block: int) -> DataFrame:
    """(band, key, left, right, part, item): each item in all pairs of blocks that its own block is part of."""
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = members.withColumn("part", F.pmod(F.xxhash64("item", F.lit("block")), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select("band", "key", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "item")


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component, from a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label[None, :], len(label)).min(1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verify(
    rows: DataFrame, payload_cols: list[str], prepare: Callable[[pa.RecordBatch], list], compare: Callable[[list], np.ndarray],
) -> DataFrame:
    """Compare within block pairs: (item, other, weight).

    ``rows`` have the group, ``part``, ``item`` (binary), ``keys`` (array of long), ``weight`` (how many rows an item stands for)
    and ``payload_cols``. ``prepare`` makes one object of each row of a batch; ``compare`` takes the objects of a block pair
    and says for each two of them whether they are linked. Output rows with ``other`` are edges; the others carry the weight
    of the items linked to ``item``.
    """

    def judge(band: int, part: list[int], items: list[bytes], keys: np.ndarray, weight: np.ndarray, things: list):
        n = len(items)
        if n < 2:
            return
        fresh = ~np.eye(n, dtype=bool)
        side = np.array(part)
        if side.min() != side.max():
            fresh &= side[:, None] != side[None, :]
        for b in range(band):
            fresh &= keys[:, b][:, None] != keys[:, b][None, :]
        if not fresh.any():
            return
        linked = compare(things) & fresh
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            return
        linked = linked[np.ix_(some, some)]
        totals, root = linked @ weight[some], _forest(linked)
        for k, i in enumerate(some.tolist()):
            yield items[i], None, int(totals[k])
            if root[k] != k:
                yield items[i], items[some[root[k]]], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, ([], [], [], [], [])

        def flush(out):
            if group is not None:
                out += judge(group[0], held[0], held[1], np.stack(held[2]), np.array(held[3], np.int64), held[4])

        def pack(out):
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int64()),
            ], names=["item", "other", "weight"])

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                out: list = []
                things = prepare(batch)
                where = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in GROUP)))
                part, item, weight = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "item", "weight"))
                lists = batch.column(batch.schema.get_field_index("keys"))
                keys = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for i, g in enumerate(where):
                    if g != group:
                        flush(out)
                        group, held = g, ([], [], [], [], [])
                    for store, value in zip(held, (part[i], item[i], keys[i], weight[i], things[i])):
                        store.append(value)
                yield pack(out)
        out = []
        flush(out)
        yield pack(out)

    dealt = rows.select(*GROUP, "part", "item", "keys", "weight", *payload_cols).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInArrow(run, "item binary, other binary, weight long")
