"""Near copies among embeddings by randomised-rotation binary codes.

A unit vector x is rotated at random; its code is the signs of the rotated vector, and stored beside the code is the correction
factor a = <code / sqrt(d), rotated x>. For another unit vector y, <code / sqrt(d), rotated y> / a estimates <x, y> without
bias, and as the part of the code that is orthogonal to x has length sqrt(1 - a^2), the error is at most
sqrt(1 - <x, y>^2) * sqrt(1 - a^2) / a. So a pair whose estimate is below t - sqrt(1 - t^2) * sqrt(1 - a^2) / a cannot reach
the similarity t; every other pair is computed exactly, in double precision.

Pairs to look at share a stretch of ``bits`` code bits in one of ``bands`` bands, taken from as many independent rotations as that needs.
At similarity 0.98 a bit differs with probability 0.064, and a pair is met in one of 24 bands of 16 bits with probability
1 - (1 - 0.936^16)^24 = 0.99997. Only vectors of one length with equal labels that are not null are compared. Vectors that are null or
zero, or hold null or non-finite components are linked with nothing. Equal vectors of one label are compared once,
as a class, and stand for each other; repeated ids are rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ponloom.llm.blocks import block_pairs, shared_buckets, verify
from ponloom.llm.components import components
from ponloom.llm.words import mix
from ponloom.operators.lineage import stored


@dataclass(frozen=True)
class Params:
    threshold: float = 0.98
    bits: int = 16
    bands: int = 24
    block: int = 512
    seed: int = 7


def rotations(dimension: int, p: Params) -> np.ndarray:
    """Random orthogonal matrices, as many as the bands need."""
    rng = np.random.default_rng(p.seed)
    count = -(-p.bits * p.bands // dimension)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dimension, dimension)))
        out.append(q * np.sign(np.diag(r)))
    return np.stack(out)


def encode(unit: np.ndarray, turn: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the first rotation (as -1 and 1), their correction factors, and the band keys."""
    turned = np.einsum("nd,ked->nke", unit, turn)
    signs = turned >= 0
    code = np.where(signs[:, 0], 1, -1).astype(np.int8)
    factor = np.abs(turned[:, 0]).sum(1) / np.sqrt(unit.shape[1])
    bits = signs.reshape(len(unit), -1)[:, :p.bits * p.bands].reshape(len(unit), p.bands, p.bits)
    keys = (bits.astype(np.int64) << np.arange(p.bits)).sum(2)
    return code, factor, keys


def may_reach(estimate: np.ndarray, factor: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs whose similarity can be ``threshold`` or more by the bound on the error of the estimate."""
    spread = np.sqrt(np.maximum(0.0, 1 - factor ** 2)) / np.maximum(factor, 1e-12)
    return estimate >= threshold - np.sqrt(1 - threshold ** 2) * spread - 1e-9


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", params: Params = Params()) -> DataFrame:
    """One row per row of ``vectors``: id, n_links (other rows linked directly), component_id (smallest id reachable), kept (the id is that one)."""
    p = params
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    # The digest of label and vector names a class; -0.0 counts as 0.0.
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    item = F.unhex(F.md5(F.concat_ws("|", F.lit("v"), F.hex(F.col("label").cast("binary")), F.array_join(same.cast("array<string>"), ","))))
    marks = stored(rows.withColumn("item", F.when(fine, item)), "vectors")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for whole in batches:
            sizes = whole.column(1).value_lengths().to_numpy()
            for dimension in np.unique(sizes).tolist():
                batch = whole.take(pa.array(np.flatnonzero(sizes == dimension)))
                values = batch.column(1).flatten().to_numpy().reshape(-1, dimension)
                unit = values / np.abs(values).max(1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                if dimension not in turns:
                    turns[dimension] = rotations(dimension, p)
                signs, factor, keys = encode(unit, turns[dimension], p)
                labels = [hashlib.blake2b(f"{dimension} {x}".encode(), digest_size=8).digest() for x in batch.column(2).to_pylist()]
                keys = mix(keys.view(np.uint64) ^ np.frombuffer(b"".join(labels), "<u8")[:, None]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([x.tobytes() for x in unit.astype("<f8")], pa.binary()), pa.array([np.packbits(x > 0).tobytes() for x in signs], pa.binary()),
                    pa.array(factor), pa.array(list(keys), pa.list_(pa.int64())), batch.column(3),
                ], names=["item", "unit", "code", "factor", "keys", "weight"])

    classes = marks.filter("item IS NOT NULL").groupBy("item").agg(F.first("vector").alias("vector"), F.first("label").alias("label"), F.count("*").alias("weight"))
    coded = stored(classes.select("item", "vector", "label", "weight").mapInArrow(code, "item binary, unit binary, code binary, factor double, keys array<long>, weight long"), "codes")
    pairs = block_pairs(shared_buckets(coded.select("item", "keys")), p.block)

    def prepare(batch: pa.RecordBatch) -> list:
        get = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()
        return [(np.frombuffer(u, "<f8"), np.frombuffer(c, np.uint8), f) for u, c, f in zip(get("unit"), get("code"), get("factor"))]

    def compare(things: list) -> np.ndarray:
        unit = np.stack([t[0] for t in things])
        dimension = unit.shape[1]
        signs = np.unpackbits(np.stack([t[1] for t in things]), axis=1, count=dimension).astype(np.float32) * 2 - 1
        factor = np.array([t[2] for t in things])
        if dimension not in first_turn:
            first_turn[dimension] = rotations(dimension, p)[0]
        turned = (unit @ first_turn[dimension].T).astype(np.float32)
        estimate = signs @ turned.T / np.float32(np.sqrt(dimension)) / factor[:, None]
        # The allowance is for single precision.
        maybe = may_reach(estimate + 1e-5, factor[:, None], p.threshold)
        i, j = np.nonzero(np.triu(maybe & maybe.T, 1))
        exact = np.einsum("nd,nd->n", unit[i], unit[j]) >= p.threshold
        linked = np.zeros(maybe.shape, bool)
        linked[i[exact], j[exact]] = linked[j[exact], i[exact]] = True
        return linked

    first_turn: dict[int, np.ndarray] = {}
    found = stored(verify(pairs.join(coded, "item"), ["unit", "code", "factor"], prepare, compare), "links")
    links = found.filter("other IS NULL").groupBy("item").agg(F.sum("weight").alias("links"))
    placed = components(found.filter("other IS NOT NULL").select(F.col("item").alias("a"), F.col("other").alias("b")))
    lowest = marks.filter("item IS NOT NULL").groupBy("item").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
    known = lowest.join(links, "item", "left").join(placed.withColumnRenamed("node", "item"), "item", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "item")), "vectors-placed")
    first = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(first, "root").select("item", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return marks.select("id", "item").join(known, "item", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("item").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
