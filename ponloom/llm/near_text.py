"""Near copies among texts: an n-gram Jaccard join by MinHash banding.

Two texts are linked if the Jaccard similarity of their sets of word 5-grams is at least 0.8. Words are those of
``words.py``; a text of fewer words than n has one n-gram, all its words. Texts with equal n-gram sets form a class, and
only classes are compared. ``rows`` minima of independent hash functions make a band, and classes that agree in one of
``bands`` bands are compared on their full n-gram sets. With 4 rows and 16 bands a pair of similarity 0.8 is found with
probability 1 - (1 - 0.8^4)^16 = 0.9998, one of 0.9 with 1 - 3e-8; pairs that share little are seldom looked at.

Texts without words (null, empty, punctuation) are linked with nothing. Repeated rows are copies of each other. Null ids
are allowed; the id of a class is the smallest of its ids that is not null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ponloom.llm.blocks import block_pairs, shared_buckets, verify
from ponloom.llm.components import components
from ponloom.llm.words import mix, words
from ponloom.operators.lineage import stored


@dataclass(frozen=True)
class Params:
    n: int = 5
    threshold: float = 0.8
    bands: int = 16
    rows: int = 4
    block: int = 256


def n_gram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text."""
    out: list[np.ndarray] = []
    for lo, hi, w in words(column):
        h = np.zeros(len(w.hashes), np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + np.append(w.hashes[k:], np.zeros(min(k, len(h)), np.uint64))[:len(h)]
        h = mix(h)
        for i in range(hi - lo):
            a, b = int(w.offsets[i]), int(w.offsets[i + 1])
            if b - a >= n:
                out.append(np.unique(h[a:b - n + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64)
                for x in w.hashes[a:b]:
                    short = mix(short + x)
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return (seeds[:count] | np.uint64(1)).astype(np.uint32), seeds[count:].astype(np.uint32)


def band_keys(grams: np.ndarray, p: Params, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 64-bit key for each band."""
    low, high = grams.astype(np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(p.bands * p.rows, np.uint32(0xFFFFFFFF))
    for at in range(0, len(grams), 2048):
        h = low[at:at + 2048, None] * table[0][None, :] + table[1][None, :]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= high[at:at + 2048, None]
        h *= table[0][None, :]
        np.minimum(least, h.min(0), out=least)
    key = np.zeros(p.bands, np.uint64)
    for r in range(p.rows):
        key = mix(key * np.uint64(31) + least.reshape(p.bands, p.rows)[:, r].astype(np.uint64) + np.uint64(1))
    return key


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each two sets have in common, as products of 0/1 matrices over elements of more than one set."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = seen[col] > 1
    number = np.cumsum(seen > 1) - 1
    row, col = row[keep], number[col[keep]]
    total = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(col, [at, at + width])
        m = np.zeros((len(sets), min(width, int(number[-1]) + 1 - at)), np.float32)
        m[row[a:b], col[a:b] - at] = 1
        total += m @ m.T
    return total


def compare_sets(threshold: float):
    def compare(sets: list[np.ndarray]) -> np.ndarray:
        size = np.array([len(s) for s in sets], np.float64)
        both = shared_counts(sets).astype(np.float64)
        return both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    return compare


def signatures(docs: DataFrame, id_col: str, text_col: str, p: Params) -> DataFrame:
    """(id, text_hash, item, keys): the digest of the n-gram set and the band keys of each row; null without words."""
    table = _multipliers(p.bands * p.rows)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = n_gram_sets(part.column(2), p.n)
                items = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                keys = [band_keys(s, p, table).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(items, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ], names=["id", "text_hash", "item", "keys"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, text_hash long, item binary, keys array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """One row per row of ``docs``: id, text_hash, class_id, n_links, component_id, kept.

    ``class_id`` is the smallest id with the same n-gram set, ``n_links`` the number of other rows linked directly,
    ``component_id`` the smallest id reachable by links. ``kept`` holds for the row of that id (of several rows with it, for
    those of one text; repeated rows are alike and all kept or all not).
    """
    p = params
    marks = stored(signatures(docs, id_col, text_col, p), "signatures")
    classes = stored(marks.filter("item IS NOT NULL").groupBy("item").agg(
        F.count("*").alias("weight"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("rep"), F.first("keys").alias("keys"),
    ), "classes")
    pairs = stored(block_pairs(shared_buckets(classes.select("item", "keys")), p.block), "block-pairs")
    needed = classes.join(pairs.select("item").distinct(), "item", "left_semi").select("item", "keys", "weight", "rep.id", "rep.text_hash")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("payload")).withColumn("_hash", F.xxhash64("payload"))
    same = (texts["_hash"] == needed["text_hash"]) & texts["_id"].eqNullSafe(needed["id"])
    loaded = texts.join(needed, same).select("item", "keys", "weight", "payload").dropDuplicates(["item"])
    found = stored(verify(
        pairs.join(loaded, "item"), ["payload"],
        lambda batch: n_gram_sets(batch.column(batch.schema.get_field_index("payload")), p.n), compare_sets(p.threshold),
    ), "links")
    links = found.filter("other IS NULL").groupBy("item").agg(F.sum("weight").alias("links"))
    placed = components(found.filter("other IS NOT NULL").select(F.col("item").alias("a"), F.col("other").alias("b")))
    known = classes.select("item", "rep", "weight").join(links, "item", "left").join(placed.withColumnRenamed("node", "item"), "item", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "item")), "classes-placed")
    lowest = known.groupBy("root").agg(F.min("rep").alias("first"))
    known = known.join(lowest, "root").select(
        "item", F.col("rep.id").alias("class_id"), "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    alone, first = F.col("item").isNull(), F.col("first")
    return marks.select("id", "text_hash", "item").join(known, "item", "left").select(
        "id", "text_hash", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(alone, F.col("id")).otherwise(first["id"]).alias("component_id"),
        (alone | (F.col("id").eqNullSafe(first["id"]) & (F.col("text_hash") == first["text_hash"]))).alias("kept"),
    )
