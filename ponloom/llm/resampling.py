"""Importance resampling towards a target: documents whose word runs the target favours are drawn more often, without replacement.

Features are the words and pairs of neighbouring words of a text, hashed to buckets by CRC-32. Every task counts buckets in an array, and only
sums by bucket are shuffled. A bucket's gain is the log ratio of its smoothed shares in target and corpus; a document weighs the mean of
its gains, and a Gumbel variate of its id makes the highest scores a weighted draw.

The draw is a parallel sort by regular sampling: scored rows lie in runs that are sorted locally, each run gives splitters at
regular places, the segments between splitters are exchanged and merged, and the counts of the segments before give exact ranks.
Only samples (``OVERSAMPLE`` keys for a segment of a million rows) and one count a segment reach the driver.

Defined results: null and empty texts have no features and weigh 0; a null id is hashed as an empty text and comes last among equals;
rows with equal id and score are ranked by weight and features, and else cannot be told apart; an empty target or corpus gives a draw by
the smoothed shares that are left; extra columns stay.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ponloom.llm.frames import unused, with_result
from ponloom.llm.words import LOWER, Words, words
from ponloom.operators.lineage import stored

#: Rows of a segment, about, and regular samples of all runs for each segment.
SEGMENT, OVERSAMPLE = 1 << 20, 64
_LONG = 64


class Crc:
    """CRC-32 of many byte strings at once, and of two strings joined from their sums.

    ``shift[n, k, b]`` is what byte ``k`` of a sum becomes when ``n`` more bytes follow.
    """

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
        self.table = table
        sums = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        rows = [sums]
        for _ in range(_LONG):
            rows.append(table[rows[-1] & 0xFF] ^ (rows[-1] >> 8))
        self.shift = np.stack(rows)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums of stretches of ``data``; long ones one by one."""
        size = ends - starts
        out = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        order = np.argsort(-size, kind="stable")
        lengths = -size[order]
        skip = int(np.searchsorted(lengths, -_LONG, "left"))
        at, state = starts[order], out[order]
        for k in range(int(size[order[skip]]) if skip < len(order) else 0):
            live = slice(skip, int(np.searchsorted(lengths, -k, "left")))
            state[live] = self.table[(state[live] ^ data[at[live] + k]) & 0xFF] ^ (state[live] >> 8)
        out[order] = ~state
        for i in order[:skip]:
            out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes())
        return out

    def joined(self, first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sums of first strings with second ones, of ``size`` bytes, behind them."""
        out = second.copy()
        short = size <= _LONG
        a, n = first[short], size[short]
        for k in range(4):
            out[short] ^= self.shift[n, k, (a >> np.uint32(8 * k)) & 0xFF]
        for i in np.flatnonzero(~short):
            rest, a = int(size[i]), first[i]
            while rest:
                step = min(rest, _LONG)
                a = np.bitwise_xor.reduce([self.shift[step, k, (a >> np.uint32(8 * k)) & 0xFF] for k in range(4)])
                rest -= step
            out[i] ^= a
        return out


_SPACE = np.uint32(zlib.crc32(b" "))


def features(found: Words, buckets: int, crc: Crc) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words of some documents, of their pairs, and which word each pair begins with."""
    data = LOWER[found.data]
    size = found.ends - found.starts
    single = crc.of(data, found.starts, found.ends)
    doc = np.repeat(np.arange(len(found.offsets) - 1), np.diff(found.offsets))
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    opened = crc.joined(single[pair], np.full(len(pair), _SPACE), np.ones(len(pair), np.int64))
    double = crc.joined(opened, single[pair + 1], size[pair + 1])
    return (single % np.uint32(buckets)).astype(np.int64), (double % np.uint32(buckets)).astype(np.int64), pair


def bucket_counts(docs: DataFrame, buckets: int = 10_000, text_col: str = "text") -> DataFrame:
    """(bucket, n): features of all texts, summed in every task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, crc = np.zeros(buckets, np.int64), Crc()
        for batch in batches:
            for _, _, found in words(batch.column(0)):
                single, double, _ = features(found, buckets, crc)
                total += np.bincount(single, minlength=buckets) + np.bincount(double, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return docs.select(F.col(text_col)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = 10_000, text_col: str = "text") -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down: one number a bucket reaches the driver."""
    n = np.zeros((2, buckets), np.int64)
    for row, table in zip(n, (corpus, target)):
        for r in bucket_counts(table, buckets, text_col).collect():
            row[r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = n.tolist(), (int(x) for x in n.sum(axis=1))
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


_WEIGHT = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text", name: str = "importance") -> DataFrame:
    """Add a struct of words, features and weight, the mean gain rounded down."""
    buckets = len(gain)

    def compute(text: pa.Array) -> dict:
        crc, n_words, n_features, total = Crc(), np.zeros(len(text), np.int64), np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        for lo, hi, found in words(text):
            single, double, pair = features(found, buckets, crc)
            worth = gain[single]
            worth[pair] += gain[double]
            sums = np.concatenate([[0], np.cumsum(worth)])
            n_words[lo:hi] = np.diff(found.offsets)
            total[lo:hi] = sums[found.offsets[1:]] - sums[found.offsets[:-1]]
        n_features[:] = 2 * n_words - (n_words > 0)
        return {"n_words": n_words, "n_features": n_features, "weight": total // np.maximum(n_features, 1)}

    return with_result(docs, text_col, name, _WEIGHT, compute)


def gumbel(id_col: str, seed: int) -> Column:
    """A Gumbel variate of the id in thousandths, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name.cast("binary"), 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _sampled(step: int):
    """Rows of a sorted run at regular places, ``step`` apart; the first place follows from the run's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() * 0x9E3779B1 % step
        for batch in batches:
            yield batch.take(pa.array(range(at, batch.num_rows, step), pa.int64()))
            at = (at - batch.num_rows) % step
    return run


def _placed(splitters: list[tuple], keys: int):
    """Rows of a sorted run with the number of their segment; a segment ends with its splitter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = list(zip(*(c.to_pylist() for c in batch.columns[:keys])))
            segment, lo = np.zeros(len(key), np.int32), 0
            while lo < len(key):
                j = bisect_left(splitters, key[lo])
                hi = bisect_right(key, splitters[j], lo) if j < len(splitters) else len(key)
                segment[lo:hi] = j
                lo = hi
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "segment"])
    return run


def ranked(rows: DataFrame, order: list[str], name: str, segment_rows: int = SEGMENT, oversample: int = OVERSAMPLE) -> DataFrame:
    """Add as ``name`` the exact rank, from 1, of every row by the columns ``order``, ascending; their values must differ in every two rows.

    ``rows`` are a written table: its splits are the runs, and are sorted where they are read.
    """
    session = rows.sparkSession
    rows = rows.select(*order, *[c for c in rows.columns if c not in order])
    n = rows.count()
    segments = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-n // segment_rows))
    step = max(1, n // (segments * oversample))
    runs = rows.sortWithinPartitions(*order)
    keys = runs.select(*order)
    samples = keys.mapInArrow(_sampled(step), keys.schema).toArrow().sort_by([(c, "ascending") for c in order])
    every = max(1, -(-samples.num_rows // segments))
    chosen = samples.take(pa.array(range(every - 1, samples.num_rows, every), pa.int64()))
    splitters = list(zip(*(c.to_pylist() for c in chosen.columns)))
    schema = T.StructType([*rows.schema.fields, T.StructField("segment", T.IntegerType())])
    exchanged = runs.mapInArrow(_placed(splitters, len(order)), schema)
    found = {r["segment"]: r["n"] for r in exchanged.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    starts = [0, *accumulate(found.get(s, 0) for s in range(len(splitters) + 1))]
    # One row a segment.
    before = F.broadcast(session.createDataFrame(list(enumerate(starts[:-1])), "segment int, before long"))
    inside = exchanged.withColumn("nth", F.row_number().over(Window.partitionBy("segment").orderBy(*order)))
    return inside.join(before, "segment").withColumn(name, F.col("before") + F.col("nth")).drop("segment", "nth", "before")


def draw(weighed: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, id_col: str = "doc_id", name: str = "importance") -> DataFrame:
    """Add score and rank, which replace columns of these names: the rank of the documents drawn, from 1, null for the others.

    Drawn are, rounded down, ``percent`` of the documents with ``min_words`` words, those with the highest scores; of equals the smaller id.
    All columns pass the exchange, so a caller drops long ones first.
    """
    rows = weighed.drop("score", "rank").withColumn("score", F.col(name)["weight"] + gumbel(id_col, seed))
    # Order columns of their own, under names that clash with none. The last one differs in every row and is written with it.
    parts = {"_down": -F.col("score"), "_no_id": F.col(id_col).isNull(), "_id": F.col(id_col), "_features": F.col(name)["n_features"],
             "_row": F.monotonically_increasing_id()}
    named = {unused(rows, c): value for c, value in parts.items()}
    rows = stored(rows.withColumns(named), "scored")
    able = F.col(name)["n_words"] >= min_words
    out = ranked(rows.where(able), list(named), "rank")
    drawn = percent * rows.where(able).count() // 100
    out = out.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return out.unionByName(rows.where(~able), allowMissingColumns=True).drop(*named)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000,
    id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
) -> DataFrame:
    """The rows of ``docs`` with the struct ``importance`` (n_words, n_features, weight), score and rank."""
    weighed = weigh(docs, gains(docs, target, buckets, text_col), text_col)
    return draw(weighed if keep_text else weighed.drop(text_col), percent, min_words, seed, id_col)
