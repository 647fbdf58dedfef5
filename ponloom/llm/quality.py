"""Quality of whole texts: random-indexing vectors pooled per document, then a small network with calibrated probabilities.

Tokens are runs without white space. A token has a word (its characters, A-Z as a-z) and a shape (capitals, signs, digits, length,
and whether it repeats the token before it). Each term, word or shape, has a sparse random index vector that follows
from its hash; its context vector is the sum of the index vectors of the terms around it in all documents. Words that are not
in the vocabulary are represented by their shape. A document is the mean of its word vectors and of its shape vectors and the mean
change of both from one token to the next. A network with one hidden layer, in numpy, gives log odds, and a
temperature and an offset fitted on documents kept apart turn them into probabilities.

Null and empty texts have no tokens; they get the score that the network gives the mean of all documents. Repeated rows get
equal scores. Without labels of both kinds every document gets the share of label 1 (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ponloom.llm.frames import bounded_sample, class_counts, labelled_rows, with_result, without_copies
from ponloom.llm.words import Lookup, Words, mix, words
from ponloom.operators.lineage import stored

DIMENSION, NONZERO, NEAR, SLICE = 32, 4, 2, 65536
#: Tokens, or words with counts, that a task holds before it sums them up.
HELD = 1 << 19
#: Weight, in tokens, of the mean of all documents in that of one.
PRIOR_TOKENS = 4
SHAPES = 3 * 4 * 2 * 5 * 2
RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_tokens", T.LongType())])

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_DIGIT = (_B >= 48) & (_B <= 57)
_LETTER = _UPPER | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_SIGN = ~_LETTER & ~_DIGIT & (_B > 32)


def shapes(w: Words) -> np.ndarray:
    """Shape number of each token."""
    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[w.data], dtype=np.int64)])
        return total[w.ends] - total[w.starts]

    size = w.ends - w.starts
    upper, sign = count(_UPPER), count(_SIGN)
    lower = size - upper - sign - count(_DIGIT)
    capital = np.where(upper == 0, 0, np.where((upper > 1) & (lower == 0), 2, 1))
    repeated = np.zeros(len(size), np.int64)
    repeated[1:] = w.hashes[1:] == w.hashes[:-1]
    repeated[w.offsets[:-1][np.diff(w.offsets) > 0]] = 0
    out = capital * 4 + np.minimum(sign, 3)
    out = out * 2 + (upper + lower + sign < size)
    out = out * 5 + np.searchsorted([2, 4, 8, 16], size, "right")
    return out * 2 + repeated


def index_vectors(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero components of the index vector of each term."""
    h = np.stack([mix(keys ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) for k in range(1, NONZERO + 1)], 1)
    return (h % np.uint64(DIMENSION)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0).astype(np.float32)


def _shape_keys() -> np.ndarray:
    return mix(np.arange(SHAPES, dtype=np.uint64) + np.uint64(1 << 40))


@dataclass
class Model:
    """Words, vectors of words and then shapes, and the network; without a network every score is ``rate``."""

    keys: np.ndarray
    vectors: np.ndarray
    rate: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: list | None = None
    temperature: float = 1.0
    offset: float = 0.0
    lookup: Lookup | None = field(default=None, repr=False)

    def rows(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Vector number of the word and of the shape of each token."""
        if self.lookup is None:
            self.lookup = Lookup(self.keys)
        shape = shapes(w) + len(self.keys)
        row = self.lookup(w.hashes)
        return np.where(row >= 0, row, shape), shape

    def features(self, w: Words) -> np.ndarray:
        """Pooled vectors of each document, in slices, so that a long text needs no more memory than many short ones."""
        n = len(w.offsets) - 1
        out = np.zeros((n, 4 * DIMENSION))
        sizes = np.diff(w.offsets)
        doc = np.repeat(np.arange(n), sizes)
        inner = np.ones(len(doc), bool)
        inner[w.offsets[:-1][sizes > 0]] = False
        for part, row in enumerate(self.rows(w)):
            for a in range(0, len(doc), SLICE):
                b = min(a + SLICE, len(doc))
                runs = np.flatnonzero(np.r_[True, doc[a + 1:b] != doc[a:b - 1]])
                here = doc[a:b][runs]
                value = self.vectors[row[max(a - 1, 0):b]]
                own = value[len(value) - (b - a):]
                out[here, part * DIMENSION:(part + 1) * DIMENSION] += np.add.reduceat(own, runs, axis=0)
                change = np.zeros_like(own)
                change[b - a - len(value) + 1:] = np.abs(np.diff(value, axis=0))
                change[~inner[a:b]] = 0
                out[here, (part + 2) * DIMENSION:(part + 3) * DIMENSION] += np.add.reduceat(change, runs, axis=0)
        return out / np.maximum(sizes, 1)[:, None]

    def inputs(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Standard scores of the features. A short text says little, so its mean is drawn towards that of all."""
        return np.clip((features - self.mean) / self.scale, -8, 8) * (sizes / (sizes + PRIOR_TOKENS))[:, None]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    def probability(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(features), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.log_odds(self.inputs(features, sizes)) / self.temperature + self.offset, -40, 40)))


def excerpts(w: Words) -> Words:
    """A stretch of 1 to 32 tokens of each document, chosen by its first word's hash and its size."""
    sizes = np.diff(w.offsets)
    first = np.append(w.hashes, np.uint64(0))[np.minimum(w.offsets[:-1], len(w.hashes))]
    h = mix(first + sizes.astype(np.uint64))
    short = np.minimum(sizes, 1 + (h % np.uint64(32)).astype(np.int64))
    begin = w.offsets[:-1] + ((h >> np.uint64(8)) % np.maximum(sizes - short + 1, 1).astype(np.uint64)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(short)])
    at = np.repeat(begin, short) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], short)
    return Words(w.hashes[at], w.starts[at], w.ends[at], offsets, w.base, w.data, {}, {})


def _vocabulary(corpus: DataFrame, min_count: int, min_share: float) -> np.ndarray:
    """Words that are at least ``min_share`` of all tokens, so at most its inverse many; sums are made in the tasks before the shuffle."""
    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        merged, at = np.unique(np.concatenate(keys), return_inverse=True)
        return merged, np.bincount(at, np.concatenate(counts), len(merged)).astype(np.int64)

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    def run(batches):
        keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for _, _, w in words(batch.column(0), solid=True):
                some, n = np.unique(w.hashes, return_counts=True)
                keys.append(some)
                counts.append(n.astype(np.int64))
                held += len(some)
                if held > HELD:
                    merged, n = summed(keys, counts)
                    if len(merged) > HELD // 2:
                        yield rows(merged, n)
                        merged, n = merged[:0], n[:0]
                    keys, counts, held = [merged], [n], len(merged)
        yield rows(*summed(keys, counts))

    counted = corpus.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counted = stored(counted, "quality-words")
    total = counted.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = counted.filter(F.col("n") >= max(min_count, min_share * total)).select("key")
    return np.sort(often.toArrow()["key"].to_numpy().view(np.uint64))


def _context_vectors(corpus: DataFrame, keys: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of near terms, of unit length; a term whose sum is zero keeps its index vector."""
    terms = np.concatenate([keys, _shape_keys()])
    places, signs = index_vectors(terms)
    blank = Model(keys, np.zeros((len(terms), 1), np.float32), 0.0)

    def near_sums(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whole numbers, so that sums do not depend on the order. Parts are (document, row of the word, row of the shape) of tokens."""
        total, doc = np.zeros(len(terms) * DIMENSION, np.int64), np.concatenate([p[0] for p in parts])
        for kind in (1, 2):
            row = np.concatenate([p[kind] for p in parts])
            for step in range(1, NEAR + 1):
                near = doc[step:] == doc[:-step]
                left, right = row[:-step][near], row[step:][near]
                a, b = np.concatenate([left, right]) * DIMENSION, np.concatenate([right, left])
                for k in range(NONZERO):
                    total += np.bincount(a + places[b, k], signs[b, k], len(total)).astype(np.int64)
        return total

    def run(batches):
        total, parts, held, documents = np.zeros(len(terms) * DIMENSION, np.int64), [], 0, 0
        for batch in batches:
            for _, _, w in words(batch.column(0), solid=True):
                n = len(w.offsets) - 1
                parts.append((documents + np.repeat(np.arange(n), np.diff(w.offsets)), *blank.rows(w)))
                documents, held = documents + n, held + len(w.hashes)
                if held > HELD:
                    total += near_sums(parts)
                    parts, held = [], 0
        if parts:
            total += near_sums(parts)
        grid = total.reshape(-1, DIMENSION)
        some = np.flatnonzero(grid.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(grid[some, c]) for c in range(DIMENSION))], names=["term", *cells])

    cells = [f"c{c}" for c in range(DIMENSION)]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("term", *cells)])
    sums = corpus.select("text").mapInArrow(run, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in cells]).toArrow()
    vectors = np.zeros((len(terms), DIMENSION))
    vectors[sums["term"].to_numpy()] = np.stack([sums[c].to_numpy() for c in cells], 1)
    own = np.zeros_like(vectors)
    np.add.at(own, (np.arange(len(terms))[:, None], places), signs)
    # The own index vector, at half weight, keeps terms of like surroundings apart.
    length = lambda v: np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    vectors = vectors / length(vectors) + 0.5 * own / length(own)
    return (vectors / length(vectors)).astype(np.float32)


def train_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int, epochs: int, seed: int = 1) -> list:
    """Two layers by Adam on weighted cross-entropy, in shuffled batches."""
    rng = np.random.default_rng(seed)
    layers = [rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2 / x.shape[1]), np.zeros(hidden), rng.standard_normal(hidden) * np.sqrt(1 / hidden), 0.0]
    first, second, step = [0.0] * 4, [0.0] * 4, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            pick = order[at:at + 128]
            h = np.maximum(x[pick] @ layers[0] + layers[1], 0)
            p = 1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -30, 30)))
            d = weight[pick] * (p - y[pick]) / len(pick)
            back = np.outer(d, layers[2]) * (h > 0)
            grads = [x[pick].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ d + 1e-4 * layers[2], d.sum()]
            step += 1
            for k, g in enumerate(grads):
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 3e-3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return layers


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Temperature and offset of the smallest weighted cross-entropy, on a grid of temperatures with Newton steps for the offset."""
    best = (np.inf, 1.0, 0.0)
    for temperature in np.exp(np.linspace(-1.5, 3, 46)):
        offset = 0.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z / temperature + offset, -30, 30)))
            offset += float(np.clip((weight * (y - p)).sum() / ((weight * p * (1 - p)).sum() + 1e-3), -2, 2))
        p = np.clip(1 / (1 + np.exp(-np.clip(z / temperature + offset, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        best = min(best, (loss, float(temperature), offset))
    return best[1:]


def fit(
    labelled: DataFrame, text_col: str = "text", label_col: str = "quality", per_class: int = 2500, min_count: int = 5, min_share: float = 2e-5,
    hidden: int = 32, epochs: int = 30, id_col: str | None = None, corpus: DataFrame | None = None,
) -> Model:
    """Fit the network on a sample of about ``per_class`` labelled rows of each label, and the vectors on all of ``corpus``.

    Words of at least ``min_count`` occurrences and ``min_share`` of all tokens of the corpus get vectors of their own. Without a
    corpus all labelled rows are one.
    With ``id_col`` the sample is chosen by document, else by text, all copies or none.
    """
    rows = labelled_rows(labelled, F.coalesce(F.col(text_col), F.lit("")), F.col(label_col).cast("int"), id_col).filter("label IN (0, 1)")
    counts = class_counts(rows, "label", 2)
    n = sum(counts.values())
    model = Model(np.zeros(0, np.uint64), np.zeros((SHAPES, DIMENSION), np.float32), counts.get(1, 0) / n if n else 0.0)
    if len(counts) < 2:
        return model
    sample = stored(without_copies(bounded_sample(rows, counts, per_class)), "quality-sample")
    texts = (labelled if corpus is None else corpus).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    model.keys = _vocabulary(texts, min_count, min_share)
    model.vectors = _context_vectors(texts, model.keys)

    def pooled(batches):
        for batch in batches:
            for lo, hi, whole in words(batch.column(0), solid=True):
                # Excerpts stand for short texts, of which there are few.
                for w in (whole, excerpts(whole)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([v.tobytes() for v in model.features(w).astype("<f4")], pa.binary()),
                        batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(np.diff(w.offsets)),
                    ], names=["features", "label", "key", "size"])

    seen = sample.select("text", "label", F.xxhash64("text").alias("key")).mapInArrow(pooled, "features binary, label int, key long, size long").toArrow().sort_by([("key", "ascending"), ("size", "ascending")])
    y = seen["label"].to_numpy().astype(np.float64)
    if not 0 < y.sum() < len(y):
        return model
    x = np.stack([np.frombuffer(f, "<f4") for f in seen["features"].to_pylist()]).astype(np.float64)
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-3
    z = model.inputs(x, seen["size"].to_numpy().astype(np.float64))
    # Equal weight to both labels in training; the calibration restores their frequency in the labelled rows.
    even = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y).mean())
    natural = np.where(y == 1, counts[1] / n / y.mean(), counts[0] / n / (1 - y).mean())
    apart = seen["key"].to_numpy() % 5 == 0
    if min((y[apart] == 1).sum(), (y[apart] == 0).sum(), (y[~apart] == 1).sum(), (y[~apart] == 0).sum()) < 3:
        apart = np.zeros(len(y), bool)
    model.layers = train_network(z[~apart], y[~apart], even[~apart], hidden, epochs)
    check = apart if apart.any() else ~apart
    model.temperature, model.offset = calibrate(model.log_odds(z[check]), y[check], natural[check])
    model.lookup = None
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "quality") -> DataFrame:
    """Add a struct: the probability of label 1 and the number of tokens."""

    def compute(column: pa.Array) -> dict:
        scores, sizes = [np.zeros(0)], [np.zeros(0, np.int64)]
        for _, _, w in words(column, solid=True):
            sizes.append(np.diff(w.offsets))
            scores.append(model.probability(model.features(w), sizes[-1]))
        return {"score": np.concatenate(scores), "n_tokens": np.concatenate(sizes)}

    return with_result(docs, text_col, name, RESULT, compute)
