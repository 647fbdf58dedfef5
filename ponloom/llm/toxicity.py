"""Toxic spans by a linear-chain conditional random field over words.

Token labels come from labelled documents: words and word beginnings or ends that occur in far more toxic than
other documents (a likelihood ratio test corrected for the number tested) mark a token as toxic where the document
is toxic. The field has two tags; its features are the word, its first 4 and 6 bytes, its last 4 bytes, and the words
beside it. Documents are scored from forward-backward marginals over the whole text.

Null and empty texts have no words and get the score of a document without any sign of toxicity. Repeated rows
get equal scores. Without labels of both kinds every document gets the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ponloom.llm.frames import bounded_sample, class_counts, labelled_rows, with_result, without_copies
from ponloom.llm.words import Lookup, Words, words
from ponloom.operators.lineage import stored

PREFIXES, SUFFIXES = (4, 6), (4,)
KINDS = 4
BLOCK = 64
#: Words of the sample whose gradient is computed at once.
PART = 1 << 17

RESULT = T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType()),
    T.StructField("expected_tokens", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("marginal", T.DoubleType()),
    ]))),
])


def kinds(w: Words) -> list[np.ndarray]:
    """Hashes of the features of each word itself."""
    return [w.hashes, w.prefixes[4], w.prefixes[6], w.suffixes[4]]


def marginals(x: np.ndarray, offsets: np.ndarray, trans: np.ndarray, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probability of tag 1 for each token, and log Z for each sequence. Expected pairs of neighbouring tags are added to ``pairs``.

    ``x`` is the weight of tag 1 of each token (tag 0 has weight 1), ``trans[i, j]`` that of tag j after i; a sequence
    starts after tag 0. Sequences are cut into blocks that run side by side: 2 x 2 products of whole blocks give the
    messages at their borders, so the result is exact and the number of steps does not grow with the longest text.
    """
    n_docs, sizes = len(offsets) - 1, np.diff(offsets)
    n_blocks = -(-sizes // BLOCK)
    total = int(n_blocks.sum())
    marginal, log_z = np.zeros(len(x)), np.zeros(n_docs)
    if not total:
        return marginal, log_z
    doc = np.repeat(np.arange(n_docs), n_blocks)
    first = np.cumsum(n_blocks) - n_blocks
    number = np.arange(total) - first[doc]
    begin = offsets[:-1][doc] + number * BLOCK
    length = np.minimum(BLOCK, offsets[1:][doc] - begin)
    order = np.argsort(-length, kind="stable")
    place = np.empty(total, np.int64)
    place[order] = np.arange(total)
    begin, length, number, doc = begin[order], length[order], number[order], doc[order]
    active = [int(np.searchsorted(-length, -t, "left")) for t in range(BLOCK)]
    (t00, t01), (t10, t11) = trans
    p00, p01, p10, p11 = np.ones(total), np.zeros(total), np.zeros(total), np.ones(total)
    for t in range(BLOCK):
        a = active[t]
        if not a:
            break
        w = x[begin[:a] + t]
        q00, q10 = p00[:a] * t00 + p01[:a] * t10, p10[:a] * t00 + p11[:a] * t10
        q01, q11 = (p00[:a] * t01 + p01[:a] * t11) * w, (p10[:a] * t01 + p11[:a] * t11) * w
        scale = 1 / (q00 + q01 + q10 + q11)
        p00[:a], p01[:a], p10[:a], p11[:a] = q00 * scale, q01 * scale, q10 * scale, q11 * scale
    start0, start1 = np.ones(total), np.zeros(total)
    end0, end1 = np.ones(total), np.ones(total)
    most = int(n_blocks.max())
    by_number = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[by_number], np.arange(most + 1))
    ahead = place[np.minimum(first[doc] + number + 1, total - 1)]
    behind = place[np.maximum(first[doc] + number - 1, 0)]
    for k in range(1, most):
        here = by_number[edges[k]:edges[k + 1]]
        prev = behind[here]
        s0 = start0[prev] * p00[prev] + start1[prev] * p10[prev]
        s1 = start0[prev] * p01[prev] + start1[prev] * p11[prev]
        start0[here], start1[here] = s0 / (s0 + s1), s1 / (s0 + s1)
    has_next = number < n_blocks[doc] - 1
    for k in range(most - 2, -1, -1):
        here = by_number[edges[k]:edges[k + 1]]
        here = here[has_next[here]]
        nxt = ahead[here]
        e0 = p00[nxt] * end0[nxt] + p01[nxt] * end1[nxt]
        e1 = p10[nxt] * end0[nxt] + p11[nxt] * end1[nxt]
        end0[here], end1[here] = e0 / (e0 + e1), e1 / (e0 + e1)
    a0, a1, norm = start0, start1, np.zeros(total)
    alpha = np.zeros((BLOCK, total))
    came = np.zeros((BLOCK, total)) if pairs is not None else None
    for t in range(BLOCK):
        a = active[t]
        if not a:
            break
        w = x[begin[:a] + t]
        if came is not None:
            came[t, :a] = a1[:a]
        n0, n1 = a0[:a] * t00 + a1[:a] * t10, (a0[:a] * t01 + a1[:a] * t11) * w
        scale = n0 + n1
        norm[:a] += np.log(scale)
        a0[:a], a1[:a] = n0 / scale, n1 / scale
        alpha[t, :a] = a1[:a]
    b0, b1 = end0, end1
    for t in range(BLOCK - 1, -1, -1):
        a = active[t]
        if not a:
            continue
        at, al = begin[:a] + t, alpha[t, :a]
        up, down = al * b1[:a], (1 - al) * b0[:a]
        marginal[at] = up / (up + down)
        w = x[at]
        if came is not None:
            last = came[t, :a]
            both = [(1 - last) * t00 * b0[:a], (1 - last) * t01 * w * b1[:a], last * t10 * b0[:a], last * t11 * w * b1[:a]]
            pairs += np.stack(both).dot(1 / np.add.reduce(both)).reshape(2, 2)
        n0, n1 = t00 * b0[:a] + t01 * w * b1[:a], t10 * b0[:a] + t11 * w * b1[:a]
        b0[:a], b1[:a] = n0 / (n0 + n1), n1 / (n0 + n1)
    np.add.at(log_z, doc, norm)
    return marginal, log_z


@dataclass
class Model:
    """A fitted field. ``keys`` are feature hashes, ``own``/``prev``/``next`` their weights for tag 1."""

    keys: np.ndarray
    own: np.ndarray
    prev: np.ndarray
    next: np.ndarray
    bias: float
    trans: np.ndarray
    calibration: np.ndarray
    rate: float
    lookup: Lookup | None = field(default=None, repr=False)

    def rows(self, feats: list[np.ndarray]) -> list[np.ndarray]:
        if self.lookup is None:
            self.lookup = Lookup(self.keys)
        return [self.lookup(f) for f in feats]

    def weights(self, rows: list[np.ndarray], offsets: np.ndarray) -> np.ndarray:
        """Weight of tag 1 of each token. The last entry of each weight list is that of an unknown feature, zero."""
        own, prev, next_ = (np.append(v, 0.0) for v in (self.own, self.prev, self.next))
        score = np.full(len(rows[0]), self.bias)
        for r in rows:
            score += own[r]
        after, before = neighbours(rows[0], offsets)
        return np.exp(np.clip(score + prev[before] + next_[after], -30, 30))

    def evidence(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Marginals by token, and per document: log odds of any toxic token, the largest marginal's, expected tokens, words."""
        marginal, log_z = marginals(self.weights(self.rows(kinds(w)), w.offsets), w.offsets, np.exp(self.trans))
        sizes = np.diff(w.offsets)
        some = sizes > 0
        expected, largest = np.zeros(len(sizes)), np.zeros(len(sizes))
        if some.any():
            at = w.offsets[:-1][some]
            expected[some] = np.add.reduceat(marginal, at)
            largest[some] = np.maximum.reduceat(marginal, at)
        log_z = np.maximum(log_z, 1e-9)
        any_ = np.where(log_z > 30, log_z, np.log(np.expm1(np.minimum(log_z, 30))))
        largest = np.clip(largest, 1e-6, 1 - 1e-6)
        rows = np.stack([np.clip(any_, -12, 12), np.log(largest / (1 - largest)), np.log1p(expected), np.log1p(sizes)], 1)
        return marginal, np.concatenate([rows, expected[:, None], sizes[:, None]], 1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.calibration):
            return np.full(len(rows), self.rate)
        z = self.calibration[0] + rows[:, :4] @ self.calibration[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def neighbours(rows: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the word after and before each word of the same sequence, -1 at its ends."""
    after, before = np.full(len(rows), -1, rows.dtype), np.full(len(rows), -1, rows.dtype)
    after[:-1], before[1:] = rows[1:], rows[:-1]
    begins, ends = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1
    before[begins], after[ends] = -1, -1
    return after, before


def _runs(column: pa.Array):
    return words(column, prefix=PREFIXES, suffix=SUFFIXES)


def _feature_counts(sample: DataFrame) -> DataFrame:
    """Documents of each label that hold a feature, summed inside each batch before the shuffle."""

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, w in _runs(batch.column(0)):
                doc = np.repeat(np.arange(lo, hi), np.diff(w.offsets))
                pairs = np.unique(np.stack([np.concatenate(kinds(w)), np.tile(doc, KINDS).astype(np.uint64)], 1), axis=0)
                one = label[pairs[:, 1].astype(np.int64)] == 1
                keys, at = np.unique(pairs[:, 0], return_inverse=True)
                toxic = np.bincount(at, one, len(keys)).astype(np.int64)
                clean = np.bincount(at, ~one, len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(toxic), pa.array(clean)], names=["key", "toxic", "clean"])

    counts = sample.select("text", "label").mapInArrow(run, "key long, toxic long, clean long")
    return counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """G statistic of a feature held by ``a`` of n1 and ``b`` of n0 documents; 0 if it is not more frequent in the first."""
    def term(k, n, p):
        return np.where(k > 0, k * np.log(np.maximum(k, 1) / (n * p)), 0.0) + np.where(n > k, (n - k) * np.log(np.maximum(n - k, 1) / (n * (1 - p))), 0.0)
    p = np.clip((a + b) / (n1 + n0), 1e-12, 1 - 1e-12)
    return np.where(a * n0 > b * n1, 2 * (term(a, n1, p) + term(b, n0, p)), 0.0)


def _features_seen(sample: DataFrame, least: int) -> np.ndarray:
    """Features of words that are there at least so often, sorted."""

    def run(batches):
        for batch in batches:
            for _, _, w in _runs(batch.column(0)):
                keys, n = np.unique(np.concatenate(kinds(w)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    counted = sample.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return np.sort(counted.filter(F.col("n") >= least).select("key").toArrow()["key"].to_numpy().view(np.uint64))


def _sequences(sample: DataFrame, keys: np.ndarray, marked: np.ndarray) -> DataFrame:
    """The words of each sampled document, as places of their features among ``keys``, with their tags.

    Marked tokens of other than toxic documents are tagged 0: they teach where a mark alone is no sign.
    """
    lookup, marks = Lookup(keys), Lookup(marked)

    def run(batches):
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, w in _runs(batch.column(0)):
                feats = kinds(w)
                hit = np.logical_or.reduce([marks(f) >= 0 for f in feats])
                rows = np.stack([lookup(f) for f in feats]).astype("<i4")
                spans = [(i, int(w.offsets[i]), int(w.offsets[i + 1])) for i in range(hi - lo) if w.offsets[i] < w.offsets[i + 1]]
                out = [rows[:, a:b].tobytes() for _, a, b in spans]
                tags = [(hit[a:b] & (label[lo + i] == 1)).astype(np.uint8).tobytes() for i, a, b in spans]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(tags, pa.binary())], names=["rows", "tags"])

    return sample.select("text", "label").mapInArrow(run, "rows binary, tags binary")


def _views(column: pa.ChunkedArray):
    """The bytes of each value, without a copy."""
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        data = np.frombuffer(chunk.buffers()[2], np.uint8)
        for a, b in zip(offsets, offsets[1:]):
            yield data[a:b]


@dataclass
class _Part:
    """Some sequences: places of features, tags, and where each sequence begins."""

    sequences: list[np.ndarray]
    tags: list[np.ndarray]

    def gradient(self, model: Model) -> dict:
        """Of the log likelihood, by the weights of the model, and the number of words."""
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tags])])
        rows, gold = list(np.concatenate(self.sequences, axis=1)), np.concatenate(self.tags)
        pairs, last = np.zeros((2, 2)), np.zeros_like(gold)
        last[1:] = gold[:-1]
        last[offsets[:-1]] = 0
        p, _ = marginals(model.weights(rows, offsets), offsets, np.exp(model.trans), pairs)
        miss = gold - p
        after, before = neighbours(rows[0], offsets)
        out = {"own": 0.0, "prev": 0.0, "next": 0.0, "bias": miss.sum(), "words": len(gold)}
        for name, r in [*(("own", r) for r in rows), ("prev", before), ("next", after)]:
            out[name] = out[name] + np.bincount(r[r >= 0], miss[r >= 0], len(model.keys))
        out["trans"] = np.bincount(2 * last + gold, minlength=4).reshape(2, 2) - pairs
        return out


def train_field(keys: np.ndarray, sequences: list[np.ndarray], tags: list[np.ndarray], steps: int = 40, decay: float = 1e-6) -> Model:
    """Maximise the likelihood of tagged sequences, given as places of features among ``keys``, with Adam on the full gradient.

    The gradient is summed over parts of the sequences, which bounds the memory beside the sequences themselves.
    """
    number = np.cumsum([len(t) for t in tags]) // PART
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(tags)]
    parts = [_Part(sequences[a:b], tags[a:b]) for a, b in zip(cuts, cuts[1:])]
    model = Model(keys, np.zeros(len(keys)), np.zeros(len(keys)), np.zeros(len(keys)), -3.0, np.array([[0.0, -1.0], [0.0, 0.0]]), np.zeros(0), 0.0)
    state = {}

    def adam(name, value, grad, step, rate=0.25):
        m, v = state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        state[name] = m, v
        return value + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    for step in range(1, steps + 1):
        total: dict = {}
        for part in parts:
            for name, value in part.gradient(model).items():
                total[name] = total.get(name, 0.0) + value
        for name in ("own", "prev", "next"):
            setattr(model, name, adam(name, getattr(model, name), total[name] - decay * total["words"] * getattr(model, name), step))
        model.bias = float(adam("bias", model.bias, total["bias"], step))
        # The weight of 0 after 0 is fixed: that of the other pairs and the bias say the same.
        model.trans = np.clip(adam("trans", model.trans, total["trans"] * np.array([[0.0, 1.0], [1.0, 1.0]]), step), -6, 6)
        model.trans[0, 0] = 0
    return model


def logistic(rows: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    x = np.concatenate([np.ones((len(rows), 1)), rows], 1)
    beta, keep = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (label - p)) - keep @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + keep, grad)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-7:
            break
    return beta


def fit(
    labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", per_class: int = 2500, min_ratio: float = 8.0,
    id_col: str | None = None,
) -> Model:
    """Fit on a sample of about ``per_class`` labelled rows of each label.

    Whole texts train the field. A feature marks tokens if it is at least ``min_ratio`` times as frequent among toxic documents and passes the test.
    With ``id_col`` the sample is chosen by document, else by text, all copies or none.
    """
    rows = labelled_rows(labelled, F.coalesce(F.col(text_col), F.lit("")), F.col(label_col).cast("int"), id_col).filter("label IN (0, 1)")
    counts = class_counts(rows, "label", 2)
    n = sum(counts.values())
    rate = counts.get(1, 0) / n if n else 0.0
    nothing = Model(np.zeros(0, np.uint64), *(np.zeros(0),) * 3, -30.0, np.zeros((2, 2)), np.zeros(0), rate)
    if len(counts) < 2:
        return nothing
    sample = stored(without_copies(bounded_sample(rows, counts, per_class)), "toxicity-sample")
    taken = class_counts(sample, "label", 2)
    if len(taken) < 2:
        return nothing
    n1, n0 = taken[1], taken[0]
    found = stored(_feature_counts(sample).filter("toxic >= 2"), "toxicity-features")
    least = 2 * math.log(max(found.count(), 1) / 0.05)

    def strong(batches):
        for batch in batches:
            a, b = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            yield batch.filter(pa.array((a * n0 >= min_ratio * (b + 0.5) * n1) & (likelihood_ratio(a, b, n1, n0) > least)))

    marked = np.sort(found.mapInArrow(strong, found.schema).toArrow()["key"].to_numpy().view(np.uint64))
    if not len(marked):
        return nothing
    keys = np.union1d(_features_seen(sample, 3), marked)
    taken = _sequences(sample, keys, marked).toArrow()
    if not len(taken):
        return nothing
    model = train_field(keys, [r.view("<i4").reshape(KINDS, -1) for r in _views(taken["rows"])], list(_views(taken["tags"])))
    del taken
    model.rate, model.lookup = rate, None

    def evidence(batches):
        for batch in batches:
            for lo, hi, w in _runs(batch.column(0)):
                _, out = model.evidence(w)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, k]) for k in range(4)] + [batch.column(1).slice(lo, hi - lo)], names=["a", "b", "c", "d", "label"])

    seen = sample.select("text", "label").mapInArrow(evidence, "a double, b double, c double, d double, label int").toArrow()
    label = seen["label"].to_numpy().astype(np.float64)
    if not 0 < label.sum() < len(label):
        return nothing
    weight = np.where(label == 1, counts[1] / label.sum(), counts[0] / (1 - label).sum()) * len(label) / n
    model.calibration = logistic(np.stack([seen[c].to_numpy() for c in "abcd"], 1), label, weight)
    model.lookup = None
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "toxicity", span_at: float = 0.5) -> DataFrame:
    """Add a struct: the score, the words, the expected toxic words, and the spans (character offsets) of words whose marginal is at least ``span_at``."""

    def compute(column: pa.Array) -> dict:
        scores, sizes, expected, spans = [], [], [], []
        for lo, hi, w in _runs(column):
            marginal, rows = model.evidence(w)
            scores.append(model.probability(rows))
            expected.append(rows[:, 4])
            sizes.append(rows[:, 5])
            hits = np.flatnonzero(marginal >= span_at)
            here = [[] for _ in range(hi - lo)]
            if len(hits):
                docs_of = np.searchsorted(w.offsets, hits, "right") - 1
                chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                last = (-1, -2)
                for d, k in zip(docs_of.tolist(), hits.tolist()):
                    s, e = int(chars[w.starts[k]] - chars[w.base[d]]), int(chars[w.ends[k]] - chars[w.base[d]])
                    if last == (d, k - 1):
                        here[d][-1]["end"] = e
                        here[d][-1]["marginal"] = max(here[d][-1]["marginal"], float(marginal[k]))
                    else:
                        here[d].append({"start": s, "end": e, "marginal": float(marginal[k])})
                    last = (d, k)
            spans += here
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
        return {"score": join(scores), "n_words": join(sizes).astype(np.int64), "expected_tokens": join(expected), "spans": spans}

    return with_result(docs, text_col, name, RESULT, compute)
