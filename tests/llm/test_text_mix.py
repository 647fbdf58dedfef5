"""Importance draws and source mixes against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ponloom.llm import mixing, resampling

rng = random.Random(3)


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def features_of(text):
    w = words_of(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def texts(n):
    vocabulary = ["alpha", "Beta", "gam7", "été", "日本語", "x" * 70, "y" * 200, "z"] + [f"w{k}" for k in range(30)]
    return [" ".join(rng.choice(vocabulary) + rng.choice(["", ".", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def drawn(docs, target, percent=25, least=20, buckets=10_000, seed=7):
    """(id, n_features, weight, score, rank) by the words of the contract."""
    crc = {}
    count = [Counter(crc.setdefault(f, zlib.crc32(f.encode()) % buckets) for t in table for f in features_of(t)) for table in ([t for _, t in docs], target)]
    all_s, all_t = (sum(c.values()) for c in count)
    rows = []
    for i, text in docs:
        fs = features_of(text)
        gain = [math.floor(1000 * math.log((count[1][crc[f]] + 1) * (all_s + buckets) / ((count[0][crc[f]] + 1) * (all_t + buckets)))) for f in fs]
        weight = sum(gain) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def taken(df):
    return sorted(((r["doc_id"], r["importance"]["n_features"], r["importance"]["weight"], r["score"], r["rank"]) for r in df.collect()), key=repr)


def test_checksums_equal_zlib():
    crc = resampling.Crc()
    parts = ["", "a", "hello", "é" * 40, "long" * 60, "q" * 64, "q" * 65]
    data = np.frombuffer("".join(parts).encode(), np.uint8)
    ends = np.cumsum([len(p.encode()) for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    sums = crc.of(data, starts, ends)
    assert sums.tolist() == [zlib.crc32(p.encode()) for p in parts]
    for a in parts:
        one = np.full(len(parts), zlib.crc32(a.encode()), np.uint32)
        assert crc.joined(one, sums, ends - starts).tolist() == [zlib.crc32((a + b).encode()) for b in parts]


def test_draw_equals_the_plain_computation(spark):
    docs = list(enumerate(texts(300))) + [(300, None), (301, ""), (None, "alpha beta " * 30), (5, "z " * 40), (5, "z " * 40)]
    target = texts(20) + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS run", "1 AS score", "2 AS rank", "3 AS _down").repartition(5)
    out = resampling.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert taken(out) == drawn(docs, target)
    assert {"text", "run", "_down"} <= set(out.columns)


def test_ranks_do_not_depend_on_segments(spark):
    # Two thirds of the rows are alike in score and id.
    rows = [(k if k % 3 == 0 else 1, 50 if k % 3 == 0 else 7) for k in range(3000)]
    docs = spark.createDataFrame(rows, "id long, key long").selectExpr("*", "monotonically_increasing_id() AS row").repartition(6)
    for size in (50, 100_000):
        out = resampling.ranked(docs, ["key", "id", "row"], "rank", segment_rows=size, oversample=8).collect()
        assert [r["rank"] for r in sorted(out, key=lambda r: (r["key"], r["id"], r["row"]))] == list(range(1, 3001))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30), (2, "c")], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert taken(resampling.resample(some, none)) == drawn([(1, "a b " * 30), (2, "c")], [])
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, size long")).collect() == []


def targets_of(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        level = (total - sum(full.values())) / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if most * sizes[s] <= weight[s] * level]
        if not above:
            return {**{s: weight[s] * level for s in open_}, **full}
        full |= {s: most * sizes[s] for s in above}


def tilt_of(sizes, target, most=3):
    """By halving, far beyond the precision needed."""
    low, high = -50.0, math.log(most)
    for _ in range(200):
        middle = (low + high) / 2
        if sum(x * min(most, math.exp(min(middle * x, 5))) for x in sizes) < target:
            low = middle
        else:
            high = middle
    return high


@pytest.fixture(scope="module")
def mixed(spark):
    docs = []
    for s, n in ((None, 300), ("a", 4000), ("b", 60), ("ü", 900), ("", 800), ("tiny", 2), ("none", 5)):
        docs += [(len(docs) + k, s, 0 if s == "none" else int(rng.lognormvariate(4, 1)) + 1) for k in range(n)]
    docs += [(7, "hot", 40)] * 3000 + [(None, "hot", 10)] * 30 + [(8, "hot", None)] * 3
    frame = spark.createDataFrame(docs, "doc_id long, source string, size long").selectExpr("*", "1 AS rate", "2 AS target", "'m' AS m")
    return docs, frame, mixing.mix(frame).collect()


def test_targets_share_what_a_source_cannot_take(mixed):
    docs, _, out = mixed
    sizes = Counter()
    for _, s, x in docs:
        sizes[s] += x or 0
    want = targets_of(sizes)
    assert math.isclose(sum(want.values()), sum(sizes.values()))
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
    assert want["tiny"] == 3 * sizes["tiny"]


def test_rates_are_the_balanced_ones(mixed):
    docs, _, out = mixed
    by = defaultdict(list)
    for r in out:
        by[r["source"]].append(r)
    for s, rows in by.items():
        if rows[0]["source_size"]:
            tilt = tilt_of([r["size"] for r in rows], rows[0]["target"])
            for r in rows:
                assert r["size"] == 0 or math.isclose(r["rate"], min(3, math.exp(min(tilt * r["size"], 5))), rel_tol=1e-6)


def test_copies_hit_the_targets(mixed):
    docs, frame, out = mixed
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in out) == Counter((i, s, x or 0) for i, s, x in docs)
    total, longest = Counter(), Counter()
    for r in out:
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        assert abs(r["copies"] - r["rate"]) < 2
        total[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for r in out:
        assert abs(total[r["source"]] - r["target"]) <= max(longest[r["source"]], 1e-6)
        if r["source"] in ("a", "ü", "", None):
            assert abs(total[r["source"]] / r["target"] - 1) < 0.002


def test_reruns_and_other_partitions_agree(spark, mixed, monkeypatch):
    _, frame, out = mixed
    names = ("doc_id", "source", "size", "target", "taken")
    first = Counter(tuple(r[c] for c in names) for r in out)
    assert Counter(tuple(r[c] for c in names) for r in mixing.mix(frame.repartition(11)).collect()) == first
    monkeypatch.setattr(mixing, "BUCKET", 7)
    again = mixing.mix(frame).collect()
    assert Counter((r["source"], r["size"], r["taken"]) for r in again) == Counter((r["source"], r["size"], r["taken"]) for r in out)


def test_documents_are_repeated(spark):
    docs = spark.createDataFrame([(k, "ab"[k % 2], "w " * (k + 1)) for k in range(200)], "doc_id int, source string, text string")
    sized = docs.withColumn("size", mixing.size("text"))
    mix = mixing.mix(sized)
    want = {r["doc_id"]: r["copies"] for r in mix.collect()}
    got = Counter(r["doc_id"] for r in mixing.repeated(docs, mix).collect())
    assert got == Counter({i: n for i, n in want.items() if n})


def test_size_counts_runs_without_white_space(spark):
    rows = [(None, 0), ("", 0), (" \t", 0), ("a b\x0bc", 3), (" a b ", 1), ("x " * 100_000, 100_000)]
    assert [r[0] == r[1] for r in spark.createDataFrame(rows, "t string, n long").select(mixing.size("t"), "n").collect()] == [True] * len(rows)
