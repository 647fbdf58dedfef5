"""Token counts and packing against the tokenizer library and a sequential best fit."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from ponloom.llm import bpe, packing  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
rng = random.Random(1)
TEXTS = ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "x" * 5000, " " * 3000, "hello world's", "\u0000​", "<|endoftext"] + [
    "".join(rng.choice("ab éß日\U0001f600'st \n\t.!?0123ZQ\xa0") for _ in range(rng.randint(0, 80))) for _ in range(500)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_counts_and_ids_are_those_of_the_library(library):
    counter, tokenizer = bpe.Counter(PATH), packing.Tokenizer(PATH)
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(ids)
        assert tokenizer.ids(text) == ids


def test_ids_of_every_code_point(library):
    """Each character alone, doubled, between letters, digits, spaces and signs."""
    tokenizer = packing.Tokenizer(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20_000):
        text = "".join(f"a{c}b {c}{c} 1{c}.\n{c}'s" for c in points[at:at + 20_000])
        assert tokenizer.ids(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("space", [" ", "\n", "\xa0"])
def test_ids_of_very_long_white_space(library, space):
    text = f"word<|endoftext|>{space * 1_500_000}after it's"
    assert packing.Tokenizer(PATH).ids(text) == library.encode(text, add_special_tokens=False).ids


def test_very_long_white_space_is_packed(spark, library):
    rows = [(1, "a" + " " * 1_500_000 + "b"), (2, "c" + "\n" * 1_500_000 + "d"), (3, "short")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id int, text string"), PATH).collect()
    for i, text in rows:
        ids = b"".join(p["ids"] for p in sorted((p for p in out if p["id"] == i), key=lambda p: p["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, packing.SEPARATOR]


def test_forgetting_pieces_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    counter = bpe.Counter(PATH)
    assert [counter.count(t) for t in TEXTS[:60]] == [len(library.encode(t, add_special_tokens=False).ids) for t in TEXTS[:60]]


def test_counts_of_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS[:40])] + [(None, None), (1, TEXTS[1])]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "7 AS tokens")
    out = bpe.token_counts(docs, PATH).collect()
    assert Counter((r["doc_id"], r["tokens"]["n_tokens"]) for r in out) == Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert bpe.token_counts(docs.limit(0), PATH).collect() == []


def best_fit(lengths, size):
    open_ = []
    for length in sorted(lengths, reverse=True):
        tightest = min((r for r in open_ if r >= length), default=None)
        if tightest is None:
            open_.append(size - length)
        else:
            open_[open_.index(tightest)] -= length
    return sorted(open_)


@pytest.mark.parametrize("seed", range(60))
def test_plan_equals_sequential_best_fit(seed):
    r = random.Random(seed)
    size = r.choice([16, 64])
    lengths = [r.randint(1, size) for _ in range(r.randint(0, 150))]
    places, n = packing.plan(dict(Counter(lengths)), size)
    windows, used = defaultdict(list), Counter()
    for p in places:
        used[p.length] += p.count
        for k in range(p.count):
            windows[p.sequence + k].append((p.offset, p.length))
    assert used == Counter(lengths) and len(windows) == n
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert sorted(size - sum(x for _, x in p) for p in windows.values()) == best_fit(lengths, size)


def test_every_id_lies_in_one_piece(spark, library):
    r = random.Random(3)
    rows = [(i, "word " * r.randint(0, 900)) for i in range(60)] + [(None, None), (None, None), (3, ""), (4, "long " * 9000)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS part", "2 AS nth"), PATH, size=256).collect()
    sequences = defaultdict(list)
    for p in out:
        sequences[p["sequence_id"]].append(p)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] * 4 == len(p["ids"])
            at += p["length"]
        assert at <= 256
    made = Counter()
    by = defaultdict(list)
    for p in out:
        by[p["id"], p["doc_tokens"]].append(p)
    for (i, n), pieces in by.items():
        starts = defaultdict(list)
        for p in pieces:
            starts[p["start"]].append(p["ids"])
        copies = len(starts[0])
        ids = np.frombuffer(b"".join(starts[s][0] for s in sorted(starts)), "<u4").tolist()
        assert len(ids) == n and all(len(v) == copies for v in starts.values())
        made[i, tuple(ids)] += copies
    assert made == Counter((i, (*library.encode(t or "", add_special_tokens=False).ids, 0)) for i, t in rows)
    assert packing.pack(spark.createDataFrame([], "doc_id int, text string"), PATH).collect() == []


def test_tree_finds_the_tightest_window():
    r = random.Random(4)
    tree, counts = packing.OpenWindows(20), Counter()
    for _ in range(500):
        capacity = r.randint(0, 20)
        change = 1 if not counts[capacity] or r.random() < 0.5 else -1
        counts[capacity] += change
        tree.add(capacity, change)
        need = r.randint(0, 20)
        assert tree.tightest(need) == min((c for c, n in counts.items() if n and c >= need), default=None)
