import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ponloom.llm import words as w

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(w, "CHUNK", 64)
    rng = random.Random(1)
    docs = ["".join(rng.choice("abAB 0é.\n—日") for _ in range(rng.randint(0, 90))) for _ in range(400)]
    docs += ["", None, "x" * 5000, " " * 3000 + "ab cd", "word " * 3000]
    seen = {}
    for lo, hi, found in w.words(pa.array(docs, pa.string()), prefix=(3,), suffix=(3,)):
        for i in range(lo, hi):
            expected = PATTERN.findall(lower(docs[i] or ""))
            a, b = found.offsets[i - lo], found.offsets[i - lo + 1]
            assert [found.text(k) for k in range(a, b)] == expected
            for k, word in zip(range(a, b), expected):
                assert seen.setdefault(word, found.hashes[k]) == found.hashes[k]
                head, tail = word.encode()[:3], word.encode()[-3:]
                assert seen.setdefault(("head", head), found.prefixes[3][k]) == found.prefixes[3][k]
                assert seen.setdefault(("tail", tail), found.suffixes[3][k]) == found.suffixes[3][k]
    hashes = [h for key, h in seen.items() if isinstance(key, str)]
    assert len(set(map(int, hashes))) == len(hashes)


def test_lookup_finds_all_and_only_its_keys():
    keys = w.mix(np.arange(5000, dtype=np.uint64))
    table = w.Lookup(keys)
    assert (table(keys) == np.arange(5000)).all()
    assert (table(w.mix(np.arange(6000, 7000, dtype=np.uint64))) == -1).all()
    assert (w.Lookup(np.zeros(0, np.uint64))(keys) == -1).all()
    with pytest.raises(ValueError):
        w.Lookup(np.array([1, 1], np.uint64))
