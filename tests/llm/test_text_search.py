"""Near copies, embeddings, benchmark passages, licenses, shards: against brute force or SQL."""

import random
import time
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ponloom.llm import contamination, licenses, near_text, near_vectors, sharding
from ponloom.llm.license_texts import TEMPLATES


def linked_groups(ids, linked):
    """Links of each row and the smallest id of its component."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    lowest = {}
    for i, x in enumerate(ids):
        r = find(i)
        lowest[r] = min([v for v in (lowest.get(r), x) if v is not None], default=None)
    return links, [lowest[find(i)] for i in range(len(ids))]


def texts_with_copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(30, 200))
        for _ in range(rng.randint(1, 40)):
            copy = list(base)
            for _ in range(rng.randint(0, 8)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    docs += ["a b", "A b!", "", None, "...", None, "a b c d e f g", "x"] + [" ".join(words[:100])] * 30
    return [(i if i % 37 else None, t) for i, t in enumerate(docs)] + [(5, docs[5])]


@pytest.mark.parametrize("block", [16, 256])
def test_near_copies_equal_all_pairs(spark, block):
    rows = texts_with_copies()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item string, keys int")
    out = near_text.near_duplicates(docs, params=near_text.Params(block=block)).collect()
    sets = [set(s.tolist()) for s in near_text.n_gram_sets(pa.array([t for _, t in rows], pa.string()), 5)]
    links, lowest = linked_groups(
        [i for i, _ in rows], lambda i, j: bool(sets[i]) and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    expected = Counter((i, links[k], lowest[k] if sets[k] else i) for k, (i, _) in enumerate(rows))
    assert Counter((r["id"], r["n_links"], r["component_id"]) for r in out) == expected
    # One text of each group, here with its repeated row.
    kept = [(r["id"], r["text_hash"]) for r in out if r["kept"]]
    assert len(set(kept)) == len(kept) - sum(n - 1 for n in Counter(kept).values())
    assert near_text.near_duplicates(docs.limit(0)).collect() == []


def test_shared_counts_in_narrow_stripes():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, size=rng.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    found = near_text.shared_counts(sets, width=7)
    for i in range(30):
        for j in range(30):
            if i != j:
                assert found[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, unit = [], []
    for i in range(300):
        base = rng.standard_normal(24) if i % 5 == 0 or not rows else np.array(rows[-1][1])
        vector = base * rng.uniform(0.5, 2) + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.2])
        rows.append((i, [float(x) for x in vector], int(i // 50 % 2)))
    inf, nan = float("inf"), float("nan")
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [None] * 24, 1), (904, [nan] * 24, 1), (905, [inf] * 24, 1), (906, rows[0][1], None), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (908, [2.0, 4.0], 0), (None, [2.0, 4.0], 0)]
    rows += odd
    for _, v, label in rows:
        fine = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v) / np.linalg.norm(v) if fine else None)

    def linked(i, j):
        a, b = unit[i], unit[j]
        return a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and float(a @ b) >= 0.98

    links, lowest = linked_groups([r[0] for r in rows], linked)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = near_vectors.near_duplicates(frame, params=near_vectors.Params(block=32)).collect()
    assert Counter((r["id"], r["n_links"], r["component_id"]) for r in out) == Counter((r[0], links[k], lowest[k]) for k, r in enumerate(rows))
    assert near_vectors.near_duplicates(frame.limit(0)).collect() == []


def test_estimates_are_unbiased_and_their_bound_holds():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 32))
    x[1::2] = x[::2] + 0.1 * rng.standard_normal((200, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    errors = []
    for seed in range(20):
        p = near_vectors.Params(seed=seed)
        turn = near_vectors.rotations(32, p)
        code, factor, _ = near_vectors.encode(x, turn, p)
        estimate = code @ (x @ turn[0].T).T / np.sqrt(32) / factor[:, None]
        exact = x @ x.T
        slack = np.sqrt(np.maximum(0, 1 - exact ** 2)) * (np.sqrt(1 - factor ** 2) / factor)[:, None]
        assert (np.abs(estimate - exact) <= slack + 1e-9).all()
        assert near_vectors.may_reach(estimate, factor[:, None], 0.98)[exact >= 0.98].all()
        errors.append((estimate - exact)[~np.eye(400, dtype=bool)].mean())
    assert abs(np.mean(errors)) < 0.005


DOCS = [
    (1, "a b c d e f g h i j k"), (1, None), (None, "x b C, d-e! f z g h i j"), (3, ""), (4, "short one"), (5, "short. ONE short one"),
    (6, "short"), (8, "a x b x c x d x e x f x g x h x i x j"), (8, "a x b x c x d x e x f x g x h x i x j"), (9, "no " * 50_000 + "a b c d e f g h i j"),
    (10, "p q x q y r"), (11, "p x q r p q z q z z r p"), (12, "r q p q r"),
]
ITEMS = [(9, "a b c d e f g h i j"), (10, "short one"), (None, "e f"), (11, None), (12, ""), (9, "one short"), (13, "b c d e f g h i j k l"), (14, "p q r"), (15, "q p q")]


def reach(w, wanted, at, slop, step):
    """All places where the words of ``wanted`` can end that follow ``at`` forth (1) or back (-1)."""
    places = {at}
    for word in wanted:
        places = {k for p in places for k in range(p + step, p + step * (slop + 2), step) if 0 <= k < len(w) and w[k] == word}
    return places


def brute_passages(slop, rare=None):
    """Occurrences by trying all positions around each place of a passage's rarest word of the block."""
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    out, count = [], Counter(x for _, t in DOCS for x in words(t))
    for i, text in DOCS:
        w, hit, items = words(text), set(), set()
        for item, passage in ITEMS:
            p = words(passage)
            for at in range(max(1, len(p) - 9) if p else 0):
                wanted = p[at:at + 10]
                rarest = min(range(len(wanted)), key=lambda k: count[wanted[k]])
                for s in (k for k in range(len(w)) if w[k] == wanted[rarest]):
                    ends, begins = reach(w, wanted[rarest + 1:], s, slop, 1), reach(w, wanted[:rarest][::-1], s, slop, -1)
                    if ends and begins:
                        hit.update(range(max(begins), min(ends) + 1))
                        items.add(item)
        out.append((i, len(w), len(hit), frozenset(items)))
    return Counter(out)


@pytest.mark.parametrize("slop", [0, 1, 2, 3])
@pytest.mark.parametrize("per_pass", [200_000, 2])
def test_passages_equal_brute_force(spark, slop, per_pass):
    # One block, so that the rarest word of a passage is the same for all documents.
    docs = spark.createDataFrame([(*d, 0, "x") for d in DOCS], "doc_id long, text string, block int, id string").coalesce(1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = contamination.search(contamination.build_index(docs), items, slop=slop, per_pass=per_pass).collect()
    assert Counter((r["id"], r["n_words"], r["n_hit"], frozenset(r["items"])) for r in out) == brute_passages(slop)


def test_spans_of_several_passes_are_merged(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(40))), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(a, b))) for k, (a, b) in enumerate([(0, 25), (20, 30), (35, 37), (36, 40)])], "item_id long, text string")
    index = contamination.build_index(docs)
    one, many = (sorted((r["id"], r["n_hit"], r["spans"], sorted(r["items"])) for r in contamination.search(index, items, per_pass=n).collect()) for n in (1000, 1))
    assert one == many and [tuple(x) for x in one[0][2]] == [(0, 30), (35, 40)]


def test_passages_of_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination.search(contamination.build_index(docs.limit(0)), items).collect() == []
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in contamination.search(contamination.build_index(docs), items.limit(0)).collect())


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_template_is_found_in_prose(name):
    scanner = licenses.Scanner(TEMPLATES)
    text = "foo bar " * 50 + TEMPLATES[name].replace(" ", "\n", 3) + " baz qux" * 70
    _, found = scanner.scan(text)
    assert [f["license"] for f in found] == [name] and found[0]["differences"] == 0
    assert text[found[0]["start"]:found[0]["end"]].split() == TEMPLATES[name].rstrip("./").split()


@pytest.mark.parametrize("name", sorted(n for n, t in TEMPLATES.items() if len(licenses.WORD.findall(t)) >= 10))
@pytest.mark.parametrize("place", ["first", "last"])
@pytest.mark.parametrize("put", ["qqq", ""])
def test_changed_or_missing_word_at_an_end_of_a_wording(name, place, put):
    words = licenses.WORD.findall(TEMPLATES[name])
    gone = words[0 if place == "first" else -1].lower()
    changed = [put, *words[1:]] if place == "first" else [*words[:-1], put]
    text = "foo bar " * 50 + " ".join(changed) + " baz qux" * 70
    found = licenses.Scanner({name: TEMPLATES[name]}).scan(text)[1]
    assert [(f["license"], f["differences"], f["missing"], f["added"]) for f in found] == [(name, 1, [gone], [])]
    assert text[found[0]["start"]:found[0]["end"]].split() == (words[1:] if place == "first" else words[:-1])


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def all_stretches(words, wanted, allowed):
    """The best stretch over all begins and ends, then the best of those that do not overlap it, and so on."""
    size, offers = len(wanted), []
    for begin in range(len(words)):
        for end in range(begin + 1, min(len(words), begin + size + allowed) + 1):
            agreeing = common(wanted, words[begin:end])
            differences = max(size, end - begin) - agreeing
            if differences <= allowed:
                offers.append((differences, -agreeing, end - begin, begin))
    taken = []
    for _, _, length, begin in sorted(offers):
        if all(begin >= e or begin + length <= b for b, e in taken):
            taken.append((begin, begin + length))
    return sorted(taken)


@pytest.mark.parametrize("seed", range(4))
def test_wordings_equal_those_over_all_begins_and_ends(seed):
    rng = random.Random(seed)
    for _ in range(60):
        wanted = rng.choices("abcdefghij", k=rng.randint(1, 25))
        words = []
        for _ in range(rng.randint(1, 2)):
            words += rng.choices("abcdefghijxy", k=rng.randint(0, 12))
            words += [rng.choice("abcxy") if rng.random() < 0.05 else w for w in wanted if rng.random() > 0.05]
        words += rng.choices("abcdefghijxy", k=rng.randint(0, 12))
        scanner = licenses.Scanner({"t": " ".join(wanted)}, tolerance=rng.choice([0.1, 0.2]))
        found = scanner.wordings(words, scanner.templates[0])
        assert [(a, b) for a, b, _, _ in found] == all_stretches(words, wanted, int(scanner.tolerance * len(wanted)))
        for a, b, missing, added in found:
            assert len(wanted) - len(missing) == b - a - len(added) == common(wanted, words[a:b])


def test_neighbouring_wordings_are_all_found_without_differences():
    scanner, names = licenses.Scanner(TEMPLATES), sorted(TEMPLATES)
    for seed in range(40):
        random.Random(seed).shuffle(names)
        found = scanner.scan(" and then ".join(["Look here", *(TEMPLATES[n] for n in names)]))[1]
        assert [(f["license"], f["differences"]) for f in found] == [(n, 0) for n in names]


def test_a_long_text_of_short_notices():
    start = time.time()
    text = "All rights reserved. " * 250_000
    assert len(licenses.Scanner(TEMPLATES).scan(text)[1]) == 250_000
    assert time.time() - start < 30


def test_changed_wordings_and_edges(spark):
    changed = TEMPLATES["MIT text"].replace("furnished", "given").replace("free of charge", "free")
    unlike = "this license gives rights and permission to copy, the work of the public and the warranty"
    rows = [(1, f"{'xx ' * 900}{changed}\nMore. All RIGHTS reserved."), (2, unlike), (None, None), (3, ""), (3, ""), (4, "license " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 AS found")
    out = licenses.scan(docs).collect()
    first = out[0]["licenses"]["found"]
    assert [f["license"] for f in first] == ["MIT text", "All rights reserved"]
    assert first[0]["differences"] == 3 and set(first[0]["missing"]) == {"of", "charge", "furnished"} and first[0]["added"] == ["given"]
    assert all(r["licenses"]["found"] == [] for r in out[1:])
    assert licenses.scan(docs.limit(0)).collect() == []


def shards_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    return by


def test_shards_have_equal_bytes_and_gapless_slots(spark):
    rng = random.Random(6)
    rows = [(i, "same text" * 10) for i in range(3000)] + [(None, None)] * 5 + [(1, "")] * 7 + [(i, "t" * rng.randint(1, 60)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS shard", "0 AS _range")
    out = sharding.shard(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(rows)
    by = shards_of(out)
    sizes = [sum(r["size"] for r in by[s]) for s in range(8)]
    assert sum(sizes) == sum(len((t or "").encode()) + 1 for _, t in rows)
    assert max(sizes) - min(sizes) <= 0.025 * sum(sizes) / 8
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    # Equal texts stay together but for the group that is larger than a shard.
    homes = defaultdict(set)
    for r in out:
        homes[r["text"]].add(r["shard"])
    assert sum(len(s) > 1 for s in homes.values()) <= 7


def test_rows_that_are_all_alike_are_cut(spark):
    docs = spark.createDataFrame([(1, "the same")] * 4000 + [(2, None)] * 800, "doc_id long, text string").repartition(5)
    by = shards_of(sharding.shard(docs).collect())
    sizes = [sum(r["size"] for r in by[s]) for s in range(8)]
    assert sum(sizes) == 4000 * 9 + 800 and max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 8
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())


def test_shards_of_few_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 100_000), (2, None)], "doc_id long, text string")
    assert sorted(r["size"] for r in sharding.shard(docs).collect()) == [1, 100_001]
    assert sharding.shard(docs.limit(0)).collect() == []


def test_counts_below_boundaries_are_exact(spark):
    rng = random.Random(8)
    rows = [(rng.choice([5, -7, 1 << 60]), rng.randint(-50, 50), rng.randint(1, 9)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "text_key long, id_key long, size long")
    bounds = [(t, i) for t in (5, -7, 0, 1 << 60) for i in (sharding.LOWEST, -3, 0, 77)]
    found = sharding._below(frame, bounds)
    assert found == {b: sum(s for t, i, s in rows if (t, i) < b) for b in bounds}
