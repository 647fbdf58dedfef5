"""Toxic spans, language and quality: exact parts against brute force, models by what they do with planted cases."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from ponloom.llm import langid, quality, toxicity
from ponloom.llm.words import words

EDGES = [(None, None), (1, ""), (1, ""), (2, "..."), (3, "x" * 200_000), (4, "word " * 60_000), (5, "日本語 текст"), (5, "日本語 текст")]


def prose(rng, words, size):
    return " ".join(rng.choice(words) for _ in range(size))


def test_marginals_equal_sums_over_all_tag_sequences(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    rng = np.random.default_rng(0)
    trans = np.exp(rng.normal(size=(2, 2)))
    trans[0, 0] = 1
    sizes = [0, 1, 2, 3, 4, 7, 9, 10, 0, 6]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    x = np.exp(rng.normal(size=offsets[-1]))
    found, log_z = toxicity.marginals(x, offsets, trans)
    for i, n in enumerate(sizes):
        own, total, one = x[offsets[i]:offsets[i + 1]], 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            weight, before = 1.0, 0
            for t, tag in enumerate(tags):
                weight *= trans[before, tag] * (own[t] if tag else 1)
                before = tag
            total += weight
            one += weight * np.array(tags, float)
        if n:
            assert np.allclose(found[offsets[i]:offsets[i + 1]], one / total)
            assert np.isclose(log_z[i], np.log(total))


def labelled_texts(seed=2):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(4000)}" for _ in range(2000)]
    rows = []
    for i in range(400):
        text = prose(rng, words, rng.randint(10, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text[rng.randrange(len(text))] = rng.choice(["vileword", "foulword", "badword"])
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxic_documents_and_spans(spark):
    rows = labelled_texts()
    model = toxicity.fit(spark.createDataFrame(rows, "id int, text string, toxic int"))
    fresh = labelled_texts(seed=3)
    docs = spark.createDataFrame(fresh, "id int, text string, toxic int").withColumnRenamed("toxic", "score")
    out = toxicity.score(docs, model).collect()
    assert {r["id"] for r in out if (r["toxicity"]["score"] >= 0.5) != bool(r["score"])} == set()
    for r in out:
        marked = {r["text"][s["start"]:s["end"]] for s in r["toxicity"]["spans"]}
        assert {w for m in marked for w in m.split()} == {w for w in r["text"].split() if w.endswith("word")}


@pytest.mark.parametrize("labels", [[], [(1, "a b", 1)], [(1, "a b", 0), (2, "c d", None)]])
def test_toxicity_without_both_labels(spark, labels):
    model = toxicity.fit(spark.createDataFrame(labels, "id int, text string, toxic int"))
    rates = {r["toxicity"]["score"] for r in toxicity.score(spark.createDataFrame(EDGES, "id int, text string"), model).collect()}
    assert rates == {float(bool(labels) and labels[0][2])}


def test_edge_texts_get_scores(spark):
    docs = spark.createDataFrame(EDGES, "id int, text string").withColumn("toxicity", docs_column())
    tox = toxicity.fit(spark.createDataFrame(labelled_texts(), "id int, text string, toxic int"))
    qual = quality.fit(spark.createDataFrame(graded_texts(), "id int, text string, quality int"))
    lang = langid.fit(spark.createDataFrame(texts_by_language(), "text string, lang string"))
    for scored, name in ((toxicity.score(docs, tox), "toxicity"), (quality.score(docs, qual), "quality")):
        values = [r[name]["score"] for r in scored.collect()]
        assert len(values) == len(EDGES) and all(0 <= x <= 1 for x in values)
        assert values[1] == values[2] and values[-1] == values[-2]
    found = [r["language"] for r in langid.identify(docs, lang).collect()]
    assert [f["lang"] == "und" for f in found] == [True, True, True, True, False, False, False, False]
    assert [f["score"] for f in found[:4]] == [0.0] * 4
    for scored in (toxicity.score(docs.limit(0), tox), quality.score(docs.limit(0), qual), langid.identify(docs.limit(0), lang)):
        assert scored.collect() == []


def docs_column():
    from pyspark.sql import functions as F

    return F.lit("a column of this name is replaced")


def texts_by_language(seed=5):
    rng = random.Random(seed)
    roots = {"aa": ["the", "thing", "wing", "ing", "that", "with"], "bb": ["der", "die", "ung", "sch", "und", "über"], "cc": ["que", "ción", "los", "rra", "las", "ñas"]}
    rows = []
    for i in range(300):
        lang = list(roots)[i % 3]
        rows.append((" ".join("".join(rng.choice(roots[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 40))), lang))
    return rows


def test_language_of_known_and_unseen_words(spark):
    rows = texts_by_language()
    model = langid.fit(spark.createDataFrame([*rows, (None, "aa"), ("abc", None)], "text string, lang string"))
    fresh = texts_by_language(seed=6)
    out = langid.identify(spark.createDataFrame(fresh, "text string, lang string"), model).collect()
    assert sum(r["language"]["lang"] == r["lang"] for r in out) >= 0.97 * len(out)
    # A word that no training text has, made of the same parts.
    assert langid.identify(spark.createDataFrame([("ungschungüberung",)], "text string"), model).first()["language"]["lang"] == "bb"
    nothing = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert langid.identify(spark.createDataFrame([("abc",)], "text string"), nothing).first()["language"]["lang"] == "und"


def test_all_words_seen_often_are_learned(spark):
    rows = [(" ".join([f"{lang}word{k}"] * 3), lang) for lang, size in (("aa", 45_000), ("bb", 10)) for k in range(size)]
    together = [(" ".join(t for t, _ in rows[at:at + 500]), rows[at][1]) for at in (*range(0, 45_000, 500), 45_000)]
    model = langid.fit(spark.createDataFrame(together, "text string, lang string"))
    assert len(model.keys) == 45_010
    out = langid.identify(spark.createDataFrame(rows, "text string, lang string"), model).collect()
    assert all(r["language"]["known_words"] == 3 for r in out)
    assert all(r["language"]["lang"] == r["lang"] for r in out)


def test_every_language_is_learned(spark):
    rows = [(f"text{k} text{k} text{k} word", f"l{k:03}") for k in range(230)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == [lang for _, lang in rows]
    out = langid.identify(spark.createDataFrame(rows, "text string, lang string"), model).collect()
    assert all(r["language"]["lang"] == r["lang"] for r in out)


def test_rates_are_those_of_whole_matrices(spark, monkeypatch):
    rows = texts_by_language()
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    counts, at = {}, {lang: k for k, lang in enumerate(model.langs)}
    for text, lang in rows:
        for w in text.split():
            counts.setdefault(w, np.zeros(3))[at[lang]] += 1
    counts = {w: np.where(n >= 2, n, 0) for w, n in counts.items() if (n >= 2).any()}
    often = [w for w in sorted(counts) if counts[w].sum() >= 3]
    row = model.table(0)(np.concatenate([w.hashes for _, _, w in words(pa.array(often))]))
    assert sorted(row) == list(range(len(model.keys)))
    assert np.allclose(model.rates[row], langid.log_rates(np.array([counts[w] for w in often]), 0.1))
    for size in range(1, langid.LONGEST + 1):
        grams, word = langid.n_grams(list(counts), size)
        keys, back = np.unique(grams, return_inverse=True)
        weights = np.zeros((len(keys), 3))
        np.add.at(weights, back, np.sqrt(np.array(list(counts.values())))[word])
        row = model.table(size)(keys)
        assert sorted(row) == list(range(len(model.gram_keys[size])))
        assert np.allclose(model.gram_rates[size][row], langid.log_rates(weights, 0.1), atol=1e-4)
    docs = spark.createDataFrame(texts_by_language(seed=6), "text string, lang string").coalesce(1)
    whole = langid.identify(docs, model).collect()
    monkeypatch.setattr(langid, "CELLS", 21)
    column = pa.array([r["text"] for r in whole])
    assert [len(w.hashes) > 7 for _, _, w in words(column)] == [True]
    compute = [r["language"] for r in langid.identify(docs, model).collect()]
    assert compute == [r["language"] for r in whole]


def test_unseen_words_back_off_to_shorter_n_grams():
    counts = np.array([[3.0, 1.0]])
    grams = {n: np.zeros(0, np.uint64) for n in range(1, langid.LONGEST + 1)}
    rates = {n: np.zeros((0, 2), np.float32) for n in grams}
    grams[2], _ = langid.n_grams(["x"], 2)
    grams[2] = grams[2][:1]
    rates[2] = langid.log_rates(counts, 0.1)
    model = langid.Model(["p", "q"], np.zeros(0, np.uint64), np.zeros((0, 2), np.float32), grams, rates)
    scores = model.unseen(["xyz", "abc"])
    assert np.allclose(scores[0], rates[2][0]) and (scores[1] == 0).all()


def graded_texts(seed=7):
    rng = random.Random(seed)
    words = [f"word{rng.randrange(3000)}" for _ in range(1500)]
    rows = []
    for i in range(400):
        good = prose(rng, words, rng.randint(5, 60))
        bad = rng.choice([good.upper().replace(" ", "!! "), " ".join([rng.choice(words)] * 30), good.replace(" ", "### | ")])
        rows.append((i, bad if i % 3 == 0 else good.capitalize() + ".", int(i % 3 != 0)))
    return rows


def test_quality_on_held_out_texts(spark):
    model = quality.fit(spark.createDataFrame(graded_texts(), "id int, text string, quality int"))
    out = quality.score(spark.createDataFrame(graded_texts(seed=8), "id int, text string, label int"), model).collect()
    assert sum((r["quality"]["score"] >= 0.5) == bool(r["label"]) for r in out) >= 0.98 * len(out)


def test_pooling_in_slices_changes_nothing(spark, monkeypatch):
    import pyarrow as pa

    from ponloom.llm.words import words

    model = quality.fit(spark.createDataFrame(graded_texts(), "id int, text string, quality int"))
    column = pa.array([t for _, t, _ in graded_texts(seed=9)][:50] + [None, ""])
    whole = [model.features(w) for _, _, w in words(column, solid=True)]
    monkeypatch.setattr(quality, "SLICE", 7)
    assert all(np.allclose(a, model.features(w)) for a, (_, _, w) in zip(whole, words(column, solid=True)))


def test_pairs_of_tags_equal_sums_over_all_tag_sequences(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    rng = np.random.default_rng(4)
    offsets = np.array([0, 5, 5, 12, 13])
    x, trans = rng.uniform(0.1, 4, 13), rng.uniform(0.1, 3, (2, 2))
    want, got = np.zeros((2, 2)), np.zeros((2, 2))
    for a, b in zip(offsets, offsets[1:]):
        pairs, total = np.zeros((2, 2)), 0.0
        for tags in itertools.product((0, 1), repeat=b - a):
            weight = np.prod([trans[i, j] * (x[a + k] if j else 1) for k, (i, j) in enumerate(zip((0, *tags), tags))])
            total += weight
            for i, j in zip((0, *tags), tags):
                pairs[i, j] += weight
        want += pairs / total
    toxicity.marginals(x, offsets, trans, got)
    assert np.allclose(got, want) and np.isclose(got.sum(), 13)


def test_capitals_of_all_scripts_are_learned_and_read_alike(spark):
    rows = [(k, f"ΟΔΟΣ ΛΟΓΟΣ ΝΗΣΟΣ ΜΕΡΟΣ {w}", "el") for k, w in enumerate(["ΤΟΠΟΣ", "ΧΡΟΝΟΣ"] * 4)]
    rows += [(k + 90, "İSTANBUL IRMAK ISIR İKİ", "tr") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, langid.fit(docs, id_col="doc_id")).collect()
    assert all(r["language"]["lang"] == r["lang"] and r["language"]["known_words"] == r["language"]["n_words"] for r in out)


def test_vectors_come_from_all_documents(spark):
    """Words that no labelled document has get vectors of their own, however many there are."""
    labelled = spark.createDataFrame([(k, f"good text of words {k}" if k % 2 else "BUY!!! now >>>", k % 2) for k in range(60)], "doc_id long, text string, quality int")
    corpus = spark.createDataFrame([(" ".join(f"only{j}" for j in range(k % 7, 30_000, 7)),) for k in range(70)] + [(None,)], "text string")
    model = quality.fit(labelled, id_col="doc_id", corpus=corpus)
    assert len(model.keys) > 25_000 and len(model.vectors) == len(model.keys) + quality.SHAPES
    few = quality.fit(labelled, id_col="doc_id", corpus=corpus, min_share=0.5)
    assert len(few.keys) == 0


def test_counts_of_words_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    docs = spark.createDataFrame([(" ".join(f"w{(k * j) % 50}" for j in range(200)),) for k in range(40)], "text string")
    one = quality._vocabulary(docs, 5, 0.0), quality._context_vectors(docs, quality._vocabulary(docs, 5, 0.0))
    monkeypatch.setattr(quality, "HELD", 16)
    two = quality._vocabulary(docs, 5, 0.0), quality._context_vectors(docs, one[0])
    assert (one[0] == two[0]).all() and (one[1] == two[1]).all()


def test_every_mark_counts_and_whole_texts_train(spark):
    """More features mark toxic words than any bound, and the marks stand behind long clean stretches."""
    rng, bad = random.Random(9), [f"{a}{b}vile" for a in "abcdefgh" for b in "klmno"]
    calm = [f"w{k}" for k in range(600)]
    rows = [(k, f"{prose(rng, calm, 150)} {' '.join(bad) if k < 40 else ''}", int(k < 40)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, id_col="doc_id")
    out = toxicity.score(docs, model).collect()
    assert all((r["toxicity"]["score"] >= 0.5) == (r["toxic"] == 1) for r in out)
    assert all(sum(x["end"] - x["start"] for x in r["toxicity"]["spans"]) >= sum(map(len, bad)) for r in out if r["toxic"])
