"""The registered queries of the text operators, and the pipeline on planted documents."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from ponloom.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    theirs = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in theirs.description]
    ours = queries.QUERIES[name](spark, DATA).select(*columns).collect()
    assert sorted(map(tuple, ours)) == sorted(theirs.fetchall())


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Prose in two languages with toxic words, near copies, benchmark passages, texts without letters and empty rows."""
    rng = random.Random(11)
    lexicon = {"aa": [f"{rng.choice(['the', 'wing', 'that'])}{rng.choice(['ing', 'on', 'er'])}{k}" for k in range(800)], "bb": [f"{rng.choice(['der', 'sch', 'ung'])}{rng.choice(['ü', 'keit', 'ach'])}{k}" for k in range(800)]}
    docs, labels, what = [], [], {}
    prose = lambda lang, n: rng.choices(lexicon[lang], k=n)
    items = [" ".join(prose("aa", 30)) for _ in range(5)]

    def add(text, lang, kind):
        i = len(docs)
        docs.append((i, text, lang, "s", None if text is None else len(text)))
        what[i] = kind
        return i

    for k in range(240):
        lang = "aa" if k % 3 else "bb"
        words = prose(lang, rng.randint(20, 120))
        if k % 5 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vileword", "foulword"])
        labels.append((add(" ".join(words), lang, "toxic" if k % 5 == 0 else "clean"), 1, int(k % 5 == 0)))
    for _ in range(6):
        base = prose("aa", 100)
        add(" ".join(base), "aa", "clean")
        for _ in range(3):
            copy = list(base)
            copy[rng.randrange(100)] = "other"
            add(" ".join(copy), "aa", "copy")
    for item in items:
        add(" ".join(prose("aa", 40)) + " " + item + " " + " ".join(prose("aa", 40)), "aa", "leak")
    for text in (None, "", "123 !!", "..."):
        add(text, None, "no language")
    again = docs[10]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame([*docs, again], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, what


def test_pipeline_keeps_clean_documents_once(spark, planted):
    folder, what = planted
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    docs, left = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == documents.columns
        docs = spark.createDataFrame(made.collect(), documents.schema)
        left.append((name, sorted(r["doc_id"] for r in docs.select("doc_id").collect())))
    kept = dict(left)
    assert {what[i] for i in kept["toxicity"]} == {"clean", "copy", "leak", "no language"}
    assert {what[i] for i in kept["language"]} == {"clean", "copy", "leak"}
    clean = [i for i, kind in what.items() if kind == "clean"]
    assert kept["contamination"] == clean
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert sorted({p["doc_id"] for p in pieces}) == clean
    assert sum(p["length"] for p in pieces) == sum({p["doc_id"]: p["doc_tokens"] for p in pieces}.values())


@pytest.mark.parametrize("n_langs", [1, 2, 5])
def test_languages_are_kept_by_evidence_not_by_their_number(spark, tmp_path, n_langs):
    rows = [(k, f"shared shared shared own{k} own{k} own{k}", f"l{k % n_langs}") for k in range(10 * n_langs)]
    odd = [(1000, "shared"), (1001, "shores"), (1002, "日本語 текст"), (1003, "日本語 shared"), (1004, "123 !!"), (1005, None)]
    documents = spark.createDataFrame([*rows, *((i, t, None) for i, t in odd)], "doc_id long, text string, lang string")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_languages(spark, documents, str(tmp_path)).collect()}
    assert kept == {*range(10 * n_langs), 1000, 1001, 1003}


def test_stages_take_empty_and_odd_tables(spark, planted):
    folder, _ = planted
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None), (2, "thing " * 30_000, None, None, 1)], documents.schema)
    for docs in (documents.limit(0), odd.selectExpr("*", "1 AS verdict", "2 AS item", "3 AS id", "4 AS key")):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, folder)
            assert made.count() <= max(docs.count(), 60)
