"""The registered queries of the operators: thin digests of their results over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ponloom.llm import (
    bpe, contamination, langid, licenses, mixing, near_text, near_vectors, packing, quality, resampling, sharding, toxicity, turns)
from ponloom.llm.frames import remainder
from ponloom.llm.oracle import TURN_REPAIR, importance


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(n: int, rest: int) -> Column:
    """A null id is never held out."""
    return F.coalesce(remainder("doc_id", n) == F.lit(rest), F.lit(False))


def labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """One label by document; of several the larger counts."""
    rows = table(spark, sf_dir, "labels").filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    return rows.groupBy("doc_id").agg(F.max(column).alias(column))


def learnable(spark: SparkSession, sf_dir: str, column: str, n: int, rest: int) -> DataFrame:
    """Texts with a label, without the held-out documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter(~held_out(n, rest))
    return docs.join(labels(spark, sf_dir, column), "doc_id").select("doc_id", "text", column)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_text.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "component_id", "kept")


def vocabulary() -> str:
    """The byte-level BPE file of the installed tokenizer package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bpe.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())
    n = F.col("tokens.n_tokens")
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n.alias("n_tokens"), (n > 512).alias("over_limit"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col("licenses.found")
    return scanned.select(
        "doc_id", F.col("licenses.blocks").alias("n_blocks"), F.size(found).cast("long").alias("n_found"),
        F.concat_ws(",", F.array_sort(F.array_distinct(found["license"]))).alias("licenses"),
        F.aggregate(found["differences"], F.lit(0).cast("long"), lambda a, x: a + x).alias("differences"), found.alias("found"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = quality.fit(learnable(spark, sf_dir, "quality", 3, 1), id_col="doc_id", corpus=table(spark, sf_dir, "documents"))
    scored = quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    value = F.col("quality.score")
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), value.alias("score"), F.when(value >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # A null id has no remainder and is not learned from.
    model = langid.fit(docs.filter(remainder("doc_id", 4) != 2), id_col="doc_id")
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out(4, 2).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op6_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum of their ids in place of the ids."""
    cut = packing.pieces(docs, vocabulary())
    cut = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(cut).select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op9_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = contamination.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = contamination.search(index, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(learnable(spark, sf_dir, "toxic", 5, 0), id_col="doc_id")
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(5, 0).alias("held_out"), F.col("toxicity.score").alias("score"),
        F.when(F.col("toxicity.score") >= 0.5, 1).otherwise(0).alias("predicted"), F.col("toxicity.spans").alias("spans"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return drawn.select("doc_id", F.col("importance.n_features").alias("n_features"), F.col("importance.weight").alias("weight"), "score", "rank")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size("text").alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_histogram_shards": op6_histogram_shards,
    "op7_packing": op7_packing,
    "op8_rotated_codes": op8_rotated_codes,
    "op9_benchmark_index": op9_benchmark_index,
    "op10_toxic_spans": op10_toxic_spans,
    "op11_turn_repair": op11_turn_repair,
    "op12_importance": op12_importance,
    "op13_source_mix": op13_source_mix,
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_RECURSIVE_COSINE = """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        ok AS (
            SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM ok AS a JOIN ok AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON l.a = r.b),
        lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT v.vec_id, CAST((SELECT count(*) FROM links WHERE links.a = v.vec_id) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
        FROM v JOIN lowest ON lowest.a = v.vec_id"""

ORACLE: dict[str, str] = {
    "op8_rotated_codes": _RECURSIVE_COSINE,
    "op9_benchmark_index": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        passages AS (
            SELECT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS passage
            FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM passages),
        found AS (
            SELECT x.doc_id, x.s, x.size, p.item_id
            FROM (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS passage
                  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes)) AS x
            JOIN passages AS p ON p.size = x.size AND p.passage = x.passage),
        hits AS (SELECT doc_id, count(DISTINCT n) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS n FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_turn_repair": TURN_REPAIR,
    "op12_importance": importance(_WORDS),
}
