"""From raw documents to packed training sequences, in stages that each hand a Parquet table to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ponloom.llm import contamination, langid, near_text, toxicity
from ponloom.llm.frames import remainder, unused
from ponloom.llm.queries import learnable, packed, table
from ponloom.operators.lineage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores as toxic go. Documents without text stay."""
    model = toxicity.fit(learnable(spark, sf_dir, "toxic", 5, 0), id_col="doc_id")
    verdict = unused(docs, "verdict")
    return toxicity.score(docs, model, name=verdict).filter(F.col(verdict)["score"] < 0.5).drop(verdict)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go: those without a letter, and those that share no word or character with a learned one."""
    model = langid.fit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang").filter(remainder("doc_id", 4) != 2), id_col="doc_id")
    verdict = unused(docs, "verdict")
    language = F.col(verdict)
    found = langid.identify(docs, model, name=verdict)
    return found.filter((language["lang"] != langid.UNDETERMINED) & (language["evidence"] > 0)).drop(verdict)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, of repeated rows one."""
    found = near_text.near_duplicates(docs).filter("kept").select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(found["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["_hash"])
    return docs.join(found, same, "left_semi").dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("key"), "text")
    index = contamination.build_index(keyed, "key")
    found = contamination.search(index, table(spark, sf_dir, "benchmark")).filter("n_hit > 0").select("id.*").distinct()
    same = docs["doc_id"].eqNullSafe(found["doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["hash"])
    return docs.join(found, same, "left_anti")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that are left, as pieces of training sequences."""
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic), ("language", keep_languages), ("near copies", drop_near_copies), ("contamination", drop_contaminated),
    ("packing", pack_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
