"""Helpers shared by the operators: results beside rows, held-out rows, bounded samples of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ponloom.llm.words import mix, words


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_result(docs: DataFrame, text_col: str, name: str, result: T.StructType, compute: Callable[[pa.Array], dict]) -> DataFrame:
    """Add a struct column ``name`` that ``compute`` makes of the texts of an Arrow batch.

    All columns of ``docs`` stay; one that is already called ``name`` is replaced.
    """
    kept = docs.drop(name) if name != text_col else docs
    schema = T.StructType([*kept.schema.fields, T.StructField(name, result)])
    fields = [to_arrow_schema(T.StructType([f])).field(0) for f in result.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            made = compute(text)
            arrays = [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type) for f in fields]
            out = pa.StructArray.from_arrays([a.cast(f.type) for a, f in zip(arrays, fields)], fields=fields)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, schema)


def null_safe_join(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """All columns of ``a``, and those of ``b`` that are not keys; null keys are equal."""
    same = " AND ".join(f"a.{c} <=> b.{c}" for c in on)
    return a.alias("a").join(b.alias("b"), F.expr(same), how).select("a.*", *[f"b.{c}" for c in b.columns if c not in on])


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary") if isinstance(id_col, str) else id_col) % F.lit(n)


def class_counts(rows: DataFrame, class_col: str, max_classes: int) -> dict:
    """Rows of the most frequent classes; null is no class."""
    counts = rows.filter(F.col(class_col).isNotNull()).groupBy(class_col).agg(F.count("*").alias("n"))
    return {r[0]: r["n"] for r in counts.orderBy(F.desc("n"), class_col).limit(max_classes).collect()}


def labelled_rows(rows: DataFrame, text: Column, label: Column, id_col: str | None) -> DataFrame:
    """(text, label, pick): ``pick`` is a hash that chooses samples, of the id where there is one, so that copies of a text are chosen singly."""
    by = [F.col(id_col)] if id_col else []
    return rows.select(text.alias("text"), label.alias("label"), F.xxhash64(F.lit("sample"), *by, text).alias("pick"))


def bounded_sample(rows: DataFrame, counts: dict, per_class: int) -> DataFrame:
    """About ``per_class`` of the labelled rows of each label, chosen by their hash, so that a task that runs again takes the same."""
    share = (F.col("pick").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30)))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col("label") == F.lit(value)) & (share < F.lit(per_class / max(n, 1))))
    return rows.filter(keep).drop("pick")


def without_copies(sample: DataFrame) -> DataFrame:
    """One row of each group of near copies, else the words of one text that was copied would look like a rule.

    Near copies agree in most of a few minima of hashed word pairs; rows that agree in any of them with another row count once.
    """

    def run(batches):
        for batch in batches:
            for lo, hi, w in words(batch.column(0)):
                pairs = w.hashes * np.uint64(3) + np.append(w.hashes[1:], np.uint64(0))
                out = []
                for seed in (1, 2, 3):
                    h = mix(pairs ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                    sketch = np.zeros(hi - lo, np.uint64)
                    some = np.diff(w.offsets) > 0
                    if some.any():
                        sketch[some] = np.minimum.reduceat(h, w.offsets[:-1][some])
                    out.append(pa.array(sketch.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), *out], names=["row", "s1", "s2", "s3"])

    keyed = sample.withColumn("row", F.xxhash64("text"))
    kept = keyed.select("text", "row").mapInArrow(run, "row long, s1 long, s2 long, s3 long")
    for s in ("s1", "s2", "s3"):
        kept = kept.join(kept.groupBy(s).agg(F.min("row").alias("row")), ["row", s], "left_semi")
    return keyed.join(kept.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"]).select("text", "label")
