"""CSV files of unit edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ponloom.operators.lineage import cut
from ponloom.schemas import UNIT_CSV
from ponloom.sources.quoted_lines import read_records

#: Number of the first line after the header.
FIRST_LINE = 2


def _with_cells(records: DataFrame, n: int) -> DataFrame:
    """Add the first ``n`` cells of the records as an array; cells that are not there are NULL."""
    rows = records.withColumn("row", F.from_csv("text", ", ".join(f"c{k} string" for k in range(n)), {"escape": '"'}))
    return rows.withColumn("cells", F.array(*[F.col("row")[f"c{k}"] for k in range(n)])).drop("row")


def read_unit_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Lines of CSV files with header: ``file``, ``record`` in the file from 2, ``line`` over all files, and the ten cells as text.

    Files go in the order of their paths, and each may have its own order of columns. Text that is not UTF-8 is an error. A byte order mark,
    extra columns, short rows and blank lines are accepted; of two columns with one name the last counts. Quoted cells may hold
    line breaks; large files are read by many tasks all the same.
    """
    records = read_records(spark, path, multi_line)
    headers = cut(records.where("record = 0").select("file", F.regexp_replace("text", "^﻿", "").alias("text")))
    n = headers.select(F.max(F.length("text") - F.length(F.replace("text", F.lit(","), F.lit(""))) + 1)).first()[0] or 1
    names = _with_cells(headers, n).select("file", F.reverse("cells").alias("names"))
    # One row a file: where it has each column, from 1.
    at = cut(names.select("file", *[F.when(F.array_position("names", c) > 0, n + 1 - F.array_position("names", c)).alias(c) for c in UNIT_CSV]))
    lacking = at.where(" OR ".join(f"{c} IS NULL" for c in UNIT_CSV)).first()
    if lacking is not None:
        raise ValueError(f"missing CSV columns: {', '.join(c for c in UNIT_CSV if lacking[c] is None)}, in {lacking['file']}")
    # One row a file, too, in the order of their paths.
    files = at.select("file", F.struct(*UNIT_CSV).alias("at"), F.rank().over(Window.orderBy("file")).alias("nth"))
    cells = _with_cells(records.where("record > 0").join(F.broadcast(files), "file"), n)
    return cells.select(
        "file", (F.col("record") - 1 + FIRST_LINE).alias("record"), (F.col("place") - F.col("nth") + FIRST_LINE).alias("line"),
        *[F.element_at("cells", F.col(f"at.{c}").cast("int")).alias(c) for c in UNIT_CSV])

