"""Deep pages without a sort of all rows before them.

A directory counts the rows of every range of ids, with the rows before it. A page then reads only the ranges that hold it, by comparisons
on the id that reach the scan, and sorts only these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ponloom.operators.lineage import stored

WIDTH = 65_536


def page_directory(rows: DataFrame, key: str = "id", width: int = WIDTH) -> DataFrame:
    """(first, upto, n, before): ids from ``first`` up to but without ``upto``, how many rows they have, and how many come before."""
    ranges = rows.groupBy(F.floor(F.col(key) / width).alias("range")).agg(F.count("*").alias("n"))
    # One row a range that has rows.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return stored(ranges.select(
        (F.col("range") * width).alias("first"), ((F.col("range") + 1) * width).alias("upto"), "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "directory")


def page_at(rows: DataFrame, directory: DataFrame, offset: int, limit: int, key: str = "id") -> DataFrame:
    """The same as ordering all rows by the key, with an offset and a limit. The directory is of the same rows."""
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    hit = directory.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset))
    span = hit.agg(F.min("first").alias("first"), F.max("upto").alias("upto"), F.min("before").alias("before")).first()
    if span["first"] is None:
        return rows.limit(0)
    inside = rows.where((F.col(key) >= span["first"]) & (F.col(key) < span["upto"]))
    return inside.orderBy(key).offset(offset - span["before"]).limit(limit)


def total(directory: DataFrame) -> DataFrame:
    """The number of all rows, from the directory."""
    return directory.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
