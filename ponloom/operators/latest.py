"""The newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def latest(df: DataFrame, key: list[str], order: list[str], how: str = "max_by") -> DataFrame:
    """Newest row per key.

    ``max_by`` keeps one value per column next to the newest time. It aggregates before and
    after the shuffle, so a key with many rows costs no more than others, and with fixed-width
    columns it stays in hash aggregation. It wants one order column without ties.
    ``row_number`` takes several order columns and so settles ties; Spark cuts the rows to one
    per key before the shuffle.
    """
    if how == "max_by":
        if len(order) != 1:
            raise ValueError("max_by takes one order column; use row_number to break ties")
        (by,) = order
        values = [c for c in df.columns if c not in key and c != by]
        newest = df.groupBy(*key).agg(
            F.max(by).alias(by), *[F.max_by(c, by).alias(c) for c in values]
        )
        return newest.select(*df.columns)
    if how == "row_number":
        window = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
        return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
    raise ValueError("how must be 'max_by' or 'row_number'")


def fold_latest(snapshot: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Newest rows after more readings came in, from a kept table instead of all history."""
    return latest(snapshot.unionByName(new.select(*snapshot.columns)), key, [order])
