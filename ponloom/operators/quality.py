"""Constraints as queries that return the rows which break them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def orphans(child: DataFrame, parent: DataFrame, on: str, parent_key: str = "id") -> DataFrame:
    """Rows whose reference is set but not found in the parent table."""
    keys = parent.select(F.col(parent_key).alias(on)).distinct()
    return child.where(F.col(on).isNotNull()).join(keys, on, "left_anti")


def refuse(broken: DataFrame, what: str) -> None:
    """Raise an error if a quality query found rows, with one of them as an example."""
    found = broken.first()
    if found is not None:
        raise ValueError(f"{what}: {found.asDict()}")


def domain_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not one of the allowed ones. NULL passes, as in a check constraint."""
    return df.where(~F.col(column).isin(list(values)))


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of the columns, and which ones in ``null_columns``."""
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.withColumn("null_columns", names).where("null_columns <> ''")
