"""Base tables in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ponloom import schemas

_SCHEMAS = {"olt": schemas.OLT, "ont": schemas.ONT, "ont_power": schemas.ONT_POWER, "cto": schemas.CTO}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One base table by its fixed schema; partition columns of the folder are added by Spark."""
    return spark.read.schema(_SCHEMAS[name]).parquet(path)
