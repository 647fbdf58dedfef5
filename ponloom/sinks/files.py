"""Exports and appends. Every writer works per partition; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ponloom.functions.clock import utc_day
from ponloom.schemas import UNIT_CSV

#: Bytes of a row group of readings: what a query for one unit and day reads at most.
ROW_GROUP = 8 << 20


def export_units(ont: DataFrame) -> DataFrame:
    """Rows of the unit CSV, ordered by device and id; ``x`` is lon and ``y`` is lat."""
    return ont.select(
        *[F.col({"x": "lon", "y": "lat"}.get(c, c)).alias(c) for c in UNIT_CSV]
    ).orderBy("olt_id", "id")


def write_unit_csv(ont: DataFrame, path: str) -> None:
    """CSV files with header, NULL as an empty cell, in file-name order."""
    write_csv(export_units(ont), path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with header; times keep their microseconds."""
    (
        df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
    )


def write_features(features: DataFrame, path: str) -> None:
    """GeoJSON lines, one feature a line: the form for results of any size."""
    features.select(F.col("feature").alias("value")).write.mode("overwrite").text(path)


def write_readings(power: DataFrame, path: str, batch_id: int) -> None:
    """Append readings by day in UTC. A batch that is written again replaces its own files.

    Rebalancing puts a day into few files, and splits a large day over as many tasks as it needs. Files are sorted by unit and
    time, so that a query for one unit skips all but a few of their pages.
    """
    days = power.withColumn("date", utc_day(F.col("time"))).hint("rebalance", "date").sortWithinPartitions("date", "ont_id", "time")
    days.write.mode("overwrite").partitionBy("date").option("parquet.block.size", ROW_GROUP).parquet(f"{path}/batch={batch_id}")


def write_clustered(power: DataFrame, path: str, row_group: int | None = None) -> None:
    """Write readings with a ``date`` by day, each day in ranges of unit ids, sorted by unit and time: one unit lies in one row group of a day, or two."""
    ranges = power.repartitionByRange("date", "ont_id").sortWithinPartitions("date", "ont_id", "time")
    ranges.write.mode("overwrite").partitionBy("date").option("parquet.block.size", row_group or ROW_GROUP).parquet(path)
