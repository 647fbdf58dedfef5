"""Streams of readings: state per unit, and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def current_state(rows: DataFrame, key: tuple[str, ...] = ("olt_id", "vendor_ont_id")) -> DataFrame:
    """Last state and power per unit of a stream of readings, as a streaming aggregate.

    The state is one row per unit and is spread over the tasks by unit. Removal of units that a
    poll missed needs a whole poll and is the work of the ingest.
    """
    return rows.groupBy(*key).agg(
        F.max("time").alias("time"), *[F.max_by(c, "time").alias(c) for c in ("status", "ptx", "prx")]
    )


def unique_readings(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Readings without repeats of unit and time that come within the delay."""
    return readings.withWatermark("time", delay).dropDuplicatesWithinWatermark(["ont_id", "time"])
