"""Units without a position, counted by device and port."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ponloom.functions.geo import is_located
from ponloom.plans.checks import bounded
from ponloom.plans.units import with_ports


def _unlocated(ont: DataFrame, olt: DataFrame) -> DataFrame:
    units = ont.where(~is_located()).select("id", "olt_id", "vendor_ont_id")
    return with_ports(units, olt).select("olt_id", "olt_name", "pon_id")


def _counts(ont: DataFrame, olt: DataFrame) -> DataFrame:
    return _unlocated(ont, olt).groupBy("olt_id", "olt_name", "pon_id").agg(F.count("*").cast("int").alias("cnt"))


def unlocated_groups(ont: DataFrame, olt: DataFrame) -> DataFrame:
    """Number of units without a position per device and port."""
    return _counts(ont, olt).orderBy("olt_id", "pon_id")


def unlocated_rollup(ont: DataFrame, olt: DataFrame) -> DataFrame:
    """Counts per port, per device and in all, in one pass. ``level`` is 0, 1 or 2 in this order.

    The rows are counted before they are rolled up, so only the counts are expanded.
    """
    rolled = _counts(ont, olt).rollup("olt_id", "pon_id").agg(
        F.max("olt_name").alias("olt_name"), F.sum("cnt").alias("cnt"),
        F.bit_count(F.grouping_id()).cast("int").alias("level"),
    )
    return rolled.select(
        "level", "olt_id", F.when(F.col("level") < 2, F.col("olt_name")).alias("olt_name"), "pon_id", "cnt"
    )


def unlocated_tree(ont: DataFrame, olt: DataFrame) -> DataFrame:
    """The tree as flat rows: each port with its count beside the count of its device.

    One row per port whatever a device's size; a caller nests the rows it shows.
    """
    ports = _counts(ont, olt)
    devices = ports.groupBy("olt_id").agg(F.sum("cnt").alias("olt_cnt"))
    return ports.join(devices, "olt_id").select("olt_id", "olt_name", "olt_cnt", "pon_id", "cnt").orderBy("olt_id", "pon_id")


def unlocated_devices(ont: DataFrame, olt: DataFrame, after: str | None = None, limit: int = 50) -> DataFrame:
    """One page of devices with their ports nested: (olt_id, olt_name, cnt, pons), pons being (pon_id, cnt) in order.

    Devices go by id, from the one after ``after``. A device has as many ports as its hardware, so a page is small.
    """
    bounded("limit", limit, 1, 1000)
    units = ont.where(~is_located()) if after is None else ont.where(~is_located() & (F.col("olt_id") > after))
    # The devices of the page first, so that only their units are counted by port.
    page = units.select("olt_id").join(olt.select(F.col("id").alias("olt_id")), "olt_id", "left_semi").distinct().orderBy("olt_id").limit(limit)
    ports = _counts(units.join(page, "olt_id", "left_semi"), olt)
    nested = F.array_sort(F.collect_list(F.struct("pon_id", "cnt"))).alias("pons")
    return ports.groupBy("olt_id", "olt_name").agg(F.sum("cnt").alias("cnt"), nested).orderBy("olt_id")
