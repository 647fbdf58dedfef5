"""Lists, series, maps and search over subscriber units."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, functions as F

from ponloom.functions.clock import since, time_range
from ponloom.functions.geo import feature, in_bbox, is_located
from ponloom.functions.ports import pon_id as pon_id_of
from ponloom.functions.text import contains_pattern, display_name
from ponloom.operators.latest import latest
from ponloom.plans.checks import at_least_chars, bounded, one_of

METRICS = ("ptx", "prx", "status")
PORT_UNIT = [
    "id", "olt_id", "olt_name", "vendor_ont_id", "pon_id", "cto_uuid", "lat", "lon", "status",
    "serial", "model", "description",
]


class Page(NamedTuple):
    rows: DataFrame
    total: DataFrame


def _total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def _cut(df: DataFrame, limit: int, offset: int) -> DataFrame:
    ordered = df.orderBy("id")
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def _last_readings(power: DataFrame) -> DataFrame:
    return latest(power.select("ont_id", "time", "ptx", "prx", "status"), ["ont_id"], ["time"])


def units_page(
    ont: DataFrame, power: DataFrame, olt_id: str | None = None, limit: int = 20, offset: int = 0,
    after_id: int | None = None, total_scope: str = "all", last: DataFrame | None = None,
) -> Page:
    """Units in id order with their last reading; units never read are left out of the rows.

    The total counts all units, also those never read; ``total_scope='joined'`` counts the
    reachable ones. ``after_id`` continues behind a known id, which stays cheap on deep pages
    where an offset does not. The page is cut first, so only the readings of its units are
    aggregated. With ``last``, a kept table of the last reading of each unit, ``power`` is not read.
    """
    bounded("limit", limit, 0, 1000)
    bounded("offset", offset, 0)
    one_of("total_scope", total_scope, ("all", "joined"))
    units = ont.where(F.col("olt_id") == olt_id) if olt_id else ont
    read = power.select(F.col("ont_id").alias("id")).distinct() if last is None else last.select(F.col("ont_id").alias("id"))
    reachable = units.join(read, "id", "left_semi")
    behind = reachable.where(F.col("id") > after_id) if after_id is not None else reachable
    if last is None:
        page = _cut(behind, limit, offset)
        # At most `limit` (1000) ids, so the broadcast is bounded.
        on_page = F.broadcast(page.select(F.col("id").alias("ont_id")))
        newest = F.broadcast(_last_readings(power.join(on_page, "ont_id", "left_semi")))
    else:
        page, newest = units.where(F.col("id") > after_id) if after_id is not None else units, last
    rows = (
        page.alias("o").join(newest.alias("l"), F.col("o.id") == F.col("l.ont_id"))
        .select(
            "o.id", "o.olt_id", "o.vendor_ont_id", "o.status", "o.cto_uuid", "o.serial", "o.model",
            "o.description", "o.lat", "o.lon", "l.ptx", "l.prx", F.col("l.time").alias("last_read"),
            "o.props",
        )
    )
    # The kept table has one row per unit, so the join itself is the list that the page is cut from.
    rows = rows.orderBy("id") if last is None else _cut(rows, limit, offset)
    return Page(rows, _total(units if total_scope == "all" else reachable))


def history(
    power: DataFrame, ont_id: int, hours: int = 24, *, as_of: datetime, required: bool = False
) -> DataFrame:
    """Readings of one unit in the last hours, newest first."""
    bounded("hours", hours, 1, 720)
    rows = (
        time_range(power.where(F.col("ont_id") == ont_id), start=since(as_of, hours))
        .select("time", "ptx", "prx", "status").orderBy(F.col("time").desc())
    )
    if required and rows.isEmpty():
        raise LookupError(f"unit {ont_id} has no readings")
    return rows


def metric_points(power: DataFrame) -> DataFrame:
    """All readings in long form: ``(ont_id, metric, value, timestamp)``."""
    wide = power.select(
        "ont_id", F.col("time").alias("timestamp"), "ptx", "prx", F.col("status").cast("double").alias("status")
    )
    return wide.unpivot(["ont_id", "timestamp"], list(METRICS), "metric", "value").select(
        "ont_id", "metric", "value", "timestamp"
    )


def metric_series(power: DataFrame, ont_id: int, metric: str, start: datetime, end: datetime) -> DataFrame:
    """One raw series of one unit, oldest first; both ends are included."""
    one_of("metric", metric, METRICS)
    rows = time_range(power.where(F.col("ont_id") == ont_id), start, end)
    return rows.select(
        "ont_id", F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"),
        F.col("time").alias("timestamp"),
    ).orderBy("timestamp")


def units_in_bbox(ont: DataFrame, power: DataFrame, bbox) -> DataFrame:
    """Located units in a rectangle with their last reading.

    ``power`` are all readings, or a kept table of the last ones (``fold_latest``). They shrink to one row per
    unit before the one shuffle.
    """
    units = ont.where(is_located() & in_bbox(bbox))
    last = _last_readings(power)
    return units.alias("o").join(last.alias("l"), F.col("o.id") == F.col("l.ont_id")).select(
        "o.id", "o.olt_id", "o.vendor_ont_id", "o.status", "o.cto_uuid", "o.description", "o.model",
        "o.serial", "o.lat", "o.lon", "o.props", "l.ptx", "l.prx", F.col("l.time").alias("last_read"),
        F.col("l.status").alias("power_status"),
    )


def with_ports(ont: DataFrame, olt: DataFrame) -> DataFrame:
    """Units of known devices with device name and port id."""
    devices = olt.select(
        F.col("id").alias("olt_id"), F.col("vendor").alias("_vendor"),
        display_name("description", "id").alias("olt_name"),
    )
    columns = [c for c in ont.columns if c != "pon_id"]
    joined = ont.select(*columns).join(devices, "olt_id")
    return joined.withColumn("pon_id", pon_id_of("_vendor", "vendor_ont_id")).drop("_vendor")


def olt_list(olt: DataFrame) -> DataFrame:
    return olt.select("id", display_name("description", "id").alias("name")).orderBy("id")


def pon_list(ont: DataFrame, olt: DataFrame, olt_id: str) -> DataFrame:
    """Ports of one device, as far as units name them."""
    units = ont.where(F.col("olt_id") == olt_id).select("id", "olt_id", "vendor_ont_id")
    ports = with_ports(units, olt.where(F.col("id") == olt_id)).select(F.col("pon_id").alias("id")).distinct()
    return ports.select("id", F.col("id").alias("name")).orderBy("id")


def _of_port(ont: DataFrame, olt: DataFrame, olt_id: str | None, pon_id: str | None) -> DataFrame:
    if olt_id:
        ont, olt = ont.where(F.col("olt_id") == olt_id), olt.where(F.col("id") == olt_id)
    units = with_ports(ont, olt)
    return units.where(F.col("pon_id") == pon_id) if pon_id else units


def _port_units(ont: DataFrame, olt: DataFrame, olt_id: str, pon_id: str, only_unlocated: bool) -> DataFrame:
    if only_unlocated:
        ont = ont.where(~is_located())
    units = _of_port(ont.where(F.col("olt_id") == olt_id), olt.where(F.col("id") == olt_id), None, None)
    return units.where(F.col("pon_id") == pon_id).select(*PORT_UNIT)


def port_units(
    ont: DataFrame, olt: DataFrame, olt_id: str, pon_id: str, only_unlocated: bool = False,
    limit: int = 200, offset: int = 0,
) -> Page:
    """Units of one port in id order, on request only those without a position."""
    bounded("limit", limit, 1, 1000)
    bounded("offset", offset, 0)
    units = _port_units(ont, olt, olt_id, pon_id, only_unlocated)
    return Page(_cut(units, limit, offset), _total(units))


def search_units(
    ont: DataFrame, olt: DataFrame, q: str, olt_id: str | None = None, pon_id: str | None = None,
    only_unlocated: bool = True, limit: int = 50, offset: int = 0, literal: bool = False,
) -> Page:
    """Units whose id or serial contains the text, case aside, in id order.

    A search for ``3-1-12`` also finds ``ont-3-1-12``, since that contains it.
    """
    at_least_chars("q", q, 1)
    bounded("limit", limit, 1, 200)
    bounded("offset", offset, 0)
    like = contains_pattern(q, literal)
    hits = ont.where(F.col("vendor_ont_id").ilike(like) | F.coalesce("serial", F.lit("")).ilike(like))
    if only_unlocated:
        hits = hits.where(~is_located())
    units = _of_port(hits, olt, olt_id, pon_id)
    return Page(_cut(units.select(*PORT_UNIT), limit, offset), _total(units))


def port_units_in_bbox(
    ont: DataFrame, olt: DataFrame, bbox, olt_id: str | None = None, pon_id: str | None = None
) -> DataFrame:
    """Located units of one port in a rectangle. Without device and port the result is empty."""
    if not olt_id or not pon_id:
        return _of_port(ont, olt, None, None).select(*PORT_UNIT).limit(0)
    located = ont.where(is_located() & in_bbox(bbox))
    return _of_port(located, olt, olt_id, pon_id).select(*PORT_UNIT).orderBy("id")


def unit_pages(
    ont: DataFrame, olt: DataFrame, olt_id: str, pon_id: str, size: int = 200
) -> Iterator[list[Row]]:
    """Pages of the units of a port without a position, by keyset, until a page is short.

    The units are read once, in id order, and a page takes those behind the last id of the page before. One task's share of them is held at a time.
    """
    bounded("size", size, 1, 1000)
    rows, last = [], None
    for row in _port_units(ont, olt, olt_id, pon_id, only_unlocated=True).orderBy("id").toLocalIterator():
        if last is not None and row["id"] <= last:
            continue
        rows.append(row)
        if len(rows) == size:
            yield rows
            rows, last = [], row["id"]
    if rows:
        yield rows


def to_features(df: DataFrame, shape: str) -> DataFrame:
    """One GeoJSON Feature per row as JSON text, next to the unit id.

    ``shape='metrics'`` takes rows of ``units_in_bbox``, ``shape='port'`` rows of
    ``port_units_in_bbox``.
    """
    one_of("shape", shape, ("metrics", "port"))
    # Property names of the two kinds of features.
    if shape == "metrics":
        properties = F.struct(
            "id", F.col("id").alias("ont_id"), "olt_id", F.col("id").alias("external_id"),
            "vendor_ont_id", F.col("vendor_ont_id").alias("external_name"), "model",
            F.col("serial").alias("sn"), F.col("status").alias("state"),
            F.col("cto_uuid").alias("topology"), "cto_uuid", "description",
            F.parse_json("props").alias("props"), F.struct("ptx", "prx").alias("metrics"),
        )
    else:
        properties = F.struct(
            F.col("id").alias("ont_id"), "id", "olt_id", "olt_name", "pon_id", "vendor_ont_id",
            "status", "cto_uuid", "description", "model", "serial",
        )
    return df.where(is_located()).select("id", feature(F.col("lon"), F.col("lat"), properties).alias("feature"))
