"""What a sequence of polls says about units: when they were there, and since when without a gap.

Polls of one device are applied one after the other. A poll is evidence that a unit is gone if
it read the part of the device (the scope) where the unit belongs and did not see it.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ponloom.functions.ports import unit_scope
from ponloom.operators.lineage import cut, stored as stored_rows
from ponloom.operators.normalize import VENDORS, scopes
from ponloom.operators.numbering import numbered, with_new_ids
from ponloom.operators.upkeep import with_pon_id

UNIT = ["olt_id", "vendor_ont_id"]
#: What names a poll: its id is one of its device's, and a device may use it again at another time.
POLL = ["olt_id", "poll_id", "polled_at"]
#: The same in rows of readings.
ROW_POLL = ["olt_id", "poll_id", "time"]
POLLS_PER_BUCKET = 1024


class Applied(NamedTuple):
    """Result of applying polls."""

    units: DataFrame
    readings: DataFrame
    removed: DataFrame
    poll_log: DataFrame


def applied_counts(applied: Applied) -> DataFrame:
    """How many units were removed and readings inserted: (what, n)."""
    parts = {"removed_units": applied.removed, "inserted_readings": applied.readings}
    first, second = (rows.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n") for what, rows in parts.items())
    return first.unionAll(second)


def poll_headers(records: DataFrame) -> DataFrame:
    """One row per poll, from its records or slices. A poll of which a slice failed has failed."""
    told = [
        F.array_distinct(F.flatten(F.collect_set(F.coalesce(c, F.array().cast("array<string>"))))).alias(c)
        for c in ("scopes_ok", "scopes_failed")
    ]
    failed = F.max(F.when(F.col("outcome") != "ok", F.col("outcome")))
    headers = records.groupBy(*POLL).agg(F.max("vendor").alias("vendor"), F.coalesce(failed, F.lit("ok")).alias("outcome"), *told)
    return headers.select("poll_id", "olt_id", "vendor", "polled_at", "outcome", "scopes_ok", "scopes_failed")


def last_in_poll(rows: DataFrame) -> DataFrame:
    """Readings with the last one kept where a unit is repeated inside a poll.

    First the last of each slice, then the last slice: values of fixed width, which hash aggregation keeps in place.
    """
    key, reading = ["poll_id", *UNIT, "vendor", "time"], ["ptx", "prx", "status"]
    for by, place in ((["slice"], "pos"), ([], "slice")):
        rows = rows.groupBy(*key, *by).agg(*[F.max_by(c, place).alias(c) for c in reading])
    return rows.select(*key, *reading)


def once(rows: DataFrame, key: list[str]) -> DataFrame:
    """One reading by time and unit: of polls of one device at one time the last one by id counts."""
    return rows.groupBy(*key).agg(*[F.max_by(c, "poll_id").alias(c) for c in ("ptx", "prx", "status")])


def poll_sizes(rows: DataFrame) -> DataFrame:
    """Units and records of each poll, and a digest of its records, which is equal for the same poll sent again."""
    record = F.xxhash64("vendor_ont_id", "slice", "pos", "ptx", "prx", "status", "serial", "model", "description", "props")
    return rows.groupBy(*ROW_POLL, "vendor_ont_id").agg(F.count("*").alias("n"), F.bit_xor(record).alias("digest")).groupBy(*ROW_POLL).agg(
        F.count("*").alias("n_units"), F.sum("n").alias("n_records"), F.bit_xor("digest").alias("digest")
    ).withColumnRenamed("time", "polled_at")


def poll_log(headers: DataFrame, rows: DataFrame, min_units: int = 0, vendors: Mapping | None = None) -> DataFrame:
    """What became of each poll: applied, failed, unknown vendor, or without units.

    ``evidence`` says whether the poll may remove units; a poll with fewer than ``min_units``
    units may not.
    """
    known = list(VENDORS if vendors is None else vendors)
    sizes = poll_sizes(rows)
    result = (
        F.when(~F.col("vendor").isin(known), "unknown_vendor")
        .when(F.col("outcome") != "ok", F.col("outcome"))
        .when(F.col("n_units") == 0, "empty")
        .otherwise("applied")
    )
    counted = headers.join(sizes, POLL, "left").fillna(0, ["n_units", "n_records"])
    return counted.withColumn("result", result).withColumn(
        "evidence", (F.col("result") == "applied") & (F.col("n_units") >= min_units)
    )


def evidence(log: DataFrame, seen: DataFrame, parity: bool = False) -> DataFrame:
    """Scopes each poll has read, numbered per device and scope in poll order.

    With ``parity`` a poll always speaks for its whole device, even if some scopes failed.
    Otherwise for the scopes it reports as read and those it saw units of, less the failed ones.
    """
    polls = log.where("evidence").select("olt_id", "poll_id", F.col("polled_at").alias("time"), "scopes_ok", "scopes_failed")
    key = ROW_POLL
    if parity:
        read = polls.select(*key, F.lit("*").alias("scope"))
    else:
        told = polls.select(*key, F.explode("scopes_ok").alias("scope"))
        shown = seen.select(*key, "scope").distinct().join(polls.select(*key), key, "left_semi")
        failed = polls.select(*key, F.explode("scopes_failed").alias("scope"))
        read = told.union(shown.select(*key, "scope")).distinct().join(failed, [*key, "scope"], "left_anti")
    # A device is polled every few seconds at most, so an hour is a bounded bucket.
    return numbered(read, ["olt_id", "scope"], F.date_trunc("hour", "time"), ["time", "poll_id"], "poll_no")


def presence(sighted: DataFrame, polls: DataFrame) -> DataFrame:
    """Sightings with the number of the poll in the unit's scope."""
    return sighted.join(polls.select(*ROW_POLL, "scope", "poll_no"), [*ROW_POLL, "scope"])


def seen_units(rows: DataFrame, parity: bool = False, vendors: Mapping | None = None) -> DataFrame:
    """Sightings: one row per unit and poll, with the unit's scope."""
    scope = F.lit("*") if parity else unit_scope("vendor", "vendor_ont_id", scopes(VENDORS if vendors is None else vendors))
    return rows.select("olt_id", "vendor_ont_id", scope.alias("scope"), "poll_id", "time").distinct()


def islands(seen: DataFrame) -> DataFrame:
    """Unbroken runs of presence per unit: first and last poll number, and polls in between."""
    key = [*UNIT, "scope"]
    ranked = numbered(
        seen.select(*key, "poll_no"), key, F.floor(F.col("poll_no") / POLLS_PER_BUCKET), ["poll_no"], "_n"
    )
    return (
        ranked.groupBy(*key, (F.col("poll_no") - F.col("_n")).alias("_run"))
        .agg(F.min("poll_no").alias("first_poll"), F.max("poll_no").alias("last_poll"), F.count("*").alias("n_polls"))
        .drop("_run")
    )


def _scoped(ont: DataFrame, devices: DataFrame, parity: bool, vendors: Mapping) -> DataFrame:
    """Stored units of polled devices with their scope."""
    joined = ont.select("id", *UNIT).join(devices, "olt_id")
    scope = F.lit("*") if parity else unit_scope("vendor", "vendor_ont_id", scopes(vendors))
    return joined.select("id", *UNIT, scope.alias("scope"))


def last_break(units: DataFrame, seen: DataFrame, polls: DataFrame) -> DataFrame:
    """The last poll that missed a unit, as ``struct(time, poll_id)``; no row if none did.

    ``units`` are all stored or sighted units with their scope, ``seen`` is their presence in
    numbered polls.
    """
    key = [*UNIT, "scope"]
    newest = islands(seen).groupBy(*key).agg(
        F.max("last_poll").alias("_last"), F.max_by("first_poll", "last_poll").alias("_first")
    )
    ends = polls.groupBy("olt_id", "scope").agg(F.max("poll_no").alias("_end"))
    missed = units.join(newest, key, "left").join(ends, ["olt_id", "scope"]).select(
        *key,
        F.when(F.col("_last") == F.col("_end"), F.col("_first") - 1).otherwise(F.col("_end")).alias("poll_no"),
    )
    times = polls.select("olt_id", "scope", "poll_no", F.struct("time", "poll_id").alias("break"))
    found = missed.where("poll_no > 0").join(times, ["olt_id", "scope", "poll_no"])
    return found.select(*UNIT, "break")


def apply_polls(
    ont: DataFrame, rows: DataFrame, headers: DataFrame, delete_missing: bool = True,
    parity: bool = False, min_units: int = 0, last_id: int = 0, vendors: Mapping | None = None, olt: DataFrame | None = None,
) -> Applied:
    """The unit table and readings after a batch of polls, as if applied one after the other.

    ``rows`` come from ``normalize_polls``, with the same ``vendors`` if others than the built-in ones are read; only those of
    applied polls count. They are read several times, with few columns each time, so a caller with much data hands
    in rows that lie in Parquet. A device has one vendor. With the device table ``olt`` the ``pon_id`` of
    every unit is derived anew.

    A known unit gets status and props of its last poll. A unit that a poll missed is removed; if
    a later poll sees it, it is a new unit with the serial, model and description of that poll,
    without position and box, and its older readings are gone. Ids are never used again: ``last_id`` is
    the largest one ever given.
    """
    vendors = VENDORS if vendors is None else vendors
    log = cut(poll_log(headers, rows, min_units, vendors))
    applied = log.where("result = 'applied'")
    rows = stored_rows(rows.join(applied.select("olt_id", "poll_id", F.col("polled_at").alias("time")), ROW_POLL, "left_semi"), "applied-rows")
    stored = _scoped(ont, applied.groupBy("olt_id").agg(F.max("vendor").alias("vendor")), parity, vendors)

    at = F.struct("time", "poll_id")
    last = rows.groupBy(*UNIT).agg(
        F.max_by(F.struct("status", "props"), F.struct("time", "poll_id", "slice", "pos")).alias("now"),
        F.max(at).alias("seen"),
    )

    if delete_missing:
        sighted = seen_units(rows, parity, vendors)
        polls = cut(evidence(log, sighted, parity))
        units = stored.select(*UNIT, "scope").union(sighted.select(*UNIT, "scope")).distinct()
        breaks = last_break(units, presence(sighted, polls), polls)
    else:
        none = F.lit(None).cast(f"struct<time:{rows.schema['time'].dataType.simpleString()},poll_id:string>")
        breaks = ont.select(*UNIT).limit(0).withColumn("break", none)

    # One row per stored or seen unit of the polled devices; everything else follows from it.
    state = cut(stored.select("id", *UNIT).join(last, UNIT, "full_outer").join(breaks, UNIT, "left"))
    kept = state.where("id IS NOT NULL AND break IS NULL")
    removed = state.where("id IS NOT NULL AND break IS NOT NULL").select("id", *UNIT)
    new = state.where("(id IS NULL OR break IS NOT NULL) AND (break IS NULL OR seen > break)").drop("id")

    # Units that stay under their id. Those no poll has seen stay as they are.
    known = ont.join(removed.select("id"), "id", "left_anti").join(kept.select("id", "now"), "id", "left").selectExpr(
        *[f"if(now IS NULL, {c}, now.{c}) AS {c}" if c in ("status", "props") else c for c in ont.columns]
    )

    # Units that are new, or back after a gap: their first record since then.
    since_break = F.col("break").isNull() | (at > F.col("break"))
    place = F.struct(F.col("time"), F.col("poll_id"), -F.col("slice"), -F.col("pos"))
    first = (
        rows.join(new.select(*UNIT, "break"), UNIT).where(since_break)
        .groupBy(*UNIT).agg(F.min_by(F.struct("serial", "model", "description"), place).alias("first"))
    )
    named = new.join(first, UNIT).select(*UNIT, "break", "first.*", "now.*")
    born = cut(with_new_ids(named, ont, UNIT, last_id=last_id))
    units = known.unionByName(born.drop("break"), allowMissingColumns=True).select(*ont.columns)
    units = units if olt is None else with_pon_id(units, olt)

    alive = kept.select("id", *UNIT, "break").unionByName(born.select("id", *UNIT, "break"))
    power = last_in_poll(rows).join(alive, UNIT).where(since_break)
    if not applied.groupBy("olt_id", "polled_at").count().where("count > 1").isEmpty():
        power = once(power, ["time", "id"])
    power = power.select("time", F.col("id").alias("ont_id"), "ptx", "prx", "status")
    return Applied(units, power, removed, log)
