"""Table upkeep as functions from a table and changes to the next table.

Plain Parquet has no MERGE, so an operator builds the next version of a table. Joins are left to
Spark, which broadcasts by the size it measures at run time and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ponloom.functions.geo import make_point
from ponloom.functions.ports import pon_id


def one_per_key(rows: DataFrame, keys: Sequence[str], order_by: str | None = None, last: Sequence[str] | None = None) -> DataFrame:
    """One row per key, as if the rows came one after the other by ``order_by``, which is dropped.

    The columns ``last`` (by default all) are those of the last row of a key, the others of the first. Without an
    order a repeated key is an error, raised when the rows are read.
    """
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys and c != order_by]
    if order_by is not None:
        last = others if last is None else last
        return rows.groupBy(*keys).agg(*[(F.max_by if c in last else F.min_by)(c, order_by).alias(c) for c in others])
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in others])
    named = F.concat_ws(", ", *[F.col(c).cast("string") for c in keys])
    repeated = F.raise_error(F.concat(F.lit("a key comes twice, and no order says which row counts: "), named)).cast("boolean")
    return grouped.where(F.when(F.col("_n") > 1, repeated).otherwise(True)).drop("_n")


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], update_cols: Sequence[str] = (),
    on_conflict: str = "update", order_by: str | None = None,
) -> DataFrame:
    """Insert rows with new keys; for known keys set ``update_cols`` only, or nothing.

    Columns that only the table has are NULL in new rows. Changes of one key count one after the other by ``order_by``:
    the first one inserts, the later ones set ``update_cols``. Without it a repeated key is an error.
    """
    if on_conflict not in ("update", "nothing"):
        raise ValueError("on_conflict must be 'update' or 'nothing'")
    keys = list(keys)
    update_cols = list(update_cols) if on_conflict == "update" else []
    changes = one_per_key(changes, keys, order_by, update_cols)
    old = current.withColumn("_old", F.lit(True)).alias("o")
    new = changes.withColumn("_new", F.lit(True)).alias("n")
    merged = old.join(new, keys, "full_outer")
    is_old, is_new = F.col("o._old").isNotNull(), F.col("n._new").isNotNull()

    def pick(c: str):
        if c in keys:
            return F.col(c)
        if c not in changes.columns:
            return F.col(f"o.{c}").alias(c)
        new_wins = is_new if c in update_cols else ~is_old
        return F.when(new_wins, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return merged.select(*[pick(c) for c in current.columns])


def seed(current: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """Insert rows whose key is not there yet; of several the first by ``order_by``, without which they are an error."""
    first = one_per_key(rows, keys, order_by, last=())
    fresh = first.join(current.select(*keys), list(keys), "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True).select(*current.columns)


def delete_missing(
    current: DataFrame, seen: DataFrame, scope: DataFrame, keys: Sequence[str], scope_on: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split a table in rows to keep and rows to remove: in scope, but not seen."""
    keys, scope_on = list(keys), list(scope_on)
    was_seen = seen.select(*keys).distinct().withColumn("_seen", F.lit(True))
    in_scope = scope.select(*scope_on).distinct().withColumn("_scope", F.lit(True))
    marked = current.join(was_seen, keys, "left").join(in_scope, scope_on, "left")
    gone = F.col("_scope").isNotNull() & F.col("_seen").isNull()
    return marked.where(~gone).select(*current.columns), marked.where(gone).select(*current.columns)


def cascade(child: DataFrame, removed: DataFrame, fk: str, id_: str = "id") -> DataFrame:
    """Rows of a child table whose parent was not removed."""
    gone = removed.select(F.col(id_).alias(fk)).distinct()
    return child.join(gone, fk, "left_anti")


class Remaining(NamedTuple):
    """What is left of the tables when devices went."""

    olt: DataFrame
    ont: DataFrame
    power: DataFrame


def remove_devices(olt: DataFrame, ont: DataFrame, power: DataFrame, gone: DataFrame) -> Remaining:
    """Devices whose ``id`` is in ``gone`` go, with their units and the readings of these."""
    ids = gone.select("id").distinct()
    units = ont.join(ids.withColumnRenamed("id", "olt_id"), "olt_id", "left_semi")
    return Remaining(olt.join(ids, "id", "left_anti"), cascade(ont, ids, "olt_id").select(*ont.columns), cascade(power, units, "ont_id").select(*power.columns))


def fold_patches(patches: DataFrame, order_by: str | None = None) -> DataFrame:
    """One patch per id: of each field the last one sent, by ``order_by``. Without it a repeated id is an error."""
    if order_by is None:
        return one_per_key(patches, ["id"])
    sent = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("has_cto", "has_lon", "has_lat")}
    both = sent["has_lon"] & sent["has_lat"]

    def newest(value: str, if_sent):
        return F.max_by(value, F.when(if_sent, F.col(order_by))).alias(value)

    return patches.groupBy("id").agg(
        F.max(sent["has_cto"]).alias("has_cto"), newest("cto_uuid", sent["has_cto"]),
        F.max(both).alias("has_lon"), newest("lon", both), F.max(both).alias("has_lat"), newest("lat", both))


def apply_patches(ont: DataFrame, patches: DataFrame, order_by: str | None = None) -> DataFrame:
    """Set the fields a patch sent, by unit id; ids that are not there are passed over.

    A patch row says by ``has_cto``, ``has_lon`` and ``has_lat`` what was sent. A position
    needs both coordinates sent; if one of them is NULL the position becomes NULL. Patches of one id count one
    after the other by ``order_by``; without it a repeated id is an error. A patch that sends nothing is refused by ``empty_patches``.
    """
    patches = fold_patches(patches, order_by)
    lon, lat = make_point(F.col("p.lon"), F.col("p.lat"))
    has_cto = F.coalesce("p.has_cto", F.lit(False))
    has_point = F.coalesce("p.has_lon", F.lit(False)) & F.coalesce("p.has_lat", F.lit(False))
    new = {
        "cto_uuid": F.when(has_cto, F.col("p.cto_uuid")).otherwise(F.col("o.cto_uuid")),
        "lon": F.when(has_point, lon).otherwise(F.col("o.lon")),
        "lat": F.when(has_point, lat).otherwise(F.col("o.lat")),
    }
    return (
        ont.alias("o").join(patches.alias("p"), F.col("o.id") == F.col("p.id"), "left")
        .select(*[new.get(c, F.col(f"o.{c}")).alias(c) for c in ont.columns])
    )


def empty_patches(patches: DataFrame) -> DataFrame:
    """Patches that change nothing, which a caller should turn down."""
    sent = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("has_cto", "has_lon", "has_lat")}
    return patches.where(~sent["has_cto"] & ~(sent["has_lon"] & sent["has_lat"]))


def with_pon_id(ont: DataFrame, olt: DataFrame, mode: str = "stored") -> DataFrame:
    """Derive ``pon_id`` for every unit; a unit without a device gets the rule for no vendor."""
    vendors = olt.select(F.col("id").alias("olt_id"), F.col("vendor").alias("_vendor"))
    columns = [c for c in ont.columns if c != "pon_id"]
    return ont.select(*columns).join(vendors, "olt_id", "left").select(
        *columns, pon_id("_vendor", "vendor_ont_id", mode).alias("pon_id")
    )


def backfill_pon_id(ont: DataFrame, olt: DataFrame) -> DataFrame:
    """Derive ``pon_id`` where it is NULL or empty and the unit has a device."""
    vendors = olt.select(
        F.col("id").alias("olt_id"), F.col("vendor").alias("_vendor"), F.lit(True).alias("_known")
    )
    blank = (F.coalesce("pon_id", F.lit("")) == "") & F.col("_known").isNotNull()
    derived = pon_id("_vendor", "vendor_ont_id", "stored")
    return ont.join(vendors, "olt_id", "left").select(
        *[F.when(blank, derived).otherwise(F.col(c)).alias(c) if c == "pon_id" else F.col(c) for c in ont.columns]
    )


def recalc_pon_id(ont: DataFrame, olt_before: DataFrame, olt_after: DataFrame) -> DataFrame:
    """Derive ``pon_id`` again for units of devices whose vendor changed, case aside."""
    was = olt_before.select(F.col("id").alias("olt_id"), F.lower(F.coalesce("vendor", F.lit(""))).alias("_was"))
    now = olt_after.select(F.col("id").alias("olt_id"), F.col("vendor").alias("_vendor"))
    changed = now.join(was, "olt_id").where(F.lower(F.coalesce("_vendor", F.lit(""))) != F.col("_was"))
    changed = changed.select("olt_id", "_vendor", F.lit(True).alias("_changed"))
    derived = pon_id("_vendor", "vendor_ont_id", "stored")
    return ont.join(changed, "olt_id", "left").select(
        *[
            F.when(F.col("_changed"), derived).otherwise(F.col(c)).alias(c) if c == "pon_id" else F.col(c)
            for c in ont.columns
        ]
    )
