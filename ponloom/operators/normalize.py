"""Raw poll records of all vendors in one shape, in one pass.

A vendor is a table of SQL expressions that pick raw fields out of ``record``. Power, state and
metadata are then read the same way for all. ``raw`` is the record as it came, for the metadata, and
``unit_raw`` and ``vendor_raw`` are unit id and vendor in the type of its values. More vendors are added to a copy of ``VENDORS``;
their rows go through the same scan. Besides the fields an entry may have ``codes``, the vendor's state
texts with their codes, and ``scope``, SQL of ``{unit}`` for the part of a device that one read covers; an entry
without them shares those of the name given as ``like``, or has none.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ponloom.functions.cells import first_truthy_sql, parse_dbm
from ponloom.functions.props import pack_props_sql
from ponloom.functions.ports import SCOPES
from ponloom.functions.status import STATUS_CODES, status_code

Fields = dict[str, Any]

# Record keys that may hold the power, first choice first.
HUAWEI_TX, HUAWEI_RX = ("ptx", "tx"), ("prx", "rx")
ZYXEL_TX, ZYXEL_RX = ("ONT Tx", "tx", "Tx", "PTX"), ("ONT Rx", "rx", "Rx", "PRX")
# Record keys kept as metadata.
HUAWEI_META = ["schema_fsp", "control_flag", "run_state", "config_state", "match_state", "protect_side"]
ZYXEL_META = ["AID", "Status", "SN", "Model"]
ZYXEL_EXTRA = ["Template-ID", "FW Version", "Distance"]

# A number 0 or a false under one of these keys counts as not there.
_TRUTHY_KEYS = [*HUAWEI_TX, *HUAWEI_RX, *ZYXEL_TX, *ZYXEL_RX, "AID"]


def _text(key: Column, value: Column) -> Column:
    """A typed value as text."""
    text = F.try_variant_get(value, "$", "string")
    is_text = F.schema_of_variant(value) == "STRING"
    zero = F.coalesce(text.try_cast("double") == 0, F.lower(text) == "false")
    # The type last: to ask for it takes longer than all the rest.
    return F.when(~key.isin(_TRUTHY_KEYS) | ~F.coalesce(zero, F.lit(False)) | is_text, text)


_HUAWEI_UNIT = "coalesce(record['schema_fsp'], 'None') || '/' || coalesce(record['id'], 'None')"

HUAWEI: Fields = {
    "vendor_ont_id": _HUAWEI_UNIT,
    "tx": first_truthy_sql("record", *HUAWEI_TX),
    "rx": first_truthy_sql("record", *HUAWEI_RX),
    "state": "record['run_state']",
    "serial": "record['sn']",
    "model": "CAST(NULL AS string)",
    "description": "record['description']",
    "props": pack_props_sql("raw", {"id": "unit_raw", **{k: f"raw['{k}']" for k in HUAWEI_META}}),
}


def _zyxel(copied: Mapping[str, str]) -> Fields:
    meta = {**{k: f"raw['{k}']" for k in ZYXEL_META}, "__vendor": "vendor_raw"}
    return {
        "vendor_ont_id": "nullif(record['AID'], '')",
        "tx": first_truthy_sql("record", *ZYXEL_TX),
        "rx": first_truthy_sql("record", *ZYXEL_RX),
        "state": "record['Status']",
        "serial": "record['SN']",
        "model": "record['Model']",
        "description": "record['Description']",
        "props": pack_props_sql("raw", meta, copied),
    }


ZYXEL = _zyxel({k: k for k in ZYXEL_EXTRA})
ZYXEL_1240XA = _zyxel({"__filter": "filter", **{k: k for k in ZYXEL_EXTRA}})

VENDORS: dict[str, Fields] = {
    "huawei": HUAWEI, "zyxel1408A": ZYXEL, "zyxel2406": ZYXEL, "zyxel1240XA": ZYXEL_1240XA,
}


def state_codes(vendors: Mapping[str, Fields]) -> dict[str, Mapping[str, int]]:
    """State codes by vendor."""
    return {n: f.get("codes", STATUS_CODES.get(f.get("like", n), {})) for n, f in vendors.items()}


def scopes(vendors: Mapping[str, Fields]) -> dict[str, str]:
    """SQL of the scope by vendor, for those that are not read whole."""
    found = {n: f.get("scope", SCOPES.get(f.get("like", n))) for n, f in vendors.items()}
    return {n: s for n, s in found.items() if s}


def _by_vendor(vendors: Mapping[str, Fields], field: str) -> str:
    names: dict[str, list[str]] = {}
    for name, fields in vendors.items():
        names.setdefault(fields[field], []).append(f"'{name}'")
    whens = " ".join(f"WHEN vendor IN ({', '.join(of)}) THEN {value}" for value, of in names.items())
    return f"CASE {whens} END AS {field}"


def normalize_polls(
    records: DataFrame, missing: str = "zero", vendors: Mapping[str, Fields] | None = None
) -> DataFrame:
    """One row per usable record; records without a unit id or of an unknown vendor are left out.

    ``records`` has the poll header, ``slice``, ``pos`` and ``record``, a map of text or of typed values. Typed values keep
    their type in the metadata: a number stays a number.
    """
    vendors = VENDORS if vendors is None else vendors
    pick = {f: _by_vendor(vendors, f) for f in HUAWEI}
    rows = records.where((F.col("outcome") == "ok") & F.col("vendor").isin(list(vendors)))
    typed = isinstance(rows.schema["record"].dataType.valueType, T.VariantType)
    if typed:
        # Made by a generator of one row, because Spark moves no filter below it: the filter on the unit would make the text of all values anew.
        texts = F.explode(F.array(F.transform_values("raw", _text))).alias("record")
        rows = rows.withColumnRenamed("record", "raw").select("*", texts)
    else:
        rows = rows.withColumn("raw", F.col("record"))
    of_type = "CAST({} AS variant)" if typed else "{}"
    head = ["poll_id", "olt_id", "vendor", "slice", "pos", "polled_at AS time"]
    named = rows.selectExpr(*head, "record", "raw", pick["vendor_ont_id"], f"{of_type.format('vendor')} AS vendor_raw").where("vendor_ont_id IS NOT NULL")
    picked = named.withColumn("unit_raw", F.expr(of_type.format("vendor_ont_id"))).selectExpr(
        *[h.split(" AS ")[-1] for h in head], "vendor_ont_id", *[sql for f, sql in pick.items() if f != "vendor_ont_id"])
    return picked.select(
        "poll_id", "olt_id", "vendor", "slice", "pos", "time", "vendor_ont_id",
        parse_dbm("tx", missing).alias("ptx"), parse_dbm("rx", missing).alias("prx"),
        status_code("vendor", "state", codes=state_codes(vendors)).alias("status"), "serial", "model", "description", "props",
    )
