"""Port (PON) ids taken out of unit ids.

There are two rules on purpose. Queries use ``mode='query'``; the stored ``pon_id`` column is
kept with ``mode='stored'``. They differ for incomplete ids (``a//`` against NULL), for ids
with a slash below a vendor that writes dashes, for unknown vendors and for vendor aliases.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession, functions as F

# Separator and number of leading parts that name the port, by vendor.
PORT_SHAPE = {
    "huawei": ("/", 3),
    "zyxel2406": ("-", 2),
    "zyxel1240XA": ("-", 2),
    "zyxel1408A": ("-", 1),
    "zyxel": ("-", 1),
}
# Lower-case vendor names the stored rule knows, by number of leading parts.
STORED_NAMES = {
    2: ["zyxel2406", "zyxel1240xa", "zyxel_1240xa", "1240xa"],
    1: ["zyxel1408a", "zyxel_1408a", "1408a", "zyxel"],
}


def _source(unit_id: str, sep: str) -> str:
    return f"regexp_replace({unit_id}, '^ont-', '')" if sep == "-" else unit_id


def _leading(unit_id: str, sep: str, parts: int) -> str:
    """The first parts of the id, empty text for a part that is not there."""
    source = _source(unit_id, sep)
    return f" || '{sep}' || ".join(f"split_part({source}, '{sep}', {i + 1})" for i in range(parts))


def _whole_leading(unit_id: str, sep: str, parts: int) -> str:
    """The first parts of the id, NULL unless all of them are there."""
    pattern = "^" + sep.join([f"[^{sep}]+"] * parts)
    return f"nullif(regexp_extract({_source(unit_id, sep)}, '{pattern}', 0), '')"


def _query_rule(vendor: str, unit_id: str) -> str:
    known = " ".join(
        f"WHEN {vendor} = '{name}' THEN {_leading(unit_id, sep, parts)}" for name, (sep, parts) in PORT_SHAPE.items()
    )
    return f"""CASE {known} WHEN contains({unit_id}, '/') THEN {_leading(unit_id, '/', 3)}
        ELSE {_leading(unit_id, '-', 1)} END"""


def _stored_rule(vendor: str, unit_id: str) -> str:
    known = " ".join(
        f"WHEN lower({vendor}) IN ({', '.join(repr(n) for n in names)}) THEN {_whole_leading(unit_id, '-', parts)}"
        for parts, names in STORED_NAMES.items()
    )
    third = f"split_part({_source(unit_id, '-')}, '-', 3)"
    return f"""CASE WHEN {unit_id} = '' THEN NULL
        WHEN contains({unit_id}, '/') THEN {_whole_leading(unit_id, '/', 3)}
        {known}
        WHEN {third} <> '' THEN {_leading(unit_id, '-', 2)}
        ELSE {_leading(unit_id, '-', 1)} END"""


def pon_id(vendor: str, unit_id: str, mode: str = "query") -> Column:
    """Port id from the SQL expressions of vendor and unit id."""
    rules = {"query": _query_rule, "stored": _stored_rule}
    if mode not in rules:
        raise ValueError("mode must be 'query' or 'stored'")
    return F.expr(rules[mode](vendor, unit_id))


#: What one read covers of a device, as SQL of the unit id ``{unit}``, by vendor; other vendors are read whole.
SCOPES = {
    "huawei": "split_part({unit}, '/', 2) || '/' || split_part({unit}, '/', 3)",
    "zyxel1240XA": _leading("{unit}", "-", 1),
}


def unit_scope(vendor: str, unit_id: str, scopes: Mapping[str, str] | None = None) -> Column:
    """The part of a device that one read covers: a port, a slot, or ``*`` for the whole device."""
    known = (SCOPES if scopes is None else scopes).items()
    whens = "".join(f" WHEN {vendor} = '{name}' THEN {scope.replace('{unit}', unit_id)}" for name, scope in known)
    return F.expr(f"CASE{whens} ELSE '*' END" if whens else "'*'")


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``derive_pon_id(vendor, unit_id)``, the stored rule, callable from SQL."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION derive_pon_id(vendor STRING, unit_id STRING)
        RETURNS STRING RETURN {_stored_rule('vendor', 'unit_id')}
    """)
