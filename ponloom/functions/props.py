"""Unit metadata packed as JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def pack_props_sql(record: str, always: Mapping[str, str], if_present: Mapping[str, str] | None = None) -> str:
    """JSON object of fixed keys (NULL values kept) and of keys copied only where the record has them.

    ``always`` maps output keys to SQL values, ``if_present`` maps record keys to output keys.
    """
    packed = "map(" + ", ".join(f"'{key}', {value}" for key, value in always.items()) + ")"
    if if_present:
        keys = ", ".join(f"'{k}'" for k in if_present)
        names = " ".join(f"WHEN '{k}' THEN '{out}'" for k, out in if_present.items())
        wanted = f"map_filter({record}, (k, x) -> k IN ({keys}))"
        packed = f"map_concat({packed}, transform_keys({wanted}, (k, x) -> CASE k {names} END))"
    return f"to_json({packed})"


def json_text_sql(props: str) -> str:
    """The text itself if it is a JSON object, NULL otherwise."""
    return f"if(from_json({props}, 'map<string,string>') IS NOT NULL, {props}, NULL)"


def prop(props: str, key: str) -> Column:
    """One value of a props object as text."""
    return F.get_json_object(F.expr(props), f"$['{key}']")
