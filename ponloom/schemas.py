"""Table shapes. Device secrets are not part of any of them."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


_TEXT, _INT, _LONG, _DOUBLE, _TIME = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
)

# Names, types and nullability of the columns of the base tables.
OLT = _struct(
    ("id", _TEXT, False), ("vendor", _TEXT, False), ("host", _TEXT, False), ("port", _INT, False),
    ("poll_interval", _INT, False), ("prompt", _TEXT, True), ("description", _TEXT, True),
)

ONT = _struct(
    ("id", _LONG, False), ("olt_id", _TEXT, False), ("vendor_ont_id", _TEXT, False),
    ("cto_uuid", _TEXT, True), ("lon", _DOUBLE, True), ("lat", _DOUBLE, True),
    ("serial", _TEXT, True), ("model", _TEXT, True), ("description", _TEXT, True),
    ("status", _INT, True), ("props", _TEXT, False), ("pon_id", _TEXT, True),
)

ONT_POWER = _struct(
    ("time", _TIME, False), ("ont_id", _LONG, False), ("ptx", _DOUBLE, True),
    ("prx", _DOUBLE, True), ("status", _INT, True),
)

CTO = _struct(
    ("uuid", _TEXT, True), ("nombre", _TEXT, True), ("lon", _DOUBLE, True), ("lat", _DOUBLE, True),
)

# One line of a poll file. A poll may be cut into several lines (slices) of any size;
# every line repeats the header fields and, where known, the number of slices. Values stay typed until they are normalised,
# because the number 0 and the text "0" count differently in a power field.
POLL_LINE = T.StructType([
    T.StructField("poll_id", _TEXT), T.StructField("olt_id", _TEXT), T.StructField("vendor", _TEXT),
    T.StructField("polled_at", _TIME), T.StructField("outcome", _TEXT),
    T.StructField("scopes_ok", T.ArrayType(_TEXT)), T.StructField("scopes_failed", T.ArrayType(_TEXT)),
    T.StructField("slice", _LONG), T.StructField("n_slices", _LONG), T.StructField("scope", _TEXT),
    T.StructField("records", T.ArrayType(T.MapType(_TEXT, T.VariantType()))),
])

# Vendors the device table accepts.
DEVICE_VENDORS = ["huawei", "zyxel", "zyxel1408A", "zyxel2406", "zyxel1240XA"]

# The columns of the unit CSV file, in file order.
UNIT_CSV = [
    "id", "olt_id", "vendor_ont_id", "cto_uuid", "x", "y", "serial", "model", "description", "status",
]

DEFAULT_POLL_INTERVAL = 300
