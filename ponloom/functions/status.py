"""Device states as integers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ponloom.functions.cells import strip_sql

UNKNOWN = 98

# State text to code.
_ZYXEL = {
    "NOT": 0, "IS": 1, "OOS": 0, "DOWN": 0, "UP": 1, "OOS-DG": 3, "OOS-LS": 2, "OOS-NR": 0,
    "OOS-PF": 0, "OOS-CD": 0, "OOS-NP": 0, "OOS-SB": 0, "O7": 0,
}
STATUS_CODES = {
    "zyxel1408A": _ZYXEL,
    "zyxel2406": _ZYXEL,
    "zyxel1240XA": {"ACTIVE": 1, "INACTIVE": 0, **_ZYXEL},
    "huawei": {"offline": 0, "online": 1, "losi": 2, "dyinggasp": 3},
}


def status_key_sql(vendor: str, raw: str) -> str:
    """State text as the code table writes it: exact for huawei, trimmed upper case elsewhere."""
    return f"if({vendor} = 'huawei', {raw}, upper({strip_sql(raw)}))"


def status_code(vendor: str, raw: str, default: int = UNKNOWN, codes: Mapping[str, Mapping[str, int]] | None = None) -> Column:
    """Code of a raw state by the fixed table, or by ``codes``; unknown and NULL states get the default."""
    tables = {
        name: "map(" + ", ".join(f"'{k}', {c}" for k, c in table.items()) + ")" for name, table in (STATUS_CODES if codes is None else codes).items()
    }
    found = " ".join(
        f"WHEN {vendor} = '{name}' THEN try_element_at({table}, {status_key_sql(vendor, raw)})"
        for name, table in tables.items()
    )
    return F.expr(f"coalesce(CASE {found} END, {default})")


def status_map(spark: SparkSession) -> DataFrame:
    """The fixed table as rows ``(vendor, raw, code)``."""
    rows = [(v, raw, code) for v, codes in STATUS_CODES.items() for raw, code in codes.items()]
    return spark.createDataFrame(rows, "vendor string, raw string, code int")


def with_status(
    df: DataFrame, codes: DataFrame, vendor: str = "vendor", raw: str = "raw_status",
    default: int = UNKNOWN,
) -> DataFrame:
    """Add ``status`` by a code table of the caller, ``(vendor, raw, code)``."""
    keyed = df.withColumn("_vendor", F.col(vendor)).withColumn("_raw", F.expr(status_key_sql(vendor, raw)))
    table = codes.selectExpr("vendor AS _vendor", "raw AS _raw", "code AS _code")
    return (
        keyed.join(table, ["_vendor", "_raw"], "left")
        .withColumn("status", F.coalesce("_code", F.lit(default)))
        .drop("_vendor", "_raw", "_code")
    )
