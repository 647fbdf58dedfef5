"""Hand-written expected values for the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from ponloom.functions import cells, geo, ports, status, text
from ponloom.functions.props import json_text_sql, pack_props_sql, prop

PORTS = [
    ("huawei", "0/1/2/7", "0/1/2", "0/1/2"), ("huawei", "0/1", "0/1/", None),
    ("huawei", "ont-1-2-3", "ont-1-2-3//", "1-2"), ("huawei", "", "//", None),
    ("zyxel2406", "ont-3-1-12", "3-1", "3-1"), ("zyxel2406", "ont-3", "3-", None),
    ("zyxel1240XA", "3-1-12", "3-1", "3-1"), ("zyxel1408A", "ont-1-5", "1", "1"), ("zyxel", "ont-1-5", "1", "1"),
    ("zyxel1408A", "0/1/2/7", "0/1/2/7", "0/1/2"), ("ZYXEL2406", "ont-3-1-12", "3", "3-1"),
    ("1240xa", "ont-3-1-12", "3", "3-1"), ("acme", "3-1-12", "3", "3-1"), ("acme", "3-1", "3", "3"),
    ("acme", "x", "x", "x"), ("acme", "0/1/2/7", "0/1/2", "0/1/2"), (None, "3-1-12", "3", "3-1"),
    ("huawei", None, None, None), ("zyxel1408A", "-5", "", None), ("acme", "-5", "", ""), ("acme", "--5", "", "-"),
]


def test_port_ids(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(PORTS)], "i int, v string, u string, q string, s string")
    ports.register_sql_functions(spark)
    got = df.select(
        "v", "u", ports.pon_id("v", "u"), ports.pon_id("v", "u", "stored"), F.expr("derive_pon_id(v, u)"), "q", "s", "i"
    ).orderBy("i").collect()
    for vendor, unit, query, stored, by_sql, q, s, _ in got:
        assert (query, stored, by_sql) == (q, s, s), (vendor, unit)


def test_port_mode_is_checked():
    with pytest.raises(ValueError):
        ports.pon_id("v", "u", "other")


POWER = [
    (None, 0.0), ("-22.5 dBm", -22.5), (" 3 ", 3.0), ("", 0.0), ("abc", 0.0), ("n/a", 0.0), ("-3dBm", 0.0), ("1e2", 100.0),
    (".5", 0.5), ("5.", 5.0), ("-", 0.0), ("1.5d", 0.0), ("0x1p3", 0.0), ("1_000", 1000.0), ("1__0", 0.0), ("\t7 ", 7.0),
    ("inf", math.inf), ("-Infinity", -math.inf), ("1f", 0.0), ("+2.5E-1 dBm", 0.25),
]


def test_power_text(spark):
    df = spark.createDataFrame([(t, v) for t, v in POWER], "t string, v double")
    for t, expected, got in df.select("t", "v", cells.parse_dbm("t")).collect():
        assert got == expected, t
    nulls = df.select("t", cells.parse_dbm("t", "null").alias("x")).where("x IS NULL").count()
    assert nulls == sum(1 for t, v in POWER if v == 0.0)
    nan = spark.sql("SELECT 'NaN' AS t").select(cells.parse_dbm("t")).first()[0]
    assert math.isnan(nan)


def test_first_truthy(spark):
    rows = [
        ({"ONT Tx": "2.1", "tx": "9"}, 2.1), ({"ONT Tx": "", "tx": "3"}, 3.0), ({"ONT Tx": None, "PTX": "4 dBm"}, 4.0),
        ({"ONT Tx": "0", "tx": "5"}, 0.0), ({}, 0.0),
    ]
    df = spark.createDataFrame(rows, "r map<string,string>, v double")
    picked = df.select("v", cells.first_truthy("r", "ONT Tx", "tx", "Tx", "PTX").alias("t"))
    assert all(a == b for a, b in picked.select("v", cells.parse_dbm("t")).collect())


def test_status_codes(spark):
    shared = dict(zip(
        "NOT IS OOS DOWN UP OOS-DG OOS-LS OOS-NR OOS-PF OOS-CD OOS-NP OOS-SB O7".split(),
        [0, 1, 0, 0, 1, 3, 2, 0, 0, 0, 0, 0, 0],
    ))
    rows = [(v, k, c) for v in ("zyxel1408A", "zyxel2406", "zyxel1240XA") for k, c in shared.items()]
    rows += [("zyxel1240XA", "ACTIVE", 1), ("zyxel1240XA", "INACTIVE", 0)]
    rows += [("huawei", k, c) for k, c in (("offline", 0), ("online", 1), ("losi", 2), ("dyinggasp", 3))]
    assert len(rows) == 45 and spark.createDataFrame(rows).count() == status.status_map(spark).count()
    rows += [
        ("zyxel2406", " is ", 1), ("zyxel2406", "Active", 98), ("huawei", "Online", 98), ("huawei", " online", 98),
        ("zyxel1408A", None, 98), ("huawei", None, 98), ("zyxel", "IS", 98), (None, "IS", 98),
    ]
    df = spark.createDataFrame(rows, "vendor string, raw_status string, code int")
    for row in df.withColumn("got", status.status_code("vendor", "raw_status")).collect():
        assert row.got == row.code, row
    for row in status.with_status(df, status.status_map(spark)).collect():
        assert row.status == row.code, row


def test_three_state_cells(spark):
    df = spark.createDataFrame(
        [(None,), ("",), ("  ",), ("null",), (" NULL ",), (" a ",), ("7",), ("7.0",), ("99999999999",)], "t string"
    ).select(cells.clean_cell("t").alias("t"))
    got = {
        kind: [tuple(r[0]) for r in df.select(cells.cell("t", kind)).collect()] for kind in ("text", "int", "float")
    }
    keep, null = (False, None, False), (True, None, False)
    assert got["text"] == [keep] * 3 + [null] * 2 + [(True, t, False) for t in ("a", "7", "7.0", "99999999999")]
    assert got["int"] == [keep] * 3 + [null] * 2 + [
        (True, None, True), (True, 7, False), (True, None, True), (True, None, False)
    ]
    assert got["float"] == [keep] * 3 + [null] * 2 + [
        (True, None, True), (True, 7.0, False), (True, 7.0, False), (True, 99999999999.0, False)
    ]


def test_box_rank(spark):
    rows = [("AB", "zzz", 0), ("ab-1", "zzz", 1), ("x-ab", "zzz", 2), ("x", "Abel", 3), ("x", "Crab", 4), ("x", "y", None)]
    df = spark.createDataFrame(rows, "u string, n string, s int")
    assert all(a == b for a, b in df.select("s", text.match_rank("ab", "u", "n")).collect())


def test_search_pattern():
    assert text.contains_pattern("  3-1 ") == "%3-1%"
    assert text.contains_pattern("a%b_c\\", literal=True) == "%a\\%b\\_c\\\\%"


def test_props(spark):
    df = spark.sql("SELECT map('A', 'x', 'Distance', CAST(NULL AS string), '__filter', '2') AS r")
    packed = pack_props_sql("r", {"A": "r['A']", "B": "r['B']"}, {"Distance": "Distance", "__filter": "filter", "C": "C"})
    row = df.selectExpr(f"{packed} AS p").select("p", prop("p", "filter"), F.expr("from_json(p, 'map<string,string>')")).first()
    assert row[1] == "2" and row[2] == {"A": "x", "B": None, "Distance": None, "filter": "2"}
    assert spark.sql(f"SELECT {json_text_sql(chr(39) + 'oops' + chr(39))}").first()[0] is None


def test_bbox():
    assert geo.BBox.parse("-1, -2,3,4").text() == "-1.0,-2.0,3.0,4.0"
    for bad in ("1,2,3", "a,b,c,d", "3,0,1,5", "0,5,1,5"):
        with pytest.raises(ValueError):
            geo.BBox.parse(bad)


def test_scopes(spark):
    df = spark.createDataFrame(
        [("huawei", "0/1/2/7", "1/2"), ("zyxel1240XA", "ont-3-1-12", "3"), ("zyxel2406", "ont-3-1-12", "*")], "v string, u string, s string"
    )
    assert all(a == b for a, b in df.select("s", ports.unit_scope("v", "u")).collect())
