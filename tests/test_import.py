"""The set-based import against a line-by-line model."""

import random
import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from checks.catalog import _import_folders, _in_folders
from ponloom.operators import unit_import
from ponloom.operators.unit_import import import_units
from ponloom.schemas import UNIT_CSV
from ponloom.sinks.files import export_units, write_unit_csv
from ponloom.sources.unit_csv import read_unit_csv

ONT = "id long, olt_id string, vendor_ont_id string, cto_uuid string, lon double, lat double, serial string, model string, description string, status int, props string"
LINE = "line long, " + ", ".join(f"{c} string" for c in UNIT_CSV)
OLT = "id string, vendor string, description string"


def units(spark, rows):
    return spark.createDataFrame(rows, ONT)


def devices(spark):
    return spark.createDataFrame([("olt-a", "huawei", ""), ("olt-b", "zyxel", "B")], OLT)


def one_unit(spark):
    return units(spark, [(1, "olt-a", "u1", "c", 1.0, 2.0, "S", "M", "D", 1, "{}")])


def write_file(folder, text):
    path = folder / "in.csv"
    path.write_bytes(text.encode("utf-8-sig"))
    return str(path)


CASES = """id,olt_id,vendor_ont_id,cto_uuid,x,y,serial,model,description,status,extra
1,,,,,,S1,,,,
1,,,,,,,,,,ignored

99,,,,,,,,,
99,,,,,,S
,olt-a,u2,,-3.7,40.4,,,,
,olt-a,u2,,null,null,S2,,"two
lines",
,olt-a,u1
,olt-a,u3,,,,,,,
,,u4,,,,,,,
,olt-a,null,,,,,,,
,olt-a,u5,,1,,,,,
x,,,,,,,,,
"""


def test_file_with_all_kinds_of_lines(spark, tmp_path):
    lines = read_unit_csv(spark, write_file(tmp_path, CASES))
    done = import_units(one_unit(spark), devices(spark), lines)
    actions = [tuple(r) for r in done.lines.orderBy("line").select("line", "action", "code").collect()]
    assert actions == [
        (2, "updated", None), (3, "skipped", None), (4, "skipped", None), (5, "error", "unknown_id"),
        (6, "inserted", None), (7, "updated", None), (8, "skipped", None), (9, "inserted", None),
        (10, "error", "no_olt_id"), (11, "error", "no_vendor_ont_id"), (12, "error", "bad_position"), (13, "error", "bad_id"),
    ]
    assert tuple(done.report.first()) == (12, 2, 2, 3, 5, False)
    got = values(done.units, "olt_id", "vendor_ont_id", "lon", "lat", "serial", "description", "props")
    assert got == sorted([
        ("olt-a", "u1", 1.0, 2.0, "S1", "D", "{}"), ("olt-a", "u2", None, None, "S2", "two\nlines", "{}"),
        ("olt-a", "u3", None, None, None, None, "{}"),
    ], key=repr)
    ids = [r["id"] for r in done.units.orderBy("id").collect()]
    assert ids == [1, 2, 3]
    texts = {r["line"]: r["error"] for r in done.errors.collect()}
    assert texts[5] == "ONT id=99 no existe" and texts[13] == "invalid literal for int() with base 10: 'x'"


def test_missing_column_is_refused(spark, tmp_path):
    path = write_file(tmp_path, "id,olt_id\n1,a\n")
    with pytest.raises(ValueError, match="missing CSV columns"):
        read_unit_csv(spark, path)


def test_split_file_keeps_record_numbers(spark, tmp_path):
    text = ",".join(UNIT_CSV) + "\n" + "".join(f"{i},,,,,,serial-{i},,,\n" for i in range(2, 5002))
    path = write_file(tmp_path, text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        lines = read_unit_csv(spark, path, multi_line=False)
        assert lines.selectExpr("file").distinct().count() == 1
        assert lines.where("line <> CAST(id AS long)").count() == 0
        assert lines.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_export_then_import_changes_nothing(spark, tmp_path):
    ont = units(spark, [
        (1, "olt-b", "u9", None, None, None, None, None, None, None, "{}"),
        (2, "olt-a", 'q"u', "c,1", -3.5, 40.25, "S", "M", "D", 0, "{}"),
    ])
    path = str(tmp_path / "out")
    write_unit_csv(ont, path)
    lines = read_unit_csv(spark, path)
    done = import_units(ont, devices(spark), lines)
    assert values(done.units) == values(ont)
    assert tuple(done.report.first()) == (2, 0, 2, 0, 0, True)
    assert [r["id"] for r in export_units(ont).collect()] == [2, 1]


def test_moving_units(spark):
    ont = units(spark, [(i, "olt-a", f"u{i}", None, None, None, None, None, None, None, "{}") for i in range(1, 8)])
    rows = [
        (2, "1", "", "n1"),            # free key: moves
        (3, "2", "", "u3"),            # key of another unit
        (4, "4", "", "n4"), (5, "", "olt-a", "n4"),   # new key also touched by key
        (6, "5", "", "n5"), (7, "5", "", "n6"),       # two different keys
        (8, "6", "olt-x", ""),         # unknown device
        (9, "7", "null", ""),          # NULL key
        (10, "3", "olt-a", "u3"),      # its own key
    ]
    lines = spark.createDataFrame([(n, i, o, v, *[""] * 7) for n, i, o, v in rows], LINE)
    done = import_units(ont, devices(spark), lines)
    codes = {r["line"]: (r["action"], r["code"]) for r in done.lines.collect()}
    assert codes == {
        2: ("updated", None), 3: ("error", "duplicate_key"), 4: ("updated", None), 5: ("skipped", None),
        6: ("updated", None), 7: ("updated", None), 8: ("error", "unknown_olt"),
        9: ("error", "null_key"), 10: ("updated", None),
    }
    keys = {r["id"]: r["vendor_ont_id"] for r in done.units.collect()}
    assert keys == {1: "n1", 2: "u2", 3: "u3", 4: "n4", 5: "n6", 6: "u6", 7: "u7"}


# ---- model -------------------------------------------------------------------------------------

INT, FLOAT = re.compile(r"^[+-]?\d+$"), re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)$")
TEXT = ["cto_uuid", "serial", "model", "description"]


def model(ont, lines):
    """Apply lines one by one to a dict of units."""
    state = {u["id"]: dict(u) for u in ont}
    result, next_id = {}, max(state) + 1
    for line in sorted(lines, key=lambda r: r["line"]):
        cell = {c: (line[c] or "").strip() for c in UNIT_CSV}
        kept = {c: (None if t.lower() == "null" else t) for c, t in cell.items() if t != ""}
        bad = (
            (cell["id"] != "" and not INT.match(cell["id"]))
            or any(kept.get(c) is not None and not FLOAT.match(kept[c]) for c in ("x", "y"))
            or (kept.get("status") is not None and not INT.match(kept["status"]))
            or (("x" in kept) != ("y" in kept)) or ((kept.get("x") is None) != (kept.get("y") is None))
        )
        if bad:
            result[line["line"]] = "error"
            continue
        change = {c: kept[c] for c in TEXT if c in kept}
        if "status" in kept:
            change["status"] = None if kept["status"] is None else int(kept["status"])
        if "x" in kept:
            change["lon"] = None if kept["x"] is None else float(kept["x"])
            change["lat"] = None if kept["y"] is None else float(kept["y"])
        if cell["id"] != "":
            key = {c: kept[c] for c in ("olt_id", "vendor_ont_id") if c in kept}
            unit = state.get(int(cell["id"]))
            if not change and not key:
                result[line["line"]] = "skipped"
            elif unit is None or None in key.values() or key.get("olt_id", "olt-a") not in ("olt-a", "olt-b"):
                result[line["line"]] = "error"
            else:
                new = tuple({**unit, **key}[c] for c in ("olt_id", "vendor_ont_id"))
                if any(u is not unit and (u["olt_id"], u["vendor_ont_id"]) == new for u in state.values()):
                    result[line["line"]] = "error"
                else:
                    unit.update(change | key)
                    result[line["line"]] = "updated"
            continue
        if kept.get("olt_id") is None or kept.get("vendor_ont_id") is None or kept["olt_id"] not in ("olt-a", "olt-b"):
            result[line["line"]] = "error"
            continue
        key = (kept["olt_id"], kept["vendor_ont_id"])
        found = next((u for u in state.values() if (u["olt_id"], u["vendor_ont_id"]) == key), None)
        if found is None:
            found = dict.fromkeys(["cto_uuid", "lon", "lat", "serial", "model", "description", "status"])
            found |= {"id": next_id, "olt_id": key[0], "vendor_ont_id": key[1]}
            state[next_id] = found
            next_id += 1
            found.update(change)
            result[line["line"]] = "inserted"
        elif change:
            found.update(change)
            result[line["line"]] = "updated"
        else:
            result[line["line"]] = "skipped"
    return state, result


@pytest.mark.parametrize("free", [True, False])
def test_a_long_chain_is_settled_in_few_rounds(spark, monkeypatch, free):
    n, rounds = 10_000, []
    for name in ("_judge", "_doubled"):
        monkeypatch.setattr(unit_import, name, lambda *a, name=name, f=getattr(unit_import, name): (rounds.append(name), f(*a))[1])
    ont = spark.range(n + 1).selectExpr(
        "id", "'olt-a' AS olt_id", "'u' || id AS vendor_ont_id", "'c' AS cto_uuid", "1D AS lon", "2D AS lat", "'S' AS serial", "'M' AS model",
        "'D' AS description", "1 AS status", "'{}' AS props")
    # Unit 1 wants the key of unit 0, which stays, or a free one; every other unit wants that of the one before it.
    first = "'free'" if free else "'u0'"
    lines = spark.range(1, n + 1).selectExpr(
        "id + 1 AS line", "CAST(id AS string) AS id", "'olt-a' AS olt_id", f"if(id = 1, {first}, 'u' || (id - 1)) AS vendor_ont_id",
        *[f"'' AS {c}" for c in UNIT_CSV[3:]])
    done = import_units(ont, devices(spark), lines)
    assert {r["action"]: r["count"] for r in done.lines.groupBy("action").count().collect()} == {"updated" if free else "error": n}
    assert len(rounds) <= 20
    moved = done.units.where(f"vendor_ont_id <> if(id = 0, 'u0', if(id = 1, {first}, 'u' || (id - {1 if free else 0})))")
    assert moved.where("id > 1").count() == 0


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_tangled_chains_equal_the_model(spark, seed):
    """Renumberings forth and back, with inserts on keys that may have become free."""
    rnd = random.Random(seed)
    ont = [{"id": i, "olt_id": "olt-a", "vendor_ont_id": f"u{i}", "cto_uuid": None, "lon": None, "lat": None, "serial": "S", "model": None,
            "description": "D", "status": 1} for i in range(1, 31)]
    lines = []
    for _ in range(3):
        step, units_ = rnd.choice([1, -1]), list(range(1, 31))
        if step < 0:
            units_.reverse()
        for i in units_:
            lines.append({"id": str(i), "vendor_ont_id": f"u{i - step}" if rnd.random() < 0.9 else rnd.choice(["u3", "x1", "x2"])})
            if rnd.random() < 0.15:
                lines.append({"id": "", "olt_id": "olt-a", "vendor_ont_id": f"u{rnd.randint(0, 31)}", "serial": f"T{len(lines)}"})
    lines = [{c: "" for c in UNIT_CSV} | {"line": n + 2} | r for n, r in enumerate(lines)]
    state, actions = model(ont, lines)
    columns = ["olt_id", "vendor_ont_id", "serial"]
    done = import_units(
        units(spark, [(u["id"], u["olt_id"], u["vendor_ont_id"], None, None, None, u["serial"], None, "D", 1, "{}") for u in ont]), devices(spark),
        spark.createDataFrame([(r["line"], *[r[c] for c in UNIT_CSV]) for r in lines], LINE),
    )
    assert {r["line"]: r["action"] for r in done.lines.collect()} == actions
    assert values(done.units, *columns) == sorted((tuple(u[c] for c in columns) for u in state.values()), key=repr)


def test_files_with_other_column_orders_are_one_import(spark, tmp_path):
    head = "id,olt_id,vendor_ont_id,cto_uuid,x,y,serial,model,description,status"
    (tmp_path / "a.csv").write_text(f"{head}\n1,olt-a,new1,,,,,,,\n")
    (tmp_path / "b.csv").write_text(",".join(reversed(head.split(","))) + "\n,,,,,,,new1,olt-a,2\n,,,,,,,new2,olt-a,2\n1,x,,,,,,,,2\n")
    ont = units(spark, [(i, "olt-a", f"u{i}", "c", 1.0, 2.0, "S", "M", "D", 5, "{}") for i in (1, 2)])
    done = import_units(ont, devices(spark), read_unit_csv(spark, str(tmp_path)))
    assert values(done.units, "id", "vendor_ont_id", "status", "description") == [(1, "new1", 5, "D"), (2, "new2", 1, "x")]
    errors = [(r["file"].rsplit("/", 1)[1], r["record"], r["code"]) for r in done.errors.collect()]
    assert errors == [("b.csv", 2, "duplicate_key")] and done.report.first()["processed"] == 4


@pytest.mark.parametrize("seed,moves", [(1, 0.0), (2, 0.0), (3, 0.3), (5, 0.9)])
def test_against_line_by_line_model(spark, seed, moves):
    rnd = random.Random(seed)
    pick = rnd.choice
    ont = [
        {"id": i, "olt_id": pick(["olt-a", "olt-b"]), "vendor_ont_id": f"u{i}", "cto_uuid": pick([None, "c"]), "lon": 1.0, "lat": 2.0,
         "serial": "S", "model": None, "description": "D", "status": 1}
        for i in range(1, 9)
    ]
    lines = []
    for n in range(400 if not moves else 60):
        by_id = rnd.random() < 0.4
        text = lambda: pick(["", "", "", "null", " NULL ", f"t{n}", f" t{n} "])
        x, y = pick([("", "")] * 4 + [("null", "null"), (str(n), "2.5"), ("1", ""), ("z", "1"), ("null", "3")])
        lines.append({
            "line": n + 2, "id": pick(["1", "2", " 3 ", "7", "77", "x"]) if by_id else "",
            "olt_id": pick(["", "olt-a", "olt-b"]) if by_id and rnd.random() < moves else "" if by_id else pick(["olt-a", "olt-b", "olt-a", "olt-z", "", "null"]),
            "vendor_ont_id": pick(["", f"u{rnd.randint(1, 14)}", f"n{rnd.randint(1, 4)}"]) if by_id and rnd.random() < moves else "" if by_id else pick([f"u{rnd.randint(1, 14)}", f"u{rnd.randint(1, 14)}", "null", ""]),
            "cto_uuid": text(), "x": x, "y": y, "serial": text(), "model": text(), "description": text(),
            "status": pick(["", "", "null", "7", "7.0", "-1"]),
        })
    state, actions = model(ont, lines)
    columns = ["olt_id", "vendor_ont_id", "cto_uuid", "lon", "lat", "serial", "model", "description", "status"]
    done = import_units(
        units(spark, [(u["id"], *[u[c] for c in columns], "{}") for u in ont]), devices(spark),
        spark.createDataFrame([(r["line"], *[r[c] for c in UNIT_CSV]) for r in lines], LINE),
    )
    assert {r["line"]: r["action"] for r in done.lines.collect()} == actions
    assert values(done.units, *columns) == sorted((tuple(u[c] for c in columns) for u in state.values()), key=repr)
    assert done.units.select("id").distinct().count() == len(state)


def test_lines_without_a_key_are_spread(spark):
    """Lines that lack the key of a join would else all be sorted by one task."""
    lines = spark.range(4000).selectExpr("id AS line", "if(id % 4 = 0, id % 100, NULL) AS id", "if(id % 3 = 0, 'k', NULL) AS name")
    other = spark.createDataFrame([(k, "k", k * 10) for k in range(0, 100, 2)], "id long, name string, found long")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        for key in (["id"], ["id", "name"]):
            right = other.select(*key, "found")
            joined = unit_import._left(lines, right, key)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 4000 and max(sizes) < 1000
            plain = lines.join(right, key, "left")
            assert joined.columns == plain.columns and values(joined) == values(plain)
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_import_from_many_files_a_folder(spark, tmp_path):
    """The files of an import are written by many tasks; the place of an error in its folder stays the same."""
    spark.range(3).selectExpr("CAST(id AS int) AS n_nationkey", "'n' || id AS n_name", "0 AS n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.range(20).selectExpr("id AS c_custkey", "'c' || id AS c_name", "CAST(id % 3 AS int) AS c_nationkey", "1.0D AS c_acctbal", "'m' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(300).selectExpr("id AS o_orderkey", "id % 20 AS o_custkey", "'5-LOW' AS o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        # Without it Spark keeps all parts of a sort, so that a small folder has several files.
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lines = _import_folders(spark, str(tmp_path)).select("file", "record", "line").localCheckpoint()
        placed = values(_in_folders(lines, lines), "line", "folder", "record")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert lines.select("file").distinct().count() > 3
    # Lines from 2 to 301 of the import, and thirds of 101 numbers each.
    assert placed == sorted(((n, n // 101, n % 101 + (0 if n < 101 else 2)) for n in range(2, 302)), key=repr)
