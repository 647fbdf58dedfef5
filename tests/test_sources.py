import csv
import io
import json
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from ponloom.functions.text import contains_pattern
from ponloom.operators import quality
from ponloom.operators.normalize import ZYXEL, normalize_polls
from ponloom.plans.devices import sync_devices
from ponloom.sinks import files
from ponloom.schemas import UNIT_CSV
from ponloom.sources import boxes, config, polls, tables
from ponloom.sources.quoted_lines import read_lines
from ponloom.sources.unit_csv import read_unit_csv


def put(folder, name, *documents):
    path = folder / name
    path.write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


CONFIG = {
    "defaults": {"poll_interval": 300, "prompt": ">"},
    "olts": [
        {"id": "h", "vendor": "huawei", "host": "x", "port": 23, "password": "p", "prompt": "MA", "poll_interval": 90,
         "pon_list": [{"frame": "0", "slot": 0, "port": "1"}, {"frame": "0", "slot": "2", "port": 3}], "snmp_community": "c"},
        {"id": "a", "vendor": "zyxel1240XA", "host": "x", "port": 23, "slots": ["1", "4"], "prompt": None},
        {"id": "b", "vendor": "zyxel1240XA", "host": "x", "port": 23, "filters": [], "slots": []},
        {"id": "c", "vendor": "zyxel2406", "host": "x", "port": 23, "username": "u"},
    ],
}


def test_config(spark, tmp_path):
    devices = config.overlay_config(config.read_config(spark, put(tmp_path, "c.json", json.dumps(CONFIG, indent=1))))
    assert values(config.config_devices(devices), "id", "port", "poll_interval", "prompt") == [
        ("a", 23, 300, None), ("b", 23, 300, ">"), ("c", 23, 300, ">"), ("h", 23, 90, "MA")
    ]
    assert values(config.scan_scopes(devices), "olt_id", "scope") == [
        ("a", "1"), ("a", "4"), ("b", "1"), ("c", "*"), ("h", "0/1"), ("h", "2/3")
    ]
    olt = spark.createDataFrame(
        [("h", "zyxel", "old", 1, 300, "x", "y"), ("gone", "huawei", "z", 1, 300, "x", "y")],
        "id string, vendor string, host string, port int, poll_interval int, prompt string, description string",
    )
    synced = sync_devices(olt, config.read_config(spark, str(tmp_path / "c.json")))
    assert values(synced, "id", "vendor", "host", "poll_interval", "description") == [
        ("a", "zyxel1240XA", "x", 300, None), ("b", "zyxel1240XA", "x", 300, None), ("c", "zyxel2406", "x", 300, None),
        ("gone", "huawei", "z", 300, "y"), ("h", "zyxel", "x", 90, None),
    ]
    keys = {k for r in devices.select(F.map_keys("settings")).collect() for k in r[0]}
    assert not keys & {"password", "username", "snmp_community"}


def test_poll_lines(spark, tmp_path):
    head = {"poll_id": "p", "olt_id": "o", "vendor": "zyxel1240XA", "polled_at": "2024-01-01T00:00:00Z", "outcome": "ok"}
    path = put(
        tmp_path, "polls.json",
        {**head, "slice": 1, "scope": "1", "records": [
            {"AID": "ont-1-1-1", "ONT Tx": 0, "tx": "5", "Status": "Active", "Distance": 12},
            {"AID": "ont-1-1-2", "ONT Tx": "0", "tx": "5", "Status": " is ", "FW Version": None},
            {"AID": 0, "Status": "IS"}, {"Status": "IS"},
        ]},
        {**head, "slice": 2, "scope": "2", "records": [{"AID": "ont-2-1-1", "PTX": 2.5, "Rx": "-20.5 dBm", "__filter": "9"}]},
        {**head, "poll_id": "q", "outcome": "busy"},
    )
    lines = polls.read_polls(spark, path)
    rows = normalize_polls(polls.explode_records(lines))
    assert values(rows, "vendor_ont_id", "ptx", "prx", "status", "slice", "pos") == [
        ("ont-1-1-1", 5.0, 0.0, 1, 1, 0), ("ont-1-1-2", 0.0, 0.0, 1, 1, 1), ("ont-2-1-1", 2.5, -20.5, 98, 2, 0)
    ]
    props = {r[0]: json.loads(r[1]) for r in rows.select("vendor_ont_id", "props").collect()}
    assert props["ont-1-1-1"] == {
        "AID": "ont-1-1-1", "Status": "Active", "SN": None, "Model": None, "__vendor": "zyxel1240XA", "filter": "1", "Distance": 12
    }
    assert "FW Version" in props["ont-1-1-2"] and props["ont-2-1-1"]["filter"] == "9"
    missing = normalize_polls(polls.explode_records(lines), missing="null")
    assert missing.where("prx IS NULL").count() == 2


def test_another_vendor(spark, tmp_path):
    line = {"poll_id": "p", "olt_id": "o", "vendor": "acme", "polled_at": "2024-01-01T00:00:00Z", "outcome": "ok", "records": [{"AID": "x"}]}
    records = polls.explode_records(polls.read_polls(spark, put(tmp_path, "p.json", line)))
    assert normalize_polls(records).count() == 0
    assert normalize_polls(records, vendors={"acme": ZYXEL}).first()["vendor_ont_id"] == "x"


@pytest.mark.parametrize("split", ["128m", "5k"])
def test_quoted_files_are_read_in_parallel(spark, tmp_path, split):
    """Line breaks, quotes and blank lines in cells, read split by split, against the csv module."""
    rng, want = random.Random(4), []
    bits = ["a", 'q"uote', "two\nlines", "x,y", "", "\r\nz", "é", '""', '"start', "\n\n", " sp ", 'end"', "\n,\n"]
    for n, (rows, end) in enumerate(((1500, "\n"), (40, "\r\n"), (200, "\n"), (0, "\n"))):
        names, out = [*UNIT_CSV, "extra"], io.StringIO()
        rng.shuffle(names)
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(names)
        for k in range(rows):
            # The second file has no cell with a line break, so its splits take the short way.
            writer.writerow([rng.choice(bits) if rng.random() < 0.3 and n != 1 else f"v{k}" for _ in names])
            if n == 2 and rng.random() < 0.1:
                out.write("\n")
        (tmp_path / f"{n}.csv").write_text(("\ufeff" if n == 1 else "") + out.getvalue(), newline="")
        for k, row in enumerate(csv.DictReader(io.StringIO(out.getvalue(), newline=""))):
            want.append((f"{n}.csv", k + 2, len(want) + 2, *[row[c] for c in UNIT_CSV]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        lines = read_unit_csv(spark, str(tmp_path))
        got = [(r["file"].rsplit("/", 1)[1], r["record"], r["line"], *[r[c] or "" for c in UNIT_CSV]) for r in lines.orderBy("line").collect()]
        n_splits = read_lines(spark, str(tmp_path)).select("file", "split").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want
    assert n_splits > (20 if split == "5k" else 3)


def test_plain_quotes_inside_cells(spark, tmp_path):
    """A quote that does not begin a cell is text, and opens nothing."""
    (tmp_path / "in.csv").write_text(",".join(UNIT_CSV) + '\n1,o,5" disk,,,,s,,,\n2,o,"a ""b""",,,,s,,,\n3,o,x,,,,"t\nu",,,\n')
    lines = read_unit_csv(spark, str(tmp_path / "in.csv"))
    assert values(lines, "line", "vendor_ont_id", "serial") == [(2, '5" disk', "s"), (3, 'a "b"', "s"), (4, "x", "t\nu")]


def test_csv_that_is_not_utf8_is_refused(spark, tmp_path):
    header = ",".join(UNIT_CSV)
    (tmp_path / "good.csv").write_bytes(f"{header}\n1,o,u,,,,é,,,\n".encode())
    assert read_unit_csv(spark, str(tmp_path / "good.csv")).first()["serial"] == "é"
    (tmp_path / "bad.csv").write_bytes(f"{header}\n1,o,u,,,,é,,,\n".encode("latin-1"))
    with pytest.raises(ValueError, match="UTF-8"):
        read_unit_csv(spark, str(tmp_path / "bad.csv"))


def test_duplicates_can_be_refused(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, x string")
    quality.refuse(quality.duplicates(rows, ["id", "x"]), "duplicate rows")
    with pytest.raises(ValueError, match="duplicate rows: {'id': 1, 'n_rows': 2}"):
        quality.refuse(quality.duplicates(rows, ["id"]), "duplicate rows")


def test_search_patterns(spark):
    rows = spark.createDataFrame([(x,) for x in ("a\\b", "ab", "a%b", "axb", "end\\")], "t string")
    found = lambda q, **how: {r[0] for r in rows.where(F.col("t").like(contains_pattern(q, **how))).collect()}
    assert found("a\\b") == {"ab"} and found("a\\\\b") == {"a\\b"} and found("a\\%b") == {"a%b"}
    assert found("a%b") == {"a\\b", "ab", "a%b", "axb"} and found("end\\") == {"end\\"}
    assert found("a\\b", literal=True) == {"a\\b"}


def feature(uuid, name, *spot):
    return {"type": "Feature", "geometry": {"type": "Point", "coordinates": list(spot)}, "properties": {"nombre": name, "uuid": uuid}}


def test_boxes(spark, tmp_path):
    rows = put(tmp_path, "rows.json", {"status": "OK", "data": {"rows": [{"nombre": "N", "uuid": "u"}]}})
    assert values(boxes.read_cto_rows(spark, rows)) == [("N", "u")]
    assert boxes.read_cto_rows(spark, put(tmp_path, "none.json", {"status": "OK", "data": {}})).count() == 0
    with pytest.raises(Exception, match="unexpected answer"):
        boxes.read_cto_rows(spark, put(tmp_path, "bad.json", {"status": "KO"})).collect()
    found = [feature("u", "old", 1, 2), feature("v", "V", 5, 6), feature("u", "new", 3, 4)]
    geo = put(tmp_path, "geo.json", {"status": "OK", "data": {"type": "FeatureCollection", "features": found}})
    expected = [("u", "new", 3.0, 4.0), ("v", "V", 5.0, 6.0)]
    assert values(boxes.cto_points(boxes.read_cto_geojson(spark, geo)), "uuid", "nombre", "lon", "lat") == expected
    lines = put(tmp_path, "geo.jsonl", *found)
    assert values(boxes.cto_points(boxes.read_cto_features(spark, lines)), "uuid", "nombre", "lon", "lat") == expected
    with pytest.raises(Exception, match="unexpected answer"):
        boxes.read_cto_geojson(spark, put(tmp_path, "b.json", {"status": "OK", "data": {"type": "X"}})).collect()


def test_sinks(spark, tmp_path):
    power = spark.sql("SELECT timestamp'2024-01-02 03:00:00' AS time, 7L AS ont_id, 1.5D AS ptx, -2D AS prx, 1 AS status")
    for _ in range(2):
        files.write_readings(power, str(tmp_path / "power"), 4)
    back = tables.read_table(spark, str(tmp_path / "power" / "batch=4"), "ont_power")
    assert back.count() == 1 and str(back.first()["date"]) == "2024-01-02"
    features = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":2}')], "id long, feature string")
    files.write_features(features, str(tmp_path / "f"))
    assert values(spark.read.text(str(tmp_path / "f"))) == [('{"a":1}',), ('{"a":2}',)]
