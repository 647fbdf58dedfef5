"""Poll application against a model that applies one poll after the other."""

import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from ponloom.operators.normalize import VENDORS, ZYXEL, normalize_polls
from ponloom.operators.presence import apply_polls, islands, poll_headers

ONT = "id long, olt_id string, vendor_ont_id string, cto_uuid string, lon double, lat double, serial string, model string, description string, status int, props string"
RECORD = (
    "poll_id string, olt_id string, vendor string, polled_at timestamp, outcome string, scopes_ok array<string>, "
    "scopes_failed array<string>, slice long, pos long, scope string, record map<string,string>"
)
T0 = dt.datetime(2024, 5, 1)


def at(n):
    return T0 + dt.timedelta(minutes=5 * n)


def poll(no, olt, vendor, units, outcome="ok", ok=(), failed=()):
    """One poll; units are (unit id, model, state) in order."""
    return {"no": no, "olt": olt, "vendor": vendor, "units": units, "outcome": outcome, "ok": list(ok), "failed": list(failed)}


def frames(spark, polls):
    lines = []
    for p in polls:
        head = (f"p{p['no']:03}", p["olt"], p["vendor"], at(p["no"]), p["outcome"], p["ok"], p["failed"])
        records = []
        for unit, model, state in p["units"]:
            if p["vendor"] == "huawei":
                fsp, number = unit.rsplit("/", 1)
                records.append({"schema_fsp": fsp, "id": number, "run_state": state, "sn": model, "description": model, "rx": "-20 dBm"})
            else:
                records.append({"AID": unit, "Status": state, "SN": model, "Model": model, "Description": model, "Rx": "-20 dBm"})
        lines += [(*head, 0, i, None, r) for i, r in enumerate(records)] or [(*head, 0, 0, None, None)]
    raw = spark.createDataFrame(lines, RECORD).cache()
    return normalize_polls(raw.where("record IS NOT NULL")), poll_headers(raw)


def scope_of(vendor, unit, parity):
    if parity:
        return "*"
    if vendor == "huawei":
        return "/".join(unit.split("/")[1:3])
    return unit.removeprefix("ont-").split("-")[0] if vendor == "zyxel1240XA" else "*"


CODES = {"IS": 1, "OOS-LS": 2, "NOT": 0, "online": 1, "losi": 2, "offline": 0}


def model(stored, polls, delete, parity, min_units):
    units = {(u[1], u[2]): {"id": u[0], "new": False, "model": u[7], "status": u[9], "readings": set()} for u in stored}
    removed = set()
    for p in sorted(polls, key=lambda p: p["no"]):
        if p["vendor"] not in VENDORS or p["outcome"] != "ok" or not p["units"]:
            continue
        seen = {unit: (m, s) for unit, m, s in p["units"]}
        scopes = ({scope_of(p["vendor"], u, parity) for u in seen} | (set() if parity else set(p["ok"])))
        scopes -= set() if parity else set(p["failed"])
        if delete and len(seen) >= min_units:
            for key in [k for k in units if k[0] == p["olt"]]:
                if key[1] not in seen and scope_of(p["vendor"], key[1], parity) in scopes:
                    gone = units.pop(key)
                    if not gone["new"]:
                        removed.add(gone["id"])
        for unit, (m, s) in seen.items():
            known = units.setdefault((p["olt"], unit), {"id": None, "new": True, "model": None if p["vendor"] == "huawei" else m, "status": None, "readings": set()})
            known["status"] = CODES[s]
            known["readings"].add(at(p["no"]))
    return units, removed


def check(spark, stored, polls, delete=True, parity=False, min_units=0):
    rows, headers = frames(spark, polls)
    after = apply_polls(spark.createDataFrame(stored, ONT), rows, headers, delete, parity, min_units)
    units, removed = model(stored, polls, delete, parity, min_units)
    known = {u[0] for u in stored}
    got = after.units.collect()
    assert len({r["id"] for r in got}) == len(got)
    assert sorted(((r.olt_id, r.vendor_ont_id, r.id if r.id in known else None, r.model, r.status) for r in got), key=repr) == sorted(
        ((k[0], k[1], u["id"], u["model"], u["status"]) for k, u in units.items()), key=repr
    )
    assert {r["id"] for r in after.removed.collect()} == removed
    ids = {r["id"]: (r["olt_id"], r["vendor_ont_id"]) for r in got}
    readings = [(ids[r["ont_id"]], r["time"]) for r in after.readings.collect()]
    assert sorted(readings) == sorted((k, t) for k, u in units.items() for t in u["readings"])
    return after


def stored_unit(i, olt, unit):
    return (i, olt, unit, "c", 1.0, 2.0, "S", "stored", "D", 5, "{}")


A, B, C = ("u", "A", "IS"), ("u", "B", "OOS-LS"), ("u", "C", "NOT")
OTHER = ("w", "W", "IS")
SEQUENCE = [
    poll(1, "o", "zyxel2406", [A, OTHER]), poll(2, "o", "zyxel2406", [OTHER]), poll(3, "o", "zyxel2406", [B, OTHER]),
    poll(4, "o", "zyxel2406", [A, OTHER], outcome="busy"), poll(5, "o", "zyxel2406", [C, OTHER]),
]


def test_unit_that_comes_back(spark):
    after = check(spark, [], SEQUENCE)
    row = after.units.where("vendor_ont_id = 'u'").first()
    assert (row.model, row.status) == ("B", 0)
    kept = check(spark, [], SEQUENCE, delete=False)
    assert (kept.units.where("vendor_ont_id = 'u'").first().model, kept.readings.count()) == ("A", 7)


def test_poll_log(spark):
    polls = [*SEQUENCE, poll(6, "o", "zyxel2406", []), poll(7, "z", "zyxel", [A])]
    rows, headers = frames(spark, polls)
    log = apply_polls(spark.createDataFrame([stored_unit(1, "o", "u")], ONT), rows, headers, min_units=2).poll_log
    got = {r["poll_id"]: (r["result"], r["evidence"]) for r in log.collect()}
    assert got == {
        "p001": ("applied", True), "p002": ("applied", False), "p003": ("applied", True), "p004": ("busy", False),
        "p005": ("applied", True), "p006": ("empty", False), "p007": ("unknown_vendor", False),
    }


def test_failed_slot_keeps_its_units(spark):
    stored = [stored_unit(1, "o", "ont-1-1-1"), stored_unit(2, "o", "ont-2-1-1"), stored_unit(3, "o", "ont-3-1-1")]
    polls = [poll(1, "o", "zyxel1240XA", [("ont-1-1-1", "M", "IS")], ok=["1", "3"], failed=["2"])]
    assert {r["id"] for r in check(spark, stored, polls).removed.collect()} == {3}
    assert {r["id"] for r in check(spark, stored, polls, parity=True).removed.collect()} == {2, 3}


@pytest.mark.parametrize("seed,how", [
    (1, {}), (2, {"parity": True}), (3, {"delete": False}), (4, {"min_units": 3}), (5, {}),
])
def test_against_model(spark, seed, how):
    rnd = random.Random(seed)
    devices = {"o1": "zyxel2406", "o2": "zyxel1240XA", "o3": "huawei"}
    names = {
        "o1": [f"ont-1-{i}" for i in range(6)], "o2": [f"ont-{s}-1-{i}" for s in (1, 2, 3) for i in range(3)],
        "o3": [f"0/{s}/{p}/{i}" for s in (1, 2) for p in (0, 1) for i in range(2)],
    }
    states = {"huawei": ["online", "losi", "offline"]}
    stored = [stored_unit(100 + i, olt, u) for i, (olt, u) in enumerate((o, u) for o in names for u in names[o]) if rnd.random() < 0.6]
    stored += [stored_unit(999, "o4", "ont-1-1")]
    polls = []
    for no in range(36):
        olt = rnd.choice(list(devices))
        vendor = devices[olt]
        seen = [
            (u, f"m{no}-{k}", rnd.choice(states.get(vendor, ["IS", "OOS-LS", "NOT"])))
            for k in range(2) for u in names[olt] if rnd.random() < (0.8 if k == 0 else 0.1)
        ]
        scopes = sorted({scope_of(vendor, u, False) for u in names[olt]} - {"*"})
        failed = [s for s in scopes if rnd.random() < 0.2]
        if rnd.random() < 0.5:
            seen = [x for x in seen if scope_of(vendor, x[0], False) not in failed]
        polls.append(poll(
            no, olt, vendor, seen if rnd.random() < 0.9 else [], rnd.choice(["ok"] * 8 + ["busy", "error"]),
            [s for s in scopes if s not in failed and rnd.random() < 0.5], failed,
        ))
    check(spark, stored, polls, **how)


def test_a_failed_slice_fails_its_poll(spark):
    stored = spark.createDataFrame([stored_unit(1, "o", "a"), stored_unit(2, "o", "b")], ONT)
    lines = [
        ("p", "o", "zyxel2406", at(1), "ok", [], [], 0, 0, "1", {"AID": "a", "Status": "IS"}),
        ("p", "o", "zyxel2406", at(1), "error", [], [], 1, 0, "2", None),
    ]
    raw = spark.createDataFrame(lines, RECORD)
    after = apply_polls(stored, normalize_polls(raw.where("record IS NOT NULL")), poll_headers(raw))
    assert values(after.units) == values(stored) and after.readings.count() == 0 and after.removed.count() == 0
    assert values(after.poll_log, "poll_id", "result") == [("p", "error")]


def test_a_vendor_of_the_caller(spark):
    acme = {**ZYXEL, "codes": {"GOOD": 7}, "scope": "split_part({unit}, ':', 1)"}
    vendors = {**VENDORS, "acme": acme}
    stored = spark.createDataFrame([stored_unit(1, "o", "a:1"), stored_unit(2, "o", "a:2"), stored_unit(3, "o", "b:1")], ONT).withColumn("pon_id", F.lit("old"))
    lines = [("p", "o", "acme", at(1), "ok", [], [], 0, 0, None, {"AID": "a:1", "Status": " good "})]
    raw = spark.createDataFrame(lines, RECORD)
    devices = spark.createDataFrame([("o", "acme")], "id string, vendor string")
    after = apply_polls(stored, normalize_polls(raw, vendors=vendors), poll_headers(raw), vendors=vendors, olt=devices)
    assert values(after.units, "id", "vendor_ont_id", "status", "pon_id") == [(1, "a:1", 7, "a:1"), (3, "b:1", 5, "b:1")]
    assert values(after.removed, "id") == [(2,)] and after.poll_log.first()["result"] == "applied"


def test_long_runs_cross_buckets(spark, monkeypatch):
    import ponloom.operators.presence as presence

    monkeypatch.setattr(presence, "POLLS_PER_BUCKET", 4)
    there = [1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 13, 20]
    seen = spark.createDataFrame([("o", "u", "*", n) for n in there], "olt_id string, vendor_ont_id string, scope string, poll_no long")
    assert values(islands(seen), "first_poll", "last_poll", "n_polls") == [(1, 6, 6), (20, 20, 1), (9, 13, 5)]
