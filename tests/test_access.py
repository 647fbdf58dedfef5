"""Ways to read little: curve, directory, trigrams, clustered readings; and upkeep with repeated keys."""

import random
import re
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import values
from pyspark.sql import functions as F

from ponloom.functions.geo import in_bbox, is_located
from ponloom.operators import curve, directory, trigrams, upkeep
from ponloom.plans import boxes, tree
from ponloom.sinks.files import write_clustered


def row_groups(path):
    """(file, metadata) of every row group below a folder."""
    for f in sorted(path.rglob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for k in range(meta.num_row_groups):
            yield f, meta.row_group(k)


def bounds(group, column):
    for k in range(group.num_columns):
        if group.column(k).path_in_schema == column:
            stats = group.column(k).statistics
            return (stats.min, stats.max) if stats is not None and stats.has_min_max else None


def test_a_rectangle_reads_few_row_groups(spark, tmp_path):
    units = spark.range(200_000).selectExpr(
        "id", "if(id % 50 = 0, NULL, -18 + 22.5 * rand(1)) AS lon", "if(id % 50 = 0, NULL, 27 + 17 * rand(2)) AS lat", "'x' || uuid() AS serial")
    curve.write_by_position(units, str(tmp_path / "units"), row_group=64 << 10)
    table = spark.read.parquet(str(tmp_path / "units"))
    box = (-10.0, 35.0, -7.75, 36.7)
    want = values(table.where(is_located() & in_bbox(box)), "id")
    assert values(curve.in_bbox_by_curve(table, box), "id") == want and 1500 < len(want) < 2500
    ranges = curve.cover(box)
    groups = [bounds(g, curve.KEY) for _, g in row_groups(tmp_path / "units")]
    read = [b for b in groups if b and any(a <= b[1] and b[0] <= z for a, z in ranges)]
    assert len(groups) > 100 and len(read) < 0.05 * len(groups)


@pytest.mark.parametrize("seed", range(3))
def test_the_cover_holds_every_point_of_a_rectangle(spark, seed):
    rng = random.Random(seed)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)] + [(180.0, 90.0), (-180.0, -90.0), (0.0, 0.0)]
    for _ in range(8):
        (a, b), (c, d) = rng.sample(points, 2)
        if a == c or b == d:
            continue
        box = (min(a, c), min(b, d), max(a, c), max(b, d))
        for most in (4, 40):
            ranges = curve.cover(box, most)
            assert len(ranges) <= most and all(x <= y for x, y in ranges) and all(p[1] < q[0] for p, q in zip(ranges, ranges[1:]))
            df = curve.with_curve_key(spark.createDataFrame(points, "lon double, lat double"))
            for r in df.where(in_bbox(box)).collect():
                assert any(x <= r[curve.KEY] <= y for x, y in ranges)


def test_deep_pages_read_two_ranges(spark):
    rows = spark.range(60_000).where("id % 7 <> 3 AND (id < 20000 OR id > 45000)").withColumn("x", F.col("id") * 2).repartition(5)
    pages = directory.page_directory(rows, width=1000)
    for offset, limit in ((0, 10), (10_990, 100), (29_990, 50), (10 ** 7, 5), (5, 0)):
        got = directory.page_at(rows, pages, offset, limit)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in rows.orderBy("id").offset(offset).limit(limit).collect()]
    # Only ids of the ranges that hold the page are asked for.
    plan = directory.page_at(rows, pages, 10_990, 100)._jdf.queryExecution().optimizedPlan().toString()
    asked = sorted(int(x) for x in re.findall(r"id#\d+L (?:>=|<) (\d+)", plan))
    low, high = sorted(set(asked) - {20_000, 45_000})
    assert high - low <= 2000 and low % 1000 == 0
    assert directory.total(pages).first()["total"] == rows.count()


def test_trigram_search_equals_the_scan(spark):
    rng = random.Random(5)
    rows = [(i, f"ont-{rng.randint(1, 3)}-{rng.randint(1, 40)}", rng.choice([None, "", f"SN{i:05}", "a%b_c\\d", "ÄÖß"])) for i in range(500)]
    units = spark.createDataFrame(rows, "id long, vendor_ont_id string, serial string")
    index = trigrams.trigram_index(units)
    for q in ("ont-1-1", "T-2", "sn0001", "%1_", "a\\%b", "öß", "b_c", "ÄÖß", "-", "zzzz", "1-%-"):
        for literal in (False, True):
            like = trigrams.contains_pattern(q, literal)
            scan = units.where(F.col("vendor_ont_id").ilike(like) | F.coalesce("serial", F.lit("")).ilike(like))
            assert values(trigrams.search_by_trigrams(units, index, q, literal), "id") == values(scan, "id"), q


def test_history_of_a_unit_reads_one_row_group_a_day(spark, tmp_path):
    start = datetime(2024, 1, 1)
    power = spark.range(300_000).selectExpr(
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 172800) AS time", "pmod(hash(id), 500) AS ont_id", "rand(3) AS ptx", "rand(4) AS prx", "1 AS status",
    ).withColumn("date", F.to_date("time"))
    write_clustered(power, str(tmp_path / "p"), row_group=128 << 10)
    for day in (start, start + timedelta(1)):
        groups = [bounds(g, "ont_id") for f, g in row_groups(tmp_path / "p" / f"date={day:%Y-%m-%d}")]
        assert len(groups) > 10
        for unit in (0, 77, 250, 499):
            assert sum(a <= unit <= b for a, b in groups) <= 2


def test_pyramid_equals_each_zoom(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(-20, 20), rng.uniform(-20, 20)) for _ in range(400)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    found = boxes.grid_pyramid(df, 0.5, 6)
    for level in range(6):
        want = boxes.grid_clusters(df, 0.5 * 2 ** level).withColumns({c: F.round(c, 6) for c in ("lon", "lat")})
        got = found.where(F.col("level") == level).withColumns({c: F.round(c, 6) for c in ("lon", "lat")})
        assert values(got, "cell_x", "cell_y", "n_points", "lon", "lat") == values(want, "cell_x", "cell_y", "n_points", "lon", "lat")


def test_devices_with_nested_ports(spark):
    olt = spark.createDataFrame([(f"o{k}", "zyxel2406", f"name {k}") for k in range(5)], "id string, vendor string, description string")
    ont = spark.createDataFrame([(n, f"o{n % 6}", f"ont-1-{n % 3}-{n}", None if n % 4 else 1.0) for n in range(60)], "id long, olt_id string, vendor_ont_id string, lon double").withColumn("lat", F.col("lon"))
    flat = tree.unlocated_tree(ont, olt).collect()
    got = []
    for after, limit in ((None, 2), ("o1", 3)):
        got += tree.unlocated_devices(ont, olt, after, limit).collect()
    assert [(r["olt_id"], r["olt_name"], r["cnt"], [tuple(p) for p in r["pons"]]) for r in got] == [
        (o, f"name {o[1]}", sum(r["cnt"] for r in flat if r["olt_id"] == o), [(r["pon_id"], r["cnt"]) for r in flat if r["olt_id"] == o]) for o in sorted({r["olt_id"] for r in flat})]


ONT = "id long, olt_id string, vendor_ont_id string, cto_uuid string, lon double, lat double, status int, note string"


def test_repeated_changes_count_one_after_the_other(spark):
    table = spark.createDataFrame([(1, "a", "u", None, None, None, 0, "kept")], ONT)
    rows = [("a", "u", 5, "first", 1), ("a", "u", 7, "second", 3), ("a", "u", 6, "third", 2), ("b", "n", 1, "born", 1), ("b", "n", 2, "later", 2)]
    changes = spark.createDataFrame(rows, "olt_id string, vendor_ont_id string, status int, note string, at int")
    keys = ["olt_id", "vendor_ont_id"]
    got = upkeep.upsert(table, changes, keys, ["status"], order_by="at")
    assert values(got, *keys, "status", "note") == [("a", "u", 7, "kept"), ("b", "n", 2, "born")]
    nothing = upkeep.upsert(table, changes, keys, on_conflict="nothing", order_by="at")
    assert values(nothing, *keys, "status", "note") == [("a", "u", 0, "kept"), ("b", "n", 1, "born")]
    assert values(upkeep.seed(table, changes.select(*keys, "status", "note", "at"), keys, order_by="at"), "status") == [(0,), (1,)]
    with pytest.raises(Exception, match="a key comes twice"):
        upkeep.upsert(table, changes.drop("at"), keys, ["status"]).collect()


def test_repeated_patches_and_boxes(spark):
    table = spark.createDataFrame([(1, "a", "u", "c0", 0.0, 0.0, 0, ""), (2, "a", "v", "c0", 0.0, 0.0, 0, "")], ONT)
    rows = [(1, True, "c1", True, 1.0, True, 1.0, 1), (1, False, "no", True, 2.0, True, 3.0, 2), (1, None, "no", True, 9.0, None, 9.0, 3), (1, True, None, None, None, None, None, 4)]
    patches = spark.createDataFrame(rows, "id long, has_cto boolean, cto_uuid string, has_lon boolean, lon double, has_lat boolean, lat double, at int")
    assert values(upkeep.apply_patches(table, patches, order_by="at"), "id", "cto_uuid", "lon", "lat") == [(1, None, 2.0, 3.0), (2, "c0", 0.0, 0.0)]
    with pytest.raises(Exception, match="a key comes twice"):
        upkeep.apply_patches(table, patches.drop("at")).collect()
    cto = spark.createDataFrame([("c0", "new", 1.0, 2.0, 5), ("c0", "old", 3.0, 4.0, 4), ("", "none", 0.0, 0.0, 1), ("", "none", 0.0, 0.0, 1)], "uuid string, nombre string, lon double, lat double, pos int")
    assert values(boxes.enrich_cto(table, cto, order_by="pos"), "id", "cto_name", "cto_lat") == [(1, "new", 2.0), (2, "new", 2.0)]
    assert boxes.cto_links(table, cto, order_by="pos").count() == 2
    with pytest.raises(Exception, match="a key comes twice"):
        boxes.enrich_cto(table, cto).collect()
