"""Plans and what follows from them."""

import os
from contextlib import redirect_stdout
from datetime import datetime
from io import StringIO

import pytest
from conftest import values
from pyspark.sql import functions as F

from checks import views as v
from checks.catalog import QUERIES
from ponloom.operators.latest import latest
from ponloom.operators.numbering import numbered, with_new_ids
from ponloom.plans import boxes, tree, units
from ponloom.sinks.files import write_readings

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def plan(df):
    out = StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_joins_are_left_to_spark(spark):
    for name in ("cto_enrich", "cto_links", "dq_orphans", "key_resolution", "unlocated_groups"):
        text = plan(QUERIES[name](spark, DATA))
        assert "CartesianProduct" not in text and "_salt" not in text


def test_last_record_of_a_poll_needs_no_sort(spark):
    text = plan(QUERIES["poll_dedup_last"](spark, DATA))
    assert "SortAggregate" not in text and "Sort " not in text


def test_rectangle_aggregates_before_the_join(spark):
    text = plan(units.units_in_bbox(v.ont(spark, DATA), v.power(spark, DATA), "-10,36,0,44"))
    assert text.count("events.parquet") == 1 and "LeftSemi" not in text


def test_numbers_and_ids(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    got = numbered(df, ["k"], F.floor(F.col("id") / 50), ["id"], "n")
    assert got.where("n <> (id - k) / 3 + 1").count() == 0
    fresh = spark.range(500).selectExpr("CAST(id AS string) AS a", "'x' AS b")
    current = spark.createDataFrame([(41,)], "id long")
    ids = with_new_ids(fresh, current, ["a", "b"])
    assert sorted(r["id"] for r in ids.collect()) == list(range(42, 542))
    assert values(ids) == values(with_new_ids(fresh.repartition(7), current, ["a", "b"]))
    none = current.limit(0)
    assert with_new_ids(fresh, none, ["a", "b"], last_id=99).agg(F.min("id")).first()[0] == 100


def test_latest_aggregates_before_the_shuffle(spark):
    text = plan(latest(v.power(spark, DATA), ["ont_id"], ["time"]))
    assert text.count("Exchange") // 2 == 1 and "SortAggregate" not in text and "Window" not in text
    ranked = plan(latest(v.day_power(spark, DATA), ["ont_id"], ["day", "seq"], "row_number"))
    assert ranked.count("WindowGroupLimit") >= 2


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "ont")
    v.ont(spark, DATA).write.parquet(path)
    ont = spark.read.parquet(path)
    text = plan(units.port_units_in_bbox(ont, v.olt(spark, DATA), "-10,36,0,44", "olt-07", "1-3"))
    assert "GreaterThanOrEqual(lon,-10.0)" in text and "EqualTo(olt_id,olt-07)" in text
    groups = plan(tree.unlocated_groups(ont, v.olt(spark, DATA)))
    assert "serial" not in groups and "props" not in groups


def day_of_sessions(spark, tmp_path):
    """Written in one zone and read in another: the same rows with and without the day column."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.sql("SELECT timestamp'2024-01-02 03:00:00' AS time, 7L AS ont_id, 1.5D AS ptx, -2D AS prx, 1 AS status")
    write_readings(rows, str(tmp_path) + "-zone", 0)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        power = spark.read.parquet(str(tmp_path) + "-zone")
        end = datetime(2024, 1, 2, 3, 30)
        counts = {units.time_range(p, end=end).count() for p in (power, power.drop("date"))}
        assert counts == {1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_days_are_pruned(spark, tmp_path):
    write_readings(v.power(spark, DATA), str(tmp_path), 0)
    day_of_sessions(spark, tmp_path)
    power = spark.read.parquet(str(tmp_path))
    text = plan(units.metric_series(power, 7, "prx", datetime(2024, 1, 5), datetime(2024, 1, 6)))
    assert "PartitionFilters: [isnotnull(date" in text
    expected = values(units.metric_series(v.power(spark, DATA), 7, "prx", datetime(2024, 1, 5), datetime(2024, 1, 6)))
    assert values(units.metric_series(power, 7, "prx", datetime(2024, 1, 5), datetime(2024, 1, 6))) == expected


def test_tree_rows_carry_the_count_of_their_device(spark):
    rows = tree.unlocated_tree(v.ont(spark, DATA), v.olt(spark, DATA)).collect()
    for r in rows:
        assert r["olt_cnt"] == sum(x["cnt"] for x in rows if x["olt_id"] == r["olt_id"])


def test_pages_follow_each_other(spark):
    ont, olt = v.ont(spark, DATA), v.olt(spark, DATA)
    one = spark.createDataFrame([(i, "olt-01", f"ont-2-{i}") for i in range(7)], "id long, olt_id string, vendor_ont_id string")
    one = one.selectExpr(
        "*", "CAST(NULL AS string) AS cto_uuid", "CAST(NULL AS double) AS lon", "CAST(NULL AS double) AS lat",
        "'' AS serial", "'' AS model", "'' AS description", "0 AS status",
    )
    pages = [[r["id"] for r in p] for p in units.unit_pages(one, olt, "olt-01", "2", size=3)]
    assert pages == [[0, 1, 2], [3, 4, 5], [6]]
    assert units.port_units_in_bbox(ont, olt, "not even read").count() == 0


def test_pages_read_the_units_once(spark):
    """The number of jobs does not grow with the pages; of ids that repeat across the end of a page the rest is passed over."""
    olt = spark.createDataFrame([("o", "zyxel2406", "")], "id string, vendor string, description string")
    port = spark.createDataFrame([(i,) for i in [*range(60), 59, 60, 60, 60]], "id long").selectExpr(
        "id", "'o' AS olt_id", "concat('ont-1-3-', id) AS vendor_ont_id", "CAST(NULL AS string) AS cto_uuid", "CAST(NULL AS double) AS lon",
        "CAST(NULL AS double) AS lat", "'' AS serial", "'' AS model", "'' AS description", "0 AS status").repartition(4).localCheckpoint()
    spark.sparkContext.setJobGroup("pages", "pages")
    try:
        pages = [[r["id"] for r in p] for p in units.unit_pages(port, olt, "o", "1-3", size=2)]
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("pages"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert pages == [[i, i + 1] for i in range(0, 60, 2)] + [[60, 60]]
    assert jobs < len(pages)


def test_parameters_are_checked(spark):
    ont, olt, power = v.ont(spark, DATA), v.olt(spark, DATA), v.power(spark, DATA)
    now = datetime(2024, 1, 31)
    for bad in (
        lambda: units.units_page(ont, power, limit=1001), lambda: units.history(power, 1, 721, as_of=now),
        lambda: units.metric_series(power, 1, "other", now, now), lambda: units.port_units(ont, olt, "a", "b", limit=0),
        lambda: units.search_units(ont, olt, ""), lambda: units.search_units(ont, olt, "a", limit=201),
        lambda: boxes.search_cto(v.cto(spark, DATA), "a"), lambda: units.units_in_bbox(ont, power, "1,1,0,0"),
    ):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(LookupError):
        units.history(power, -1, as_of=now, required=True)
    assert boxes.extent(v.ont(spark, DATA).limit(0)).first()["west"] is None
    empty = boxes.map_view(v.ont(spark, DATA).limit(0)).first()
    assert (empty["center_lat"], empty["center_lon"], empty["n_points"]) == (40.4168, -3.7038, 0)
