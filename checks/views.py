"""The given tables seen as a fibre network.

Every view takes whole tables. ``checks/oracle.py`` defines the same views for DuckDB.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = datetime(2024, 1, 31)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _olt_id(key: str) -> str:
    return f"'olt-' || lpad(CAST({key} AS string), 2, '0')"


def _vendor(key: str) -> str:
    return f"element_at(array('huawei', 'zyxel1408A', 'zyxel2406', 'zyxel1240XA', 'zyxel'), {key} % 5 + 1)"


def olt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation").selectExpr(
        f"{_olt_id('n_nationkey')} AS id", f"{_vendor('n_nationkey')} AS vendor",
        "'10.0.0.' || n_nationkey AS host", "23 AS port", "300 AS poll_interval", "'>' AS prompt",
        "CASE n_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE n_name END AS description",
    )


def ont(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k", "c_name", "c_mktsegment", f"{_olt_id('c_nationkey')} AS olt_id",
        """CASE WHEN c_nationkey % 5 = 0 THEN concat('0/', c_custkey % 3, '/', c_custkey % 8, '/', c_custkey)
           WHEN c_nationkey % 5 IN (2, 3) THEN concat('ont-', c_custkey % 3, '-', c_custkey % 8, '-', c_custkey)
           ELSE concat('ont-', c_custkey % 8, '-', c_custkey) END AS vendor_ont_id""",
    )
    return units.selectExpr(
        "k AS id", "olt_id", "vendor_ont_id", "if(k % 3 = 0, 'cto-' || (k % 120), NULL) AS cto_uuid",
        "if(k % 5 <> 0, -18.0D + CAST((k * 37) % 2250 AS double) / 100.0D, NULL) AS lon",
        "if(k % 5 <> 0, 27.0D + CAST((k * 53) % 1700 AS double) / 100.0D, NULL) AS lat",
        "c_name AS serial", "c_mktsegment AS model", "if(k % 7 = 0, '', c_name) AS description",
        "CAST(k % 4 AS int) AS status",
        """concat('{"AID":"', vendor_ont_id, '","Status":"IS","Distance":"', k, ' m"}') AS props""",
    )


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(
        "ts AS time", "user_id AS ont_id", "value AS ptx", "-value AS prx", "CAST(event_id % 4 AS int) AS status"
    )


def day_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as readings: many readings of a unit share a time, the order key breaks the tie."""
    return _read(spark, sf_dir, "orders").selectExpr(
        "to_date(o_orderdate) AS day", "o_custkey AS ont_id", "o_orderkey AS seq", "o_totalprice AS prx"
    )


def equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").selectExpr(
        "'cto-' || s_suppkey AS uuid", "s_name AS nombre", "if(s_suppkey % 2 = 0, 11, 7) AS tipo",
        "-18.0D + CAST((s_suppkey * 41) % 2250 AS double) / 100.0D AS lon",
        "27.0D + CAST((s_suppkey * 59) % 1700 AS double) / 100.0D AS lat",
    )


def cto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equipment(spark, sf_dir).where("tipo = 11").drop("tipo")


_STATE = """CASE event_type WHEN 'click' THEN 'is' WHEN 'error' THEN 'oos-ls' WHEN 'purchase' THEN 'Active'
    WHEN 'signup' THEN 'OOS-DG' WHEN 'view' THEN 'weird' END"""
_RUN_STATE = """CASE event_type WHEN 'click' THEN 'online' WHEN 'error' THEN 'losi' WHEN 'purchase' THEN 'offline'
    WHEN 'signup' THEN 'dyinggasp' WHEN 'view' THEN 'Online' END"""
_RX = """CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN ''
    ELSE CAST(-value AS string) || ' dBm' END"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id AS seq", f"concat(' ', {_STATE}, ' ') AS raw_status", f"{_RX} AS rx"
    )


def poll_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per event of a known unit; a poll is one device on one day.

    Polls fail by a rule on device and day. Devices of the vendor no poll can be read for are
    among them. Units with several events on a day are repeated inside the poll.
    """
    units = ont(spark, sf_dir).selectExpr("id AS user_id", "olt_id", "vendor_ont_id AS unit")
    devices = olt(spark, sf_dir).selectExpr("id AS olt_id", "vendor")
    rows = _read(spark, sf_dir, "events").join(units, "user_id").join(devices, "olt_id")
    huawei = f"""map('schema_fsp', substring_index(unit, '/', 3), 'id', split_part(unit, '/', 4),
        'run_state', {_RUN_STATE}, 'sn', 'SN' || user_id, 'description', event_type,
        'ptx', if(event_id % 4 = 0, '', CAST(value AS string)), 'tx', '1.5', 'rx', {_RX})"""
    zyxel = f"""map_filter(map('AID', if(event_id % 13 = 0, '', unit), 'Status', concat(' ', {_STATE}, ' '),
        'SN', 'SN' || user_id, 'Model', 'M-' || event_type, 'Description', event_type, 'ONT Rx', {_RX},
        'Tx', CAST(value AS string) || ' dBm', 'Distance', concat(event_id % 50, ' m'),
        '__filter', split_part(unit, '-', 2)), (k, x) -> k <> 'Distance' OR event_id % 3 = 0)"""
    return rows.selectExpr(
        "concat(olt_id, '@', date_format(ts, 'yyyy-MM-dd')) AS poll_id", "olt_id", "vendor",
        "CAST(date_trunc('day', ts) AS timestamp_ntz) AS polled_at",
        "if((day(ts) + CAST(substr(olt_id, 5, 2) AS int)) % 11 = 3, 'error', 'ok') AS outcome",
        "CAST(NULL AS array<string>) AS scopes_ok", "CAST(NULL AS array<string>) AS scopes_failed",
        "0L AS slice", "event_id AS pos", "CAST(NULL AS string) AS scope",
        f"if(vendor = 'huawei', {huawei}, {zyxel}) AS record",
    )


def poll_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records as lines of poll files, one record a line; each line says how many its poll has."""
    r = poll_records(spark, sf_dir)
    sizes = r.groupBy("poll_id").agg(F.count("*").alias("n_slices"))
    return r.join(sizes, "poll_id").selectExpr(
        "poll_id", "olt_id", "vendor", "polled_at", "outcome", "scopes_ok", "scopes_failed", "pos AS slice", "n_slices", "scope",
        "array(record) AS records",
    )


def polls_with_failed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw records; each poll of a device that is read by slots failed to read one slot, by the day."""
    slots = "array(CAST(day(polled_at) % 3 AS string))"
    return poll_records(spark, sf_dir).withColumn("scopes_failed", F.expr(f"if(vendor = 'zyxel1240XA', {slots}, NULL)"))


def config_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration document per region: defaults, and the nations as devices."""
    return _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")).selectExpr(
        "r_name", """to_json(named_struct('id', concat('cfg-', n_nationkey), 'vendor', element_at(array('huawei', 'zyxel1240XA', 'zyxel2406'), n_nationkey % 3 + 1),
            'host', n_name, 'port', 20 + n_nationkey, 'password', 'p', 'poll_interval', if(n_nationkey % 2 = 0, 60 + n_nationkey, NULL),
            'pon_list', if(n_nationkey % 3 = 0, array(named_struct('frame', '0', 'slot', n_nationkey, 'port', '1'), named_struct('frame', '0', 'slot', 2, 'port', '3')), NULL),
            'slots', if(n_nationkey % 3 = 1 AND n_nationkey > 5, array(CAST(n_nationkey AS string), '9'), NULL))) AS device""",
    ).groupBy("r_name").agg(F.collect_list("device").alias("olts")).selectExpr(
        "r_name AS answer",
        """concat('{"defaults": {"poll_interval": 300, "prompt": "', r_name, '"}, "olts": [', array_join(olts, ','), ']}') AS value""")


def box_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of the map service over all boxes, ten FeatureCollections; each box comes with an old name first."""
    boxes = cto(spark, sf_dir).selectExpr("*", "explode(array(0, 1)) AS version").selectExpr(
        "pmod(xxhash64(uuid), 10) AS answer", "version", "uuid",
        """to_json(named_struct('type', 'Feature', 'geometry', named_struct('type', 'Point', 'coordinates', array(lon, lat)),
            'properties', named_struct('nombre', if(version = 0, 'old', nombre), 'uuid', uuid))) AS feature""")
    return boxes.groupBy("answer").agg(F.array_sort(F.collect_list(F.struct("version", "uuid", "feature"))).alias("f")).selectExpr(
        "answer",
        """concat('{"status": "OK", "data": {"type": "FeatureCollection", "features": [', array_join(f.feature, ','), ']}}') AS value""")


def import_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV line per order, all cells text: edits by id, by key, new keys, and bad lines."""
    units = ont(spark, sf_dir).selectExpr("id AS c", "olt_id", "vendor_ont_id")
    orders = _read(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS c", "o_orderpriority")
    return orders.join(units, "c", "left").selectExpr(
        "k + 2 AS line",
        """CASE WHEN k % 12 = 10 THEN 'x1' WHEN k % 12 = 11 THEN ' ' || (c + 100000000)
           WHEN k % 12 < 4 THEN CAST(c AS string) ELSE '' END AS id""",
        """CASE WHEN k % 12 < 3 THEN NULL WHEN k % 12 = 8 THEN '' WHEN k % 12 = 9 THEN 'olt-99'
           ELSE coalesce(olt_id, 'olt-00') END AS olt_id""",
        """CASE WHEN k % 12 < 3 THEN NULL WHEN k % 12 = 7 THEN 'null' WHEN k % 12 IN (5, 6) THEN 'new-' || c
           WHEN k % 36 = 3 THEN 'moved-' || k ELSE vendor_ont_id END AS vendor_ont_id""",
        "CASE k % 5 WHEN 0 THEN 'null' WHEN 1 THEN concat(' cto-', k % 120, ' ') END AS cto_uuid",
        "CASE WHEN k % 7 = 0 THEN k % 90 || '.25' WHEN k % 7 = 1 THEN 'NULL' WHEN k % 35 = 2 THEN '7' END AS x",
        "CASE WHEN k % 7 = 0 THEN k % 45 || '.5' WHEN k % 7 = 1 THEN ' null' WHEN k % 35 = 3 THEN 'abc' END AS y",
        "if(k % 3 = 1, 'S' || k, '') AS serial", "if(k % 4 = 1, o_orderpriority, NULL) AS model",
        "CASE k % 11 WHEN 2 THEN 'null' WHEN 3 THEN 'd' || k ELSE '  ' END AS description",
        "CASE WHEN k % 9 = 4 THEN CAST(k % 4 AS string) WHEN k % 45 = 5 THEN '7.0' END AS status",
    )


def renumbering_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV line per unit: it takes the key of the unit two before it. The first of the even ones wants the key of the last odd one, which
    is taken, and the first of the odd ones a new key."""
    units = ont(spark, sf_dir).selectExpr("id AS k", "olt_id", "vendor_ont_id")
    wanted = units.selectExpr("k + 2 AS k", "olt_id", "vendor_ont_id").join(units.select("k"), "k", "left_semi")
    heads = units.selectExpr(
        "min(if(k % 2 = 0, k, NULL)) AS even", "min(if(k % 2 = 1, k, NULL)) AS odd",
        "max_by(named_struct('o', olt_id, 'u', vendor_ont_id), if(k % 2 = 1, k, NULL)) AS last",
    ).selectExpr("stack(2, even, last.o, last.u, odd, 'olt-00', 'renumbered') AS (k, olt_id, vendor_ont_id)")
    targets = wanted.unionByName(heads)
    empty = [f"'' AS {c}" for c in ("cto_uuid", "x", "y", "serial", "model", "description", "status")]
    return targets.selectExpr("k + 2 AS line", "CAST(k AS string) AS id", "olt_id", "vendor_ont_id", *empty)
