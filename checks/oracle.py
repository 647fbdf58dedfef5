"""SQL for DuckDB that answers the registered queries by other means.

The views are those of ``checks/views.py``, written in SQL. Where the library folds or aggregates,
the SQL uses windows, anti joins or plain matrices.
"""

from __future__ import annotations

VENDOR = "CASE {k} % 5 WHEN 0 THEN 'huawei' WHEN 1 THEN 'zyxel1408A' WHEN 2 THEN 'zyxel2406' WHEN 3 THEN 'zyxel1240XA' ELSE 'zyxel' END"

VIEWS = f"""
olt_v AS (
  SELECT 'olt-' || lpad(n_nationkey::varchar, 2, '0') AS id, {VENDOR.format(k='n_nationkey')} AS vendor,
    '10.0.0.' || n_nationkey AS host, 23 AS port, 300 AS poll_interval, '>' AS prompt,
    CASE WHEN n_nationkey % 4 = 0 THEN '' WHEN n_nationkey % 4 <> 1 THEN n_name END AS description
  FROM nation),
ont_k AS (
  SELECT c_custkey AS k, c_nationkey AS n, {VENDOR.format(k='c_nationkey')} AS vendor, c_name, c_mktsegment
  FROM customer),
ont_u AS (
  SELECT *, CASE WHEN vendor = 'huawei' THEN '0/' || (k%3) || '/' || (k%8) || '/' || k
    WHEN vendor IN ('zyxel2406', 'zyxel1240XA') THEN 'ont-' || (k%3) || '-' || (k%8) || '-' || k
    ELSE 'ont-' || (k%8) || '-' || k END AS uid
  FROM ont_k),
ont_v AS (
  SELECT k AS id, 'olt-' || lpad(n::varchar, 2, '0') AS olt_id, uid AS vendor_ont_id,
    CASE WHEN k % 3 = 0 THEN 'cto-' || (k % 120) END AS cto_uuid,
    CASE WHEN k % 5 <> 0 THEN -18.0::double + ((k*37) % 2250)::double / 100.0::double END AS lon,
    CASE WHEN k % 5 <> 0 THEN 27.0::double + ((k*53) % 1700)::double / 100.0::double END AS lat,
    c_name AS serial, c_mktsegment AS model, CASE WHEN k % 7 = 0 THEN '' ELSE c_name END AS description,
    (k % 4)::int AS status, k || ' m' AS distance
  FROM ont_u),
power_v AS (
  SELECT ts AS time, user_id AS ont_id, value AS ptx, -value AS prx, (event_id % 4)::int AS status FROM events),
equipment_v AS (
  SELECT 'cto-' || s_suppkey AS uuid, s_name AS nombre, CASE WHEN s_suppkey % 2 = 0 THEN 11 ELSE 7 END AS tipo,
    -18.0::double + ((s_suppkey*41) % 2250)::double / 100.0::double AS lon,
    27.0::double + ((s_suppkey*59) % 1700)::double / 100.0::double AS lat
  FROM supplier),
cto_v AS (SELECT uuid, nombre, lon, lat FROM equipment_v WHERE tipo = 11),
raw_v AS (
  SELECT event_id AS seq,
    ' ' || CASE event_type WHEN 'click' THEN 'is' WHEN 'error' THEN 'oos-ls' WHEN 'purchase' THEN 'Active'
      WHEN 'signup' THEN 'OOS-DG' ELSE 'weird' END || ' ' AS raw_status,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'n/a' WHEN event_id % 10 = 2 THEN ''
      ELSE (-value)::varchar || ' dBm' END AS rx
  FROM events),
last_v AS (
  SELECT ont_id, time, ptx, prx, status FROM (
    SELECT *, row_number() OVER (PARTITION BY ont_id ORDER BY time DESC) AS rn FROM power_v) WHERE rn = 1)
"""

# How a vendor writes the port in a unit id: separator and number of parts that name it.
PORT_FORMS = [("huawei", "/", 3), ("zyxel2406", "-", 2), ("zyxel1240XA", "-", 2), ("zyxel1408A", "-", 1), ("zyxel", "-", 1)]
# Lower-case names that the stored rule knows, with their number of parts.
STORED_PARTS = [(2, ["zyxel2406", "zyxel1240xa", "zyxel_1240xa", "1240xa"]), (1, ["zyxel1408a", "zyxel_1408a", "1408a", "zyxel"])]


def _parts(u: str, sep: str) -> str:
    """The parts of a unit id as a list; a leading word ont- names no part where dashes separate."""
    bare = f"CASE WHEN starts_with({u}, 'ont-') THEN substr({u}, 5) ELSE {u} END" if sep == "-" else u
    return f"string_split({bare}, '{sep}')"


def _joined(u: str, sep: str, n: int) -> str:
    """The first n parts put together; parts that are not there are empty."""
    return f"array_to_string(list_resize(list_slice({_parts(u, sep)}, 1, {n}), {n}, ''), '{sep}')"


def _form(vendor: str, u: str) -> str:
    """Number of the form of a unit: those of known vendors, then by what the id looks like."""
    names = [name for name, _, _ in PORT_FORMS]
    return f"CASE WHEN {vendor} IN {tuple(names)} THEN list_position({names}, {vendor}) WHEN contains({u}, '/') THEN -1 ELSE -2 END"


def _pon_query(vendor: str, u: str) -> str:
    forms = [(k + 1, sep, n) for k, (_, sep, n) in enumerate(PORT_FORMS)] + [(-1, "/", 3), (-2, "-", 1)]
    return f"CASE {_form(vendor, u)} " + " ".join(f"WHEN {k} THEN {_joined(u, sep, n)}" for k, sep, n in forms) + " END"


def _complete(u: str, sep: str, n: int) -> str:
    """The first n parts, or nothing if one of them is missing or empty."""
    first = f"list_slice({_parts(u, sep)}, 1, {n})"
    return f"CASE WHEN len(list_filter({first}, lambda p: p <> '')) = {n} THEN array_to_string({first}, '{sep}') END"


def _pon_stored(vendor: str, u: str) -> str:
    count = " ".join(f"WHEN lower({vendor}) IN {tuple(names)} THEN {n}" for n, names in STORED_PARTS)
    by_name = f"CASE {count} ELSE 0 END"
    has_third = f"coalesce(list_extract({_parts(u, '-')}, 3), '') <> ''"
    return f"""CASE WHEN nullif({u}, '') IS NULL THEN NULL WHEN contains({u}, '/') THEN {_complete(u, '/', 3)}
      ELSE CASE {by_name} WHEN 2 THEN {_complete(u, '-', 2)} WHEN 1 THEN {_complete(u, '-', 1)}
        ELSE CASE WHEN {has_third} THEN {_joined(u, '-', 2)} ELSE {_joined(u, '-', 1)} END END END"""


PORTS = f"""
port_v AS (
  SELECT o.id, o.olt_id, coalesce(nullif(l.description, ''), l.id) AS olt_name, o.vendor_ont_id,
    {_pon_query('l.vendor', 'o.vendor_ont_id')} AS pon_id, o.cto_uuid, o.lat, o.lon, o.status, o.serial, o.model,
    o.description
  FROM ont_v o JOIN olt_v l ON l.id = o.olt_id)
"""

NUMBER = r"'^[+-]?([0-9]+(_[0-9]+)*[.]?([0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$'"


def _dbm(t: str) -> str:
    clean = f"trim(replace({t}, ' dBm', ''))"
    return f"CASE WHEN regexp_matches({clean}, {NUMBER}) THEN try_cast(replace({clean}, '_', '') AS double) END"


# State texts with their codes, by vendor; the others take upper case without blanks around it.
HUAWEI_STATES = [("offline", 0), ("online", 1), ("losi", 2), ("dyinggasp", 3)]
ZYXEL_STATES = [
    ("NOT", 0), ("IS", 1), ("OOS", 0), ("DOWN", 0), ("UP", 1), ("OOS-DG", 3), ("OOS-LS", 2), ("OOS-NR", 0), ("OOS-PF", 0),
    ("OOS-CD", 0), ("OOS-NP", 0), ("OOS-SB", 0), ("O7", 0),
]
STATES = [("huawei", HUAWEI_STATES), ("zyxel1408A", ZYXEL_STATES), ("zyxel2406", ZYXEL_STATES), ("zyxel1240XA", [*ZYXEL_STATES, ("ACTIVE", 1), ("INACTIVE", 0)])]
UNKNOWN_STATE = 98


def _status(vendor: str, raw: str) -> str:
    rows = [f"'{name}|{text}': {code}" for name, pairs in STATES for text, code in pairs]
    key = f"{vendor} || '|' || CASE WHEN {vendor} = 'huawei' THEN {raw} ELSE upper(trim({raw})) END"
    return f"coalesce(map_extract(MAP {{{', '.join(rows)}}}, {key})[1], {UNKNOWN_STATE})"


ORACLE: dict[str, str] = {}


def sql(name: str, body: str, ports: bool = False, more: str = "") -> None:
    views = VIEWS + ("," + PORTS if ports else "") + ("," + more if more else "")
    ORACLE[name] = f"WITH {'RECURSIVE ' if 'walk_v' in views else ''}{views} {body}"


sql("latest_reading", "SELECT ont_id, time, ptx, prx, status FROM last_v")
ORACLE["latest_folded"] = ORACLE["latest_reading"]
sql("latest_reading_rownum", """
SELECT day, ont_id, seq, prx FROM (
  SELECT o_orderdate::date AS day, o_custkey AS ont_id, o_orderkey AS seq, o_totalprice AS prx,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::date DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")

UNIT_ROW = """o.id, o.olt_id, o.vendor_ont_id, o.status, o.cto_uuid, o.serial, o.model, o.description, o.lat, o.lon,
  l.ptx, l.prx, l.time AS last_read"""
sql("units_page", f"SELECT {UNIT_ROW} FROM ont_v o JOIN last_v l ON l.ont_id = o.id ORDER BY o.id LIMIT 20")
sql("units_page_by_olt", f"""SELECT {UNIT_ROW} FROM ont_v o JOIN last_v l ON l.ont_id = o.id
WHERE o.olt_id = 'olt-07' ORDER BY o.id LIMIT 1000""")
sql("units_page_after", f"""SELECT {UNIT_ROW} FROM ont_v o JOIN last_v l ON l.ont_id = o.id
WHERE o.id > 20 ORDER BY o.id LIMIT 50 OFFSET 10""")
sql("units_total", """SELECT 'all' AS scope, count(*) AS total FROM ont_v
UNION ALL SELECT 'joined', count(*) FROM ont_v WHERE id IN (SELECT ont_id FROM power_v)""")
ORACLE["units_page_kept"] = ORACLE["units_page"]
sql("units_page_order", """SELECT row_number() OVER (ORDER BY o.id) - 1 AS place, o.id, l.time AS last_read
FROM ont_v o JOIN last_v l ON l.ont_id = o.id ORDER BY o.id LIMIT 1000""")
sql("unit_history_order", """SELECT row_number() OVER (ORDER BY time DESC) - 1 AS place, time, ptx, prx, status FROM power_v
WHERE ont_id = 7 AND time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 HOUR""")
sql("cto_search_order", """SELECT row_number() OVER (ORDER BY nombre, uuid) - 1 AS place, uuid, 1 AS score FROM cto_v ORDER BY place LIMIT 80""")
sql("unit_history", """SELECT time, ptx, prx, status FROM power_v
WHERE ont_id = 7 AND time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 HOUR""")
sql("metric_series", """SELECT ont_id, 'status' AS metric, status::double AS value, time AS timestamp FROM power_v
WHERE ont_id = 7 AND time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
sql("metric_long", """SELECT ont_id, 'ptx' AS metric, ptx AS value, time AS timestamp FROM power_v
UNION ALL SELECT ont_id, 'prx', prx, time FROM power_v
UNION ALL SELECT ont_id, 'status', status::double, time FROM power_v""")
IN_BOX = "o.lon BETWEEN -10 AND 0 AND o.lat BETWEEN 36 AND 44"
sql("geo_bbox_latest", f"""SELECT o.id, o.olt_id, o.vendor_ont_id, o.status, o.cto_uuid, o.description, o.model, o.serial,
  o.lat, o.lon, l.ptx, l.prx, l.time AS last_read, l.status AS power_status
FROM ont_v o JOIN last_v l ON l.ont_id = o.id WHERE {IN_BOX}""")
sql("geojson_features", f"""SELECT o.id, 'Feature' AS type, 'Point' AS kind, o.lon, o.lat, o.id::varchar AS external_id,
  o.vendor_ont_id AS external_name, o.serial AS sn, o.status::varchar AS state, o.cto_uuid AS topology, o.distance, l.prx
FROM ont_v o JOIN last_v l ON l.ont_id = o.id WHERE {IN_BOX}""")
PORT_BOX = "olt_id = 'olt-07' AND pon_id = '1-3' AND lon BETWEEN -19 AND 5 AND lat BETWEEN 26 AND 45"
sql("geo_port_bbox", f"SELECT * FROM port_v WHERE {PORT_BOX}", ports=True)
sql("geojson_port_features", f"SELECT id, lon, lat, olt_name, pon_id, serial FROM port_v WHERE {PORT_BOX}", ports=True)
sql("olt_list", "SELECT id, coalesce(nullif(description, ''), id) AS name FROM olt_v")
sql("pon_list", "SELECT DISTINCT pon_id AS id, pon_id AS name FROM port_v WHERE olt_id = 'olt-07'", ports=True)
NAMED = "(SELECT id, unnest([vendor, upper(vendor), 'acme', '1240xa']) AS vendor FROM olt_v)"
for _mode, _rule in (("query", _pon_query), ("stored", _pon_stored)):
    sql(f"pon_id_{_mode}_mode", f"""SELECT o.id, l.vendor, {_rule('l.vendor', 'o.vendor_ont_id')} AS pon_id
    FROM ont_v o JOIN {NAMED} l ON l.id = o.olt_id""")
sql("port_units_page", "SELECT * FROM port_v WHERE olt_id = 'olt-07' AND pon_id = '1-3' ORDER BY id LIMIT 200", ports=True)
sql("port_units_unlocated", """SELECT * FROM port_v WHERE olt_id = 'olt-07' AND pon_id = '1-3' AND lon IS NULL
ORDER BY id LIMIT 5""", ports=True)
sql("unit_search", r"""SELECT * FROM port_v WHERE lon IS NULL AND (vendor_ont_id ILIKE '%1-12%' ESCAPE '\'
  OR vendor_ont_id ILIKE '%ont-1-12%' ESCAPE '\' OR coalesce(serial, '') ILIKE '%1-12%' ESCAPE '\')
ORDER BY id LIMIT 50""", ports=True)
sql("unit_pages_keyset", """SELECT (row_number() OVER (ORDER BY id) - 1) // 2 AS page, id FROM port_v
WHERE olt_id = 'olt-07' AND pon_id = '1-3' AND lon IS NULL""", ports=True)
sql("unit_search_escape", """SELECT id, serial FROM port_v WHERE serial ILIKE '%Customer#0000000%' ORDER BY id LIMIT 200""", ports=True)
sql("unit_search_total", r"""SELECT count(*) AS total FROM port_v
WHERE vendor_ont_id ILIKE '%ONT-2-_%' ESCAPE '\' OR coalesce(serial, '') ILIKE '%ONT-2-_%' ESCAPE '\'""", ports=True)
GROUPS = """groups_v AS (SELECT olt_id, olt_name, pon_id, count(*)::int AS cnt FROM port_v WHERE lon IS NULL
  GROUP BY olt_id, olt_name, pon_id)"""
sql("unlocated_groups", "SELECT * FROM groups_v", ports=True, more=GROUPS)
sql("unlocated_rollup", """SELECT 0 AS level, olt_id, olt_name, pon_id, cnt::bigint AS cnt FROM groups_v
UNION ALL SELECT 1, olt_id, olt_name, NULL, sum(cnt)::bigint FROM groups_v GROUP BY olt_id, olt_name
UNION ALL SELECT 2, NULL, NULL, NULL, sum(cnt)::bigint FROM groups_v""", ports=True, more=GROUPS)
sql("unlocated_tree", """SELECT olt_id, olt_name, (sum(cnt) OVER (PARTITION BY olt_id))::bigint AS olt_cnt, pon_id, cnt
FROM groups_v""", ports=True, more=GROUPS)
sql("cto_list", "SELECT nombre, uuid FROM equipment_v WHERE tipo = 11")
sql("cto_search_ranked", """SELECT uuid, nombre, CASE WHEN lower(uuid) = 'o-2' THEN 0 WHEN lower(uuid) LIKE 'o-2%' THEN 1
  WHEN lower(uuid) LIKE '%o-2%' THEN 2 WHEN lower(nombre) LIKE 'o-2%' THEN 3 ELSE 4 END AS score
FROM cto_v WHERE lower(uuid) LIKE '%o-2%' OR lower(nombre) LIKE '%o-2%' ORDER BY score, nombre, uuid LIMIT 80""")
sql("cto_enrich", """SELECT o.id, o.olt_id, o.vendor_ont_id, o.cto_uuid, o.lon, o.lat, o.serial, o.model, o.description, o.status,
  c.nombre AS cto_name, c.lon AS cto_lon, c.lat AS cto_lat FROM ont_v o LEFT JOIN cto_v c ON c.uuid = o.cto_uuid""")
sql("cto_enrich_repeated", """SELECT o.id, o.cto_uuid, c.nombre || '/2' AS cto_name, c.lon + 2 AS cto_lon, c.lat AS cto_lat
FROM ont_v o LEFT JOIN cto_v c ON c.uuid = o.cto_uuid""")
sql("cto_links", """SELECT o.id, o.cto_uuid, o.lon AS lon1, o.lat AS lat1, c.lon AS lon2, c.lat AS lat2
FROM ont_v o JOIN cto_v c ON c.uuid = o.cto_uuid WHERE o.lon IS NOT NULL""")


def _extent(points: str, pad: float) -> str:
    return f"""SELECT round(w - (e - w) * {pad}::double, 6) AS west, round(s - (n - s) * {pad}::double, 6) AS south,
  round(e + (e - w) * {pad}::double, 6) AS east, round(n + (n - s) * {pad}::double, 6) AS north, n_points
FROM (SELECT min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n, count(lon) AS n_points FROM ({points}))"""


sql("extent_units", _extent("SELECT lon, lat FROM ont_v", 0.0))
sql("extent_all_padded", _extent("SELECT lon, lat FROM ont_v UNION ALL SELECT lon, lat FROM cto_v", 0.15))
sql("grid_clusters", """SELECT floor(lon / 0.5)::bigint AS cell_x, floor(lat / 0.5)::bigint AS cell_y, count(*) AS n_points,
  round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM ont_v WHERE lon IS NOT NULL GROUP BY 1, 2""")
sql("status_normalize", f"""SELECT seq, vendor, {_status('vendor', 'raw_status')} AS status
FROM raw_v CROSS JOIN (SELECT unnest(['huawei', 'zyxel1408A', 'zyxel2406', 'zyxel1240XA', 'zyxel']) AS vendor)""")
sql("dbm_parse", f"SELECT seq, coalesce({_dbm('rx')}, 0.0) AS rx, {_dbm('rx')} AS rx_or_null FROM raw_v")
sql("first_truthy_power", f"""SELECT seq, coalesce({_dbm("CASE WHEN seq % 2 = 0 AND rx <> '' THEN rx ELSE seq || '.5 dBm' END")}, 0.0) AS rx
FROM raw_v""")


sql("grid_pyramid", """SELECT level::int AS level, floor(lon / (0.01::double * 2 ** level))::bigint AS cell_x, floor(lat / (0.01::double * 2 ** level))::bigint AS cell_y,
  count(*) AS n_points, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat
FROM ont_v, (SELECT unnest(range(0, 12)) AS level) WHERE lon IS NOT NULL GROUP BY 1, 2, 3""")
sql("unlocated_devices", """SELECT olt_id, olt_name, sum(cnt)::bigint AS cnt, string_agg(pon_id || '=' || cnt, ',' ORDER BY pon_id) AS pons
FROM groups_v WHERE olt_id > 'olt-03' GROUP BY 1, 2 ORDER BY 1 LIMIT 10""", ports=True, more=GROUPS)
sql("geo_bbox_curve", f"SELECT id, lon, lat FROM ont_v o WHERE {IN_BOX}")
ORACLE["units_deep_page"] = """SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 500 OFFSET (SELECT count(*) * 3 // 4 FROM events)"""
sql("unit_search_trigrams", """SELECT q, id FROM ont_v, (SELECT unnest(['1-12', 'ONT-2-_', 'r#00%3', '0/1', '7', 'none such']) AS q)
WHERE vendor_ont_id ILIKE '%' || q || '%' OR serial ILIKE '%' || q || '%'""")
sql("port_bbox_guard", """SELECT 3 AS "case", id FROM port_v WHERE olt_id = 'olt-07' AND pon_id = '1-3' AND lon BETWEEN -10 AND 0 AND lat BETWEEN 36 AND 44""", ports=True)
sql("map_views", """SELECT 'all' AS layers, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north, n_points,
  round((south + north) / 2, 6) AS center_lat, round((west + east) / 2, 6) AS center_lon
FROM (SELECT w - (e - w) * 0.15::double AS west, s - (n - s) * 0.15::double AS south, e + (e - w) * 0.15::double AS east, n + (n - s) * 0.15::double AS north, n_points
  FROM (SELECT min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n, count(lon) AS n_points FROM (SELECT lon, lat FROM ont_v UNION ALL SELECT lon, lat FROM cto_v)))
UNION ALL SELECT 'none', NULL, NULL, NULL, NULL, 0, 40.4168, -3.7038""")
sql("bbox_text_round_trip", """SELECT id FROM ont_v, (SELECT min(lon) AS w, min(lat) AS s, max(lon) AS e, max(lat) AS n FROM cto_v)
WHERE lon BETWEEN w AND e AND lat BETWEEN s AND n""")
sql("history_csv_read_back", """SELECT ont_id, 'prx' AS metric, prx AS value, time AS timestamp FROM power_v
WHERE ont_id = 7 AND time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
sql("geojson_lines_read_back", f"""SELECT o.id, 'Feature' AS type, o.lon, o.lat, o.serial AS sn FROM ont_v o JOIN last_v l ON l.ont_id = o.id WHERE {IN_BOX}""")



# ---- polls -------------------------------------------------------------------------------------

STATE = """CASE event_type WHEN 'click' THEN 'is' WHEN 'error' THEN 'oos-ls' WHEN 'purchase' THEN 'Active'
  WHEN 'signup' THEN 'OOS-DG' ELSE 'weird' END"""
RUN_STATE = """CASE event_type WHEN 'click' THEN 'online' WHEN 'error' THEN 'losi' WHEN 'purchase' THEN 'offline'
  WHEN 'signup' THEN 'dyinggasp' ELSE 'Online' END"""
POLLS = f"""
rec_v AS (
  SELECT e.*, u.olt_id, u.vendor_ont_id AS unit, l.vendor, u.olt_id || '@' || strftime(ts, '%Y-%m-%d') AS poll_id,
    date_trunc('day', ts)::timestamp AS polled_at,
    CASE WHEN (day(ts) + substr(u.olt_id, 5, 2)::int) % 11 = 3 THEN 'error' ELSE 'ok' END AS outcome,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'n/a' WHEN event_id % 10 = 2 THEN ''
      ELSE (-value)::varchar || ' dBm' END AS rx
  FROM events e JOIN ont_v u ON u.id = e.user_id JOIN olt_v l ON l.id = u.olt_id),
norm_v AS (
  SELECT poll_id, olt_id, vendor, event_id AS pos, polled_at AS time, unit AS vendor_ont_id,
    CASE WHEN vendor = 'huawei' AND event_id % 4 = 0 THEN 1.5 ELSE value END::double AS ptx,
    coalesce({_dbm('rx')}, 0.0) AS prx,
    {_status('vendor', f"CASE WHEN vendor = 'huawei' THEN {RUN_STATE} ELSE ' ' || {STATE} || ' ' END")} AS status,
    'SN' || user_id AS serial, CASE WHEN vendor <> 'huawei' THEN 'M-' || event_type END AS model,
    event_type AS description,
    CASE WHEN vendor <> 'huawei' THEN ' ' || {STATE} || ' ' END AS prop_status,
    CASE WHEN vendor = 'huawei' THEN {RUN_STATE} END AS prop_run_state,
    CASE WHEN vendor <> 'huawei' AND event_id % 3 = 0 THEN (event_id % 50) || ' m' END AS prop_distance,
    CASE WHEN vendor = 'zyxel1240XA' THEN split_part(unit, '-', 2) END AS prop_filter,
    CASE WHEN vendor <> 'huawei' THEN vendor END AS prop_vendor
  FROM rec_v WHERE outcome = 'ok' AND vendor <> 'zyxel' AND (vendor = 'huawei' OR event_id % 13 <> 0)),
dedup_v AS (
  SELECT poll_id, olt_id, vendor, vendor_ont_id, time, ptx, prx, status FROM (
    SELECT *, row_number() OVER (PARTITION BY poll_id, olt_id, vendor_ont_id ORDER BY pos DESC) AS rn FROM norm_v)
  WHERE rn = 1),
log_v AS (
  SELECT h.*, coalesce(n_units, 0) AS n_units, coalesce(n_records, 0) AS n_records,
    CASE WHEN vendor = 'zyxel' THEN 'unknown_vendor' WHEN outcome <> 'ok' THEN outcome
      WHEN coalesce(n_units, 0) = 0 THEN 'empty' ELSE 'applied' END AS result
  FROM (SELECT DISTINCT poll_id, olt_id, vendor, polled_at, outcome FROM rec_v) h
  LEFT JOIN (SELECT poll_id, count(DISTINCT vendor_ont_id) AS n_units, count(*) AS n_records FROM norm_v GROUP BY 1) n
    USING (poll_id))
"""


def poll_sql(name: str, body: str, more: str = "") -> None:
    ORACLE[name] = f"WITH {VIEWS}, {POLLS} {',' + more if more else ''} {body}"


poll_sql("poll_normalize", "SELECT * FROM norm_v")
poll_sql("poll_dedup_last", "SELECT poll_id, olt_id, vendor_ont_id, time, ptx, prx, status FROM dedup_v")
poll_sql("poll_log_results", """SELECT poll_id, olt_id, vendor, polled_at, n_units, n_records, result,
  result = 'applied' AND n_units >= 3 AS evidence FROM log_v""")
poll_sql("key_resolution", """SELECT d.time, o.id AS ont_id, d.ptx, d.prx, d.status
FROM dedup_v d JOIN ont_v o ON o.olt_id = d.olt_id AND o.vendor_ont_id = d.vendor_ont_id""")
poll_sql("presence_islands", """
SELECT olt_id, vendor_ont_id, min(no) AS first_poll, max(no) AS last_poll, count(*) AS n_polls FROM (
  SELECT *, sum(jump) OVER (PARTITION BY olt_id, vendor_ont_id ORDER BY no) AS run FROM (
    SELECT *, CASE WHEN no - lag(no) OVER (PARTITION BY olt_id, vendor_ont_id ORDER BY no) = 1 THEN 0 ELSE 1 END AS jump
    FROM dedup_v JOIN (SELECT poll_id, row_number() OVER (PARTITION BY olt_id ORDER BY polled_at, poll_id) AS no
      FROM log_v WHERE result = 'applied') USING (poll_id)))
GROUP BY olt_id, vendor_ont_id, run""")


def _scope(vendor: str, unit: str, whole: bool) -> str:
    return "'*'" if whole else f"""CASE WHEN {vendor} = 'huawei' THEN split_part({unit}, '/', 2) || '/' || split_part({unit}, '/', 3)
      WHEN {vendor} = 'zyxel1240XA' THEN split_part({unit}, '-', 2) ELSE '*' END"""


def _applied(whole: bool, delete: bool = True, failed: str = "false") -> str:
    return f"""
seen AS (SELECT DISTINCT olt_id, vendor_ont_id AS u, {_scope('vendor', 'vendor_ont_id', whole)} AS scope, poll_id, time FROM norm_v),
ev AS (SELECT DISTINCT s.olt_id, scope, poll_id, time FROM seen s JOIN olt_v l ON l.id = s.olt_id WHERE NOT ({failed})),
stored AS (
  SELECT o.*, o.vendor_ont_id AS u, {_scope('l.vendor', 'o.vendor_ont_id', whole)} AS scope
  FROM ont_v o JOIN olt_v l ON l.id = o.olt_id WHERE o.olt_id IN (SELECT olt_id FROM seen)),
allu AS (SELECT olt_id, u, scope FROM stored UNION SELECT olt_id, u, scope FROM seen),
brk AS (
  SELECT a.olt_id, a.u, max(e.time) AS brk FROM allu a JOIN ev e USING (olt_id, scope)
  LEFT JOIN seen s ON s.olt_id = a.olt_id AND s.u = a.u AND s.poll_id = e.poll_id
  WHERE s.u IS NULL AND {'true' if delete else 'false'} GROUP BY 1, 2),
live AS (
  SELECT n.*, brk, row_number() OVER (PARTITION BY n.olt_id, n.vendor_ont_id ORDER BY time DESC, pos DESC) AS from_end,
    row_number() OVER (PARTITION BY n.olt_id, n.vendor_ont_id ORDER BY time, pos DESC) AS from_start
  FROM norm_v n LEFT JOIN brk b ON b.olt_id = n.olt_id AND b.u = n.vendor_ont_id WHERE brk IS NULL OR time > brk),
after AS (
  SELECT o.id, o.olt_id, o.vendor_ont_id, o.cto_uuid, o.lon, o.lat, o.serial, o.model, o.description,
    CASE WHEN l.poll_id IS NULL THEN o.status ELSE l.status END AS status,
    CASE WHEN l.poll_id IS NULL THEN 'IS' ELSE l.prop_status END AS prop_status, l.prop_run_state
  FROM ont_v o LEFT JOIN live l ON l.olt_id = o.olt_id AND l.vendor_ont_id = o.vendor_ont_id AND from_end = 1
  WHERE NOT EXISTS (SELECT 1 FROM brk b WHERE b.olt_id = o.olt_id AND b.u = o.vendor_ont_id)
  UNION ALL
  SELECT NULL, l.olt_id, l.vendor_ont_id, NULL, NULL, NULL, f.serial, f.model, f.description, l.status, l.prop_status, l.prop_run_state
  FROM live l JOIN live f ON f.olt_id = l.olt_id AND f.vendor_ont_id = l.vendor_ont_id AND f.from_start = 1
  WHERE l.from_end = 1 AND (l.brk IS NOT NULL OR NOT EXISTS (
    SELECT 1 FROM ont_v o WHERE o.olt_id = l.olt_id AND o.vendor_ont_id = l.vendor_ont_id)))"""


poll_sql("polls_applied_units", "SELECT * FROM after", _applied(True))
poll_sql("polls_applied_units_by_scope", "SELECT * FROM after", _applied(False))
poll_sql("polls_applied_units_kept", "SELECT * FROM after", _applied(True, delete=False))
poll_sql("polls_applied_readings", """SELECT d.time, d.ptx, d.prx, d.status, d.olt_id, d.vendor_ont_id FROM dedup_v d
LEFT JOIN brk b ON b.olt_id = d.olt_id AND b.u = d.vendor_ont_id WHERE brk IS NULL OR d.time > brk""", _applied(True))
ORACLE["polls_applied_repeated_ids"] = ORACLE["polls_applied_units"]
poll_sql("polls_removed_units", """SELECT s.id, s.olt_id, s.vendor_ont_id FROM stored s
JOIN brk b ON b.olt_id = s.olt_id AND b.u = s.u""", _applied(True))

ORACLE["polls_applied_counts"] = f"""SELECT 'removed_units' AS what, count(*) AS n FROM ({ORACLE['polls_removed_units']})
UNION ALL SELECT 'inserted_readings', count(*) FROM ({ORACLE['polls_applied_readings']})"""
SLOT_FAILED = "l.vendor = 'zyxel1240XA' AND scope = (day(time) % 3)::varchar"
poll_sql("polls_applied_failed_scopes", "SELECT * FROM after", _applied(False, failed=SLOT_FAILED))
poll_sql("polls_log_scopes", """SELECT poll_id, outcome, '' AS scopes_ok,
  CASE WHEN vendor = 'zyxel1240XA' THEN (day(polled_at) % 3)::varchar ELSE '' END AS scopes_failed FROM log_v""")
ORACLE["polls_applied_other_vendor"] = (
    ORACLE["polls_applied_units"].replace(" AND vendor <> 'zyxel'", "").replace("WHEN vendor = 'zyxel' THEN 'unknown_vendor'", "")
    .replace("MAP {", "MAP {'zyxel|IS': 1, 'zyxel|OOS-LS': 2, "))
poll_sql("polls_applied_pon_ids", f"""SELECT a.olt_id, a.vendor_ont_id, {_pon_stored('l.vendor', 'a.vendor_ont_id')} AS pon_id
FROM after a JOIN olt_v l ON l.id = a.olt_id""", _applied(True))

# ---- upkeep ------------------------------------------------------------------------------------

NEWEST = """
newest AS (SELECT olt_id, max(poll_id) AS poll_id FROM norm_v GROUP BY 1),
gone AS (
  SELECT id, olt_id, vendor_ont_id FROM ont_v o WHERE olt_id IN (SELECT olt_id FROM newest)
  AND NOT EXISTS (SELECT 1 FROM norm_v n JOIN newest USING (olt_id, poll_id)
    WHERE n.olt_id = o.olt_id AND n.vendor_ont_id = o.vendor_ont_id))"""
poll_sql("delete_missing_anti", "SELECT * FROM gone", NEWEST)
poll_sql("delete_missing_kept", "SELECT id, olt_id, vendor_ont_id FROM ont_v WHERE id NOT IN (SELECT id FROM gone)", NEWEST)
poll_sql("cascade_readings", "SELECT * FROM power_v WHERE ont_id NOT IN (SELECT id FROM gone)", NEWEST)
sql("upsert_units", """SELECT olt_id, vendor_ont_id, cto_uuid, lon, lat, serial, model, description,
  CASE WHEN EXISTS (SELECT 1 FROM ch WHERE ch.olt_id = o.olt_id AND ch.unit = o.vendor_ont_id) THEN 9 ELSE status END AS status,
  CASE WHEN EXISTS (SELECT 1 FROM ch WHERE ch.olt_id = o.olt_id AND ch.unit = o.vendor_ont_id) THEN 'new' ELSE 'IS' END AS props
FROM ont_v o
UNION ALL SELECT olt_id, unit, NULL, NULL, NULL, nombre, NULL, nombre, 9, 'new' FROM ch
WHERE NOT EXISTS (SELECT 1 FROM ont_v o WHERE o.olt_id = ch.olt_id AND o.vendor_ont_id = ch.unit)""", more="""
ch AS (SELECT CASE WHEN s.tipo = 11 THEN o.olt_id ELSE 'olt-new' END AS olt_id, coalesce(o.vendor_ont_id, s.nombre) AS unit, s.nombre
  FROM equipment_v s LEFT JOIN ont_v o ON o.id = split_part(s.uuid, '-', 2)::bigint
  WHERE s.tipo <> 11 OR o.olt_id IS NOT NULL)""")
sql("upsert_units_repeated", """SELECT olt_id, vendor_ont_id, cto_uuid, lon, lat, o.serial, model, description, coalesce(n.status, o.status) AS status
FROM ont_v o LEFT JOIN last_ch n ON n.k = o.id
UNION ALL SELECT 'olt-new', 'new-' || k, NULL, NULL, NULL, serial, NULL, NULL, status FROM last_ch WHERE k NOT IN (SELECT id FROM ont_v)""", more="""
li AS (SELECT l_partkey % 2000 AS k, l_returnflag || l_orderkey AS serial, (l_suppkey % 5)::int AS status, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
last_ch AS (SELECT DISTINCT k, first_value(serial) OVER (PARTITION BY k ORDER BY seq) AS serial, first_value(status) OVER (PARTITION BY k ORDER BY seq DESC) AS status FROM li)""")
OLT_CHANGES = """
olt_ch AS (
  SELECT 'olt-' || lpad((r_regionkey * 6)::varchar, 2, '0') AS id, 'zyxel' AS vendor, r_name AS host, 161 AS port,
    CASE WHEN r_regionkey > 1 THEN 60 ELSE 300 END AS poll_interval, NULL::varchar AS prompt, r_name AS description FROM region
  UNION ALL SELECT 'olt-x' || r_regionkey, 'huawei', r_name, 23, 300, '#', '' FROM region)"""
sql("upsert_olts_keep_vendor", """SELECT coalesce(o.id, n.id) AS id, coalesce(o.vendor, n.vendor) AS vendor,
  CASE WHEN n.id IS NULL THEN o.host ELSE n.host END AS host, CASE WHEN n.id IS NULL THEN o.port ELSE n.port END AS port,
  CASE WHEN n.id IS NULL THEN o.poll_interval ELSE n.poll_interval END AS poll_interval,
  CASE WHEN n.id IS NULL THEN o.prompt ELSE n.prompt END AS prompt,
  CASE WHEN n.id IS NULL THEN o.description ELSE n.description END AS description
FROM olt_v o FULL OUTER JOIN olt_ch n ON n.id = o.id""", more=OLT_CHANGES)
sql("seed_olts", "SELECT * FROM olt_v UNION ALL SELECT * FROM olt_ch WHERE id NOT IN (SELECT id FROM olt_v)", more=OLT_CHANGES)
sql("patch_units", """SELECT o.id,
  CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN p_brand END ELSE o.cto_uuid END AS cto_uuid,
  CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END ELSE o.lon END AS lon,
  CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 5 <> 0 THEN p_size::double END ELSE o.lat END AS lat
FROM ont_v o LEFT JOIN part ON p_partkey = o.id""")
_P = "l_orderkey"
sql("patch_units_repeated", f"""SELECT o.id, CASE WHEN c.k IS NULL THEN o.cto_uuid ELSE c.cto END AS cto_uuid,
  CASE WHEN g.k IS NULL THEN o.lon ELSE g.lon END AS lon, CASE WHEN g.k IS NULL THEN o.lat ELSE g.lat END AS lat FROM ont_v o
LEFT JOIN (SELECT l_partkey AS k, CASE WHEN {_P} % 4 = 0 THEN 'c' || {_P} END AS cto, row_number() OVER (PARTITION BY l_partkey ORDER BY {_P} * 10 + l_linenumber DESC) AS rn
  FROM lineitem WHERE {_P} % 2 = 0) c ON c.k = o.id AND c.rn = 1
LEFT JOIN (SELECT l_partkey AS k, CASE WHEN {_P} % 5 <> 0 THEN l_quantity END AS lon, CASE WHEN {_P} % 5 <> 0 THEN l_linenumber::double END AS lat,
  row_number() OVER (PARTITION BY l_partkey ORDER BY {_P} * 10 + l_linenumber DESC) AS rn
  FROM lineitem WHERE {_P} % 3 <> 0 AND {_P} % 7 <> 0) g ON g.k = o.id AND g.rn = 1""")
sql("patches_refused", """SELECT p_partkey AS id FROM part WHERE NOT (p_partkey % 5 <> 0 AND p_partkey % 2 = 0)
  AND NOT (p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AND p_partkey % 11 <> 0 AND p_partkey % 4 = 0)""")
sql("devices_removed_units", "SELECT id, olt_id FROM ont_v WHERE olt_id >= 'olt-05'")
sql("devices_removed_readings", "SELECT * FROM power_v WHERE ont_id NOT IN (SELECT id FROM ont_v WHERE olt_id < 'olt-05')")
STALE = "CASE o.id % 3 WHEN 0 THEN '' WHEN 1 THEN 'old' END"
sql("backfill_pon_id", f"""SELECT o.id, CASE WHEN o.id % 3 = 1 THEN 'old' ELSE {_pon_stored('l.vendor', 'o.vendor_ont_id')} END AS pon_id
FROM ont_v o JOIN olt_v l ON l.id = o.olt_id""")
sql("derive_pon_id", f"""SELECT o.id, {_pon_stored('l.vendor', 'o.vendor_ont_id')} AS pon_id
FROM ont_v o JOIN olt_v l ON l.id = o.olt_id""")
ORACLE["derive_pon_id_sql"] = ORACLE["derive_pon_id"]
sql("recalc_pon_id", f"""SELECT o.id, CASE WHEN l.vendor = 'zyxel' THEN {_pon_stored("'zyxel2406'", 'o.vendor_ont_id')} ELSE {STALE} END AS pon_id
FROM ont_v o JOIN olt_v l ON l.id = o.olt_id""")

# ---- files -------------------------------------------------------------------------------------

sql("csv_export_rows", """SELECT id, olt_id, vendor_ont_id, cto_uuid, lon AS x, lat AS y, serial, model, description, status
FROM ont_v ORDER BY olt_id, id""")
sql("csv_read_back", r"""SELECT id::varchar AS id, olt_id, vendor_ont_id, cto_uuid, lon AS x, lat AS y, serial,
  description || chr(10) || '"' || serial || '"' AS description, status::varchar AS status FROM ont_v""")
sql("tables_read_back", """SELECT id, olt_id, vendor_ont_id, cto_uuid, lon, lat, serial, model, description, status, NULL::varchar AS pon_id FROM ont_v""")
ORACLE["metric_series_by_day"] = ORACLE["metric_series"]
for _name in ("cto_geojson_read", "cto_features_read"):
    sql(_name, "SELECT uuid, nombre, lon, lat FROM cto_v")
sql("cto_rows_read", "SELECT nombre, uuid FROM cto_v")
CONFIG = """
cfg_v AS (
  SELECT n_nationkey AS k, 'cfg-' || n_nationkey AS id, ['huawei', 'zyxel1240XA', 'zyxel2406'][n_nationkey % 3 + 1] AS vendor,
    n_name AS host, (20 + n_nationkey)::int AS port, CASE WHEN n_nationkey % 2 = 0 THEN 60 + n_nationkey ELSE 300 END::int AS poll_interval,
    r_name AS prompt FROM nation JOIN region ON r_regionkey = n_regionkey)"""
sql("config_synced_devices", """SELECT id, vendor, host, port, poll_interval, prompt FROM olt_v
UNION ALL SELECT id, vendor, host, port, poll_interval, prompt FROM cfg_v""", more=CONFIG)
sql("config_scopes", """SELECT id AS olt_id, vendor, unnest(CASE WHEN vendor = 'huawei' THEN [k || '/1', '2/3']
  WHEN vendor = 'zyxel1240XA' THEN CASE WHEN k > 5 THEN [k::varchar, '9'] ELSE ['1'] END ELSE ['*'] END) AS scope FROM cfg_v""", more=CONFIG)
CELL_NAMES = ["id", "olt_id", "vendor_ont_id", "cto_uuid", "x", "y", "serial", "model", "description", "status"]
FLOATS = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"


def _value(c: str) -> str:
    return f"CASE WHEN lower({c}) <> 'null' AND {c} <> '' THEN {c} END"


IMPORT = f"""
cells_v AS (
  SELECT k + 2 AS line,
    CASE WHEN k % 12 = 10 THEN 'x1' WHEN k % 12 = 11 THEN ' ' || (c + 100000000) WHEN k % 12 < 4 THEN c::varchar ELSE '' END AS id,
    CASE WHEN k % 12 < 3 THEN NULL WHEN k % 12 = 8 THEN '' WHEN k % 12 = 9 THEN 'olt-99' ELSE coalesce(u.olt_id, 'olt-00') END AS olt_id,
    CASE WHEN k % 12 < 3 THEN NULL WHEN k % 12 = 7 THEN 'null' WHEN k % 12 IN (5, 6) THEN 'new-' || c
      WHEN k % 36 = 3 THEN 'moved-' || k ELSE u.vendor_ont_id END AS vendor_ont_id,
    CASE k % 5 WHEN 0 THEN 'null' WHEN 1 THEN ' cto-' || (k % 120) || ' ' END AS cto_uuid,
    CASE WHEN k % 7 = 0 THEN (k % 90) || '.25' WHEN k % 7 = 1 THEN 'NULL' WHEN k % 35 = 2 THEN '7' END AS x,
    CASE WHEN k % 7 = 0 THEN (k % 45) || '.5' WHEN k % 7 = 1 THEN ' null' WHEN k % 35 = 3 THEN 'abc' END AS y,
    CASE WHEN k % 3 = 1 THEN 'S' || k ELSE '' END AS serial, CASE WHEN k % 4 = 1 THEN pr END AS model,
    CASE k % 11 WHEN 2 THEN 'null' WHEN 3 THEN 'd' || k ELSE '  ' END AS description,
    CASE WHEN k % 9 = 4 THEN (k % 4)::varchar WHEN k % 45 = 5 THEN '7.0' END AS status
  FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pr FROM orders) LEFT JOIN ont_v u ON u.id = c),
clean_v AS (SELECT line, {', '.join(f"coalesce(trim({c}), '') AS {c}" for c in CELL_NAMES)} FROM cells_v),
checked_v AS (
  SELECT *, id <> '' AS by_id, CASE WHEN regexp_matches(id, '^[+-]?[0-9]+$') THEN id::bigint END AS nid,
    (olt_id <> '' OR vendor_ont_id <> '') AND id <> '' AS sets_key,
    x <> '' OR {' OR '.join(f"{c} <> ''" for c in ('cto_uuid', 'serial', 'model', 'description', 'status'))} AS has_values,
    CASE WHEN id <> '' AND NOT regexp_matches(id, '^[+-]?[0-9]+$') THEN 'bad_id'
      WHEN x <> '' AND lower(x) <> 'null' AND NOT regexp_matches(x, {FLOATS}) THEN 'bad_x'
      WHEN y <> '' AND lower(y) <> 'null' AND NOT regexp_matches(y, {FLOATS}) THEN 'bad_y'
      WHEN status <> '' AND lower(status) <> 'null' AND NOT regexp_matches(status, '^[+-]?[0-9]+$') THEN 'bad_status'
      WHEN NOT ((x = '' AND y = '') OR (lower(x) = 'null' AND lower(y) = 'null')
        OR (x <> '' AND y <> '' AND lower(x) <> 'null' AND lower(y) <> 'null')) THEN 'bad_position'
      WHEN id = '' AND (olt_id = '' OR lower(olt_id) = 'null') THEN 'no_olt_id'
      WHEN id = '' AND (vendor_ont_id = '' OR lower(vendor_ont_id) = 'null') THEN 'no_vendor_ont_id' END AS code0
  FROM clean_v),
target_v AS (
  SELECT c.*, o.id AS hit, o.olt_id AS old_olt, o.vendor_ont_id AS old_unit,
    CASE WHEN c.olt_id <> '' THEN {_value('c.olt_id')} ELSE o.olt_id END AS olt_key,
    CASE WHEN c.vendor_ont_id <> '' THEN {_value('c.vendor_ont_id')} ELSE o.vendor_ont_id END AS unit_key
  FROM checked_v c LEFT JOIN ont_v o ON o.id = c.nid),
judged_v AS (
  SELECT t.*, w.id AS owner, CASE WHEN code0 IS NOT NULL THEN code0
    WHEN by_id AND hit IS NULL AND (has_values OR sets_key) THEN 'unknown_id'
    WHEN by_id AND (lower(t.olt_id) = 'null' OR lower(t.vendor_ont_id) = 'null') THEN 'null_key'
    WHEN (sets_key OR NOT by_id) AND olt_key NOT IN (SELECT id FROM olt_v) THEN 'unknown_olt' END AS code1
  FROM target_v t LEFT JOIN ont_v w ON w.olt_id = t.olt_key AND w.vendor_ont_id = t.unit_key AND code0 IS NULL),
keyed_v AS (
  -- Lines that name a key, by the stored unit whose key or id they touch, in file order.
  SELECT line, by_id, CASE WHEN by_id THEN nid ELSE owner END AS u, olt_key, unit_key,
    by_id AND (olt_key <> old_olt OR unit_key <> old_unit) AS away,
    row_number() OVER (PARTITION BY CASE WHEN by_id THEN nid ELSE owner END ORDER BY line) AS n
  FROM judged_v WHERE code1 IS NULL AND (CASE WHEN by_id THEN sets_key ELSE owner IS NOT NULL END)),
walk_v AS (
  -- at_home: the unit has its stored key; taken: a line has put a new unit under that key. Other targets are used once.
  SELECT o.id AS u, 0::bigint AS n, NULL::bigint AS line, true AS at_home, false AS taken, NULL::varchar AS did,
    o.olt_id AS cur_olt, o.vendor_ont_id AS cur_unit FROM ont_v o WHERE id IN (SELECT u FROM keyed_v)
  UNION ALL
  SELECT w.u, k.n, k.line,
    CASE WHEN NOT k.by_id THEN w.at_home WHEN k.away THEN false ELSE w.at_home OR NOT w.taken END,
    w.taken OR (NOT k.by_id AND NOT w.at_home),
    CASE WHEN k.by_id THEN CASE WHEN k.away OR w.at_home OR NOT w.taken THEN 'moved' ELSE 'refused' END
      WHEN w.at_home THEN 'unit' WHEN w.taken THEN 'new' ELSE 'insert' END,
    CASE WHEN k.by_id AND (k.away OR w.at_home OR NOT w.taken) THEN k.olt_key ELSE w.cur_olt END,
    CASE WHEN k.by_id AND (k.away OR w.at_home OR NOT w.taken) THEN k.unit_key ELSE w.cur_unit END
  FROM walk_v w JOIN keyed_v k ON k.u = w.u AND k.n = w.n + 1),
settled_v AS (SELECT j.*, w.did, coalesce(code1, CASE WHEN did = 'refused' THEN 'duplicate_key' END) AS code
  FROM judged_v j LEFT JOIN walk_v w ON w.line = j.line),
first_v AS (SELECT olt_key, unit_key, min(line) AS first_line FROM settled_v
  WHERE code IS NULL AND NOT by_id AND owner IS NULL GROUP BY 1, 2),
home_v AS (SELECT u, arg_max({{'o': cur_olt, 'u': cur_unit}}, n) AS moved FROM walk_v GROUP BY 1),
done_v AS (
  SELECT s.*, CASE WHEN code IS NOT NULL THEN 'error'
    WHEN by_id THEN CASE WHEN has_values OR sets_key THEN 'updated' ELSE 'skipped' END
    WHEN did = 'insert' OR (owner IS NULL AND line = first_line) THEN 'inserted'
    WHEN has_values THEN 'updated' ELSE 'skipped' END AS action,
    CASE WHEN by_id THEN nid WHEN did IS NULL OR did = 'unit' THEN owner END AS unit_id
  FROM settled_v s LEFT JOIN first_v USING (olt_key, unit_key))
"""
FOLDS = ", ".join(
    f"arg_max({{'v': {_value(c)}}}, line) FILTER (WHERE {c} <> '') AS {c}"
    for c in ("cto_uuid", "x", "y", "serial", "model", "description", "status")
)
sql("csv_import_classify", "SELECT line, action, code FROM done_v", more=IMPORT)
sql("csv_import_counts", """SELECT count(*) AS processed, count(*) FILTER (WHERE action = 'inserted') AS inserted,
  count(*) FILTER (WHERE action = 'updated') AS updated, count(*) FILTER (WHERE action = 'skipped') AS skipped,
  count(*) FILTER (WHERE action = 'error') AS errors, count(*) FILTER (WHERE action = 'error') = 0 AS ok FROM done_v""", more=IMPORT)
sql("csv_import_errors", """SELECT line, CASE code WHEN 'bad_id' THEN 'invalid literal for int() with base 10: ''' || id || ''''
  WHEN 'bad_x' THEN 'valor float inválido: ''' || x || '''' WHEN 'bad_y' THEN 'valor float inválido: ''' || y || ''''
  WHEN 'bad_status' THEN 'valor entero inválido: ''' || status || ''''
  WHEN 'bad_position' THEN 'x/y deben venir ambos vacíos, ambos ''null'', o ambos numéricos'
  WHEN 'no_olt_id' THEN 'olt_id es obligatorio cuando no hay id'
  WHEN 'no_vendor_ont_id' THEN 'vendor_ont_id es obligatorio cuando no hay id'
  WHEN 'unknown_id' THEN 'ONT id=' || nid || ' no existe' ELSE code END AS error
FROM done_v WHERE action = 'error'""", more=IMPORT)


def _folded(c: str, f: str, kind: str = "varchar", old: str | None = None) -> str:
    keep = f"o.{old or c}"
    return f"CASE WHEN f.{f} IS NULL THEN {keep} ELSE f.{f}.v::{kind} END AS {c}"


sql("csv_import_result", f"""
SELECT o.id, coalesce(h.moved.o, o.olt_id) AS olt_id, coalesce(h.moved.u, o.vendor_ont_id) AS vendor_ont_id,
  {_folded('cto_uuid', 'cto_uuid')}, {_folded('lon', 'x', 'double')}, {_folded('lat', 'y', 'double')},
  {_folded('serial', 'serial')}, {_folded('model', 'model')}, {_folded('description', 'description')}, {_folded('status', 'status', 'int')}
FROM ont_v o LEFT JOIN home_v h ON h.u = o.id LEFT JOIN (SELECT unit_id, {FOLDS}
  FROM done_v WHERE action <> 'error' AND unit_id IS NOT NULL GROUP BY 1) f ON f.unit_id = o.id
UNION ALL
SELECT NULL, olt_key, unit_key, cto_uuid.v, x.v::double, y.v::double, serial.v, model.v, description.v, status.v::int
FROM (SELECT olt_key, unit_key, {FOLDS} FROM done_v WHERE action <> 'error' AND NOT by_id AND unit_id IS NULL GROUP BY 1, 2)""", more=IMPORT)
ORACLE["csv_import_files"] = ORACLE["csv_import_result"]
_ERRORS = ORACLE["csv_import_errors"]
_ERRORS = _ERRORS[:_ERRORS.rindex("SELECT line, CASE code")], _ERRORS[_ERRORS.rindex("SELECT line, CASE code"):]
ORACLE["csv_import_files_errors"] = f"""{_ERRORS[0]} SELECT file, record, error FROM ({_ERRORS[1]}) JOIN (
  SELECT line, (line // third)::int AS file, row_number() OVER (PARTITION BY line // third ORDER BY line) + 1 AS record
  FROM cells_v, (SELECT max(line) // 3 + 1 AS third FROM cells_v)) USING (line)"""
# The even chain waits for a key that is taken; the odd one moves up by one.
sql("csv_import_chain", """SELECT o.id, CASE WHEN o.id % 2 = 0 THEN o.olt_id ELSE coalesce(b.olt_id, 'olt-00') END AS olt_id,
  CASE WHEN o.id % 2 = 0 THEN o.vendor_ont_id ELSE coalesce(b.vendor_ont_id, 'renumbered') END AS vendor_ont_id
FROM ont_v o LEFT JOIN ont_v b ON b.id = o.id - 2""")
_RESULT = ORACLE["csv_import_result"][ORACLE["csv_import_result"].rindex("SELECT o.id, coalesce(h.moved"):]
ORACLE["csv_import_pon_ids"] = ORACLE["csv_import_result"].replace(
    _RESULT, f"SELECT r.olt_id, r.vendor_ont_id, {_pon_stored('l.vendor', 'r.vendor_ont_id')} AS pon_id FROM ({_RESULT}) r JOIN olt_v l ON l.id = r.olt_id")
sql("config_overlay", """SELECT 'olt-' || n_nationkey AS id, '300' AS poll_interval,
  CASE WHEN n_nationkey % 2 = 0 THEN CASE WHEN n_nationkey % 4 <> 0 THEN n_name END ELSE r_name END AS prompt,
  CASE WHEN n_nationkey % 2 = 1 THEN n_name END AS description, false AS has_password
FROM nation JOIN region ON r_regionkey = n_regionkey""")
sql("props_extract", "SELECT id, vendor_ont_id AS aid, 'IS' AS status, distance FROM ont_v")
ORACLE["event_props_extract"] = "SELECT event_id, json_extract_string(props, '$.k')::bigint AS k FROM events"

# ---- quality -----------------------------------------------------------------------------------

ORACLE["dq_duplicates"] = """SELECT o_orderdate::date AS day, o_custkey AS ont_id, count(*) AS n_rows FROM orders
GROUP BY 1, 2 HAVING count(*) > 1"""
sql("dq_duplicate_readings", "SELECT time::date AS time, ont_id, count(*) AS n_rows FROM power_v GROUP BY 1, 2 HAVING count(*) > 1")
sql("dq_orphan_units", "SELECT id, olt_id FROM ont_v WHERE olt_id NOT IN (SELECT id FROM olt_v WHERE id < 'olt-20')")
sql("dq_orphan_readings", "SELECT time, ont_id FROM power_v p WHERE NOT EXISTS (SELECT 1 FROM ont_v o WHERE o.id = p.ont_id AND o.id % 3 <> 0)")
sql("dq_orphans", "SELECT id, cto_uuid FROM ont_v WHERE cto_uuid IS NOT NULL AND cto_uuid NOT IN (SELECT uuid FROM cto_v)")
sql("dq_domain", """SELECT * FROM (SELECT * FROM olt_ch UNION ALL SELECT * FROM olt_v)
WHERE vendor NOT IN ('huawei', 'zyxel', 'zyxel1408A', 'zyxel2406', 'zyxel1240XA')""", more=OLT_CHANGES)
ORACLE["dq_domain"] = ORACLE["dq_domain"].replace("SELECT * FROM olt_ch UNION", "SELECT * REPLACE (CASE WHEN port = 161 THEN 'acme' ELSE vendor END AS vendor) FROM olt_ch UNION")
sql("dq_nulls", """SELECT * FROM (SELECT id, concat_ws(',', CASE WHEN cto_uuid IS NULL THEN 'cto_uuid' END,
  CASE WHEN lon IS NULL THEN 'lon' END) AS null_columns FROM ont_v) WHERE null_columns <> ''""")

# ---- streams -----------------------------------------------------------------------------------

ORACLE["stream_ingest_units"] = ORACLE["polls_applied_units"]
ORACLE["stream_ingest_readings"] = ORACLE["polls_applied_readings"]
ORACLE["stream_ingest_small_batches"] = ORACLE["polls_applied_units"]
# A poll without its first slice fails, like one with an error.
ORACLE["stream_ingest_repeated_ids"] = ORACLE["polls_applied_units"].replace(
    "= 3 THEN 'error'", "= 3 THEN 'error' WHEN (day(ts) + 2 * substr(u.olt_id, 5, 2)::int) % 13 = 5 THEN 'incomplete'")
poll_sql("stream_ingest_late", "SELECT time, ptx, prx, status, olt_id, vendor_ont_id FROM dedup_v")
ORACLE["stream_ingest_twice"] = ORACLE["stream_compacted_readings"] = ORACLE["polls_applied_readings"]
# A poll that was read is refused when it comes again; one that failed fails again.
poll_sql("stream_ingest_refused", """SELECT CASE WHEN again AND result IN ('applied', 'empty') THEN 'duplicate' ELSE result END AS result, count(*) AS n
FROM log_v, (SELECT unnest([false, true]) AS again) GROUP BY 1""")
poll_sql("stream_kept_latest", """SELECT time, ptx, prx, status, olt_id, vendor_ont_id FROM (
  SELECT d.*, row_number() OVER (PARTITION BY d.olt_id, d.vendor_ont_id ORDER BY d.time DESC) AS rn FROM dedup_v d
  LEFT JOIN brk b ON b.olt_id = d.olt_id AND b.u = d.vendor_ont_id WHERE brk IS NULL OR d.time > brk) WHERE rn = 1""", _applied(True))
ORACLE["stream_current_state"] = ORACLE["latest_reading"]
sql("stream_unique_readings", "SELECT * FROM power_v")
