"""Unit edits from CSV lines, applied as a set.

``line`` orders the lines, over all files; ``file`` and ``record``, where given, say where a line stands and go with it.

A line with an id edits that unit. A line without one inserts or edits the unit of its key. Lines
count in file order: a later cell wins, and a key that an earlier line inserted exists for the
later ones. A line that fails is reported and changes nothing.

A line can give a unit another key. From then on lines with the new key mean that unit, and the old key is free for a new one; a
key that another unit has at that line is refused as ``duplicate_key``. Which moves hold depends on the lines before
them, so they are settled in rounds over the moved keys only, until nothing changes. Most moves wait for one other: they hold if the unit
that has the key has left it by then. Along such chains the verdict of the first line is carried by pointer doubling, so a chain of n
lines takes about log2(n) joins; lines that depend on more get right in the rounds, at least one each, in file order. An id that this same file inserts cannot be referred to. A line the tables would refuse (unknown
device, NULL key, number out of range) is an error of that line only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ponloom.functions.cells import cell, clean_cell, is_int_sql, strip_sql, to_int_sql
from ponloom.operators.lineage import stored as stored_rows
from ponloom.operators.numbering import with_new_ids
from ponloom.operators.upkeep import with_pon_id
from ponloom.schemas import UNIT_CSV

KEY = ["olt_id", "vendor_ont_id"]
#: The owner of a key that a line of the file inserted, and line numbers before and after all.
FRESH, BEFORE_ALL, AFTER_ALL = -1, -(1 << 62), 1 << 62
VALUES = ["cto_uuid", "serial", "model", "description", "status"]
_KINDS = {"status": "int", "x": "float", "y": "float"}

# Texts of the errors a line can have.
BAD_ID = "invalid literal for int() with base 10: "
BAD_INT = "valor entero inválido: "
BAD_FLOAT = "valor float inválido: "
BAD_POSITION = "x/y deben venir ambos vacíos, ambos \\'null\\', o ambos numéricos"
NO_OLT_ID = "olt_id es obligatorio cuando no hay id"
NO_UNIT_ID = "vendor_ont_id es obligatorio cuando no hay id"
UNKNOWN_ID = ("ONT id=", " no existe")


class Imported(NamedTuple):
    units: DataFrame
    lines: DataFrame
    errors: DataFrame
    report: DataFrame


def _where(lines: DataFrame) -> list[str]:
    """Columns that say where a line stands."""
    return ["line", *[c for c in ("file", "record") if c in lines.columns]]


def parse_lines(lines: DataFrame) -> DataFrame:
    """Cells read, and per line the first failing check as ``code``.

    ``by_id``: the line has an id; ``sets_key`` and ``has_values``: it sets key or other cells.
    """
    where = _where(lines)
    clean = lines.select(
        *where, F.struct(*UNIT_CSV).alias("row"), *[clean_cell(c).alias(c) for c in UNIT_CSV]
    )
    cells = clean.select(
        *where, "row", F.col("id").alias("id_text"), F.expr(to_int_sql("id")).alias("id"),
        F.col("status").alias("status_text"),
        *[cell(c, _KINDS.get(c, "text")).alias(c) for c in UNIT_CSV if c != "id"],
    )
    value_cells = " OR ".join(f"{c}.is_set" for c in ["x", *VALUES])
    return cells.selectExpr(
        *where, "row", "id", "id_text <> '' AS by_id", *KEY, *VALUES,
        "named_struct('is_set', x.is_set, 'value', named_struct('lon', x.value, 'lat', y.value)) AS point",
        "id_text <> '' AND (olt_id.is_set OR vendor_ont_id.is_set) AS sets_key",
        f"{value_cells} AS has_values",
        f"""CASE
          WHEN id_text <> '' AND NOT {is_int_sql('id_text')} THEN 'bad_id'
          WHEN x.bad THEN 'bad_x' WHEN y.bad THEN 'bad_y' WHEN status.bad THEN 'bad_status'
          WHEN x.is_set <> y.is_set OR (x.value IS NULL) <> (y.value IS NULL) THEN 'bad_position'
          WHEN id_text = '' AND olt_id.value IS NULL THEN 'no_olt_id'
          WHEN id_text = '' AND vendor_ont_id.value IS NULL THEN 'no_vendor_ont_id'
          WHEN id_text <> '' AND id IS NULL THEN 'unknown_id'
          WHEN id_text <> '' AND ((olt_id.is_set AND olt_id.value IS NULL)
            OR (vendor_ont_id.is_set AND vendor_ont_id.value IS NULL)) THEN 'null_key'
          WHEN status.is_set AND status.value IS NULL AND lower(status_text) <> 'null' THEN 'out_of_range'
        END AS code""",
    )


def _error_text() -> str:
    raw = {c: strip_sql(f"row.{c}") for c in ("id", "x", "y", "status")}
    quote = "'\\''"
    quoted = {c: f"{quote} || {text} || {quote}" for c, text in raw.items()}
    return f"""CASE code WHEN 'bad_id' THEN '{BAD_ID}' || {quoted['id']}
      WHEN 'bad_x' THEN '{BAD_FLOAT}' || {quoted['x']} WHEN 'bad_y' THEN '{BAD_FLOAT}' || {quoted['y']}
      WHEN 'bad_status' THEN '{BAD_INT}' || {quoted['status']}
      WHEN 'bad_position' THEN '{BAD_POSITION}'
      WHEN 'no_olt_id' THEN '{NO_OLT_ID}' WHEN 'no_vendor_ont_id' THEN '{NO_UNIT_ID}'
      WHEN 'unknown_id' THEN '{UNKNOWN_ID[0]}' || coalesce(CAST(id AS string), {raw['id']}) || '{UNKNOWN_ID[1]}'
      ELSE code END"""


def _deal(key: list[str], line: str | None = None) -> Column:
    """What rows are dealt by besides the key. Lines that lack a part of the key meet no row; by the key they would all go to one task, so
    they go by their number."""
    whole = F.xxhash64(*key)
    if line is None:
        return whole
    return F.when(F.array_contains(F.array(*[F.col(c).isNull() for c in key]), True), F.xxhash64(line)).otherwise(whole)


def _left(lines: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """A left join by the key that spreads the lines without one."""
    return lines.withColumn("_deal", _deal(key, "line")).join(other.withColumn("_deal", _deal(key)), ["_deal", *key], "left").drop("_deal")


def classify(ont: DataFrame, olt: DataFrame, lines: DataFrame) -> DataFrame:
    """What each line does: ``action`` is inserted, updated, skipped or error.

    ``unit_id`` is the stored unit a line goes to, NULL for new keys; ``olt_key`` and
    ``unit_key`` are the key it ends under.
    """
    parsed = stored_rows(parse_lines(lines), "lines")
    stored = ont.select("id", *KEY)
    key = ["olt_key", "unit_key"]

    # Resolve the distinct ids and keys of the file, then bring the answers back to its lines.
    ids = parsed.where("by_id AND id IS NOT NULL").select("id").distinct()
    by_id = stored.join(ids, "id", "left_semi").selectExpr("id", "olt_id AS old_olt", "vendor_ont_id AS old_unit")
    target = _left(parsed, by_id, ["id"]).selectExpr(
        "*", "if(olt_id.is_set, olt_id.value, old_olt) AS olt_key",
        "if(vendor_ont_id.is_set, vendor_ont_id.value, old_unit) AS unit_key",
    )
    keys = target.where("code IS NULL").select(*key).distinct()
    owner = stored.selectExpr("olt_id AS olt_key", "vendor_ont_id AS unit_key", "id AS owner").join(keys, key, "left_semi")
    devices = olt.selectExpr("id AS olt_key", "true AS device")
    placed = _left(_left(target, owner, key), devices, ["olt_key"])
    checked = stored_rows(
        placed.selectExpr(
            *[c for c in placed.columns if c != "code"],
            """CASE
              WHEN code = 'null_key' AND old_olt IS NULL THEN 'unknown_id'
              WHEN code = 'unknown_id' AND NOT (has_values OR sets_key) THEN NULL
              WHEN code IS NOT NULL THEN code
              WHEN by_id AND old_olt IS NULL AND (has_values OR sets_key) THEN 'unknown_id'
              WHEN (sets_key OR NOT by_id) AND device IS NULL THEN 'unknown_olt'
            END AS code""",
        ).selectExpr(
            "*", "code IS NULL AND sets_key AND (olt_key <> old_olt OR unit_key <> old_unit) AS rekeys"
        ), "checked"
    )
    steps, owned = _settle_moves(checked, stored)
    settled = checked.join(steps, "line", "left").selectExpr(
        *[c for c in checked.columns if c not in ("code", *key)], "coalesce(code, if(accepted = false, 'duplicate_key', NULL)) AS code",
        "coalesce(to_olt, olt_key) AS olt_key", "coalesce(to_unit, unit_key) AS unit_key", "coalesce(accepted, false) AS moves",
    )
    # Who has the key of a line without id: as settled for moved keys, else the stored unit.
    at = owned.selectExpr("olt AS olt_key", "unit AS unit_key", "from_line", "to_line", "owner AS holder", "true AS moved_key")
    by_key = settled.where("NOT by_id").withColumn("_deal", _deal(key, "line")).alias("s").join(at.withColumn("_deal", _deal(key)).alias("w"), F.expr(
        "s._deal = w._deal AND s.olt_key = w.olt_key AND s.unit_key = w.unit_key AND s.line > w.from_line AND s.line <= w.to_line"), "left").selectExpr(
        "s.*", f"CASE WHEN moved_key IS NULL THEN owner WHEN holder <> {FRESH} THEN holder END AS held", "moved_key AND holder IS NULL AS takes").drop("_deal")
    placed_lines = by_key.unionByName(settled.where("by_id").selectExpr("*", "CAST(NULL AS bigint) AS held", "false AS takes"))

    # The first good line of a key that nobody has inserts it.
    fresh = "code IS NULL AND NOT by_id AND held IS NULL AND takes IS NULL"
    first = placed_lines.where(fresh).groupBy(*key).agg(F.min("line").alias("first_line"))
    return _left(placed_lines, first, key).selectExpr(
        *_where(lines),
        """CASE WHEN code IS NOT NULL THEN 'error'
          WHEN by_id THEN if(has_values OR sets_key, 'updated', 'skipped')
          WHEN takes OR (takes IS NULL AND held IS NULL AND line = first_line) THEN 'inserted'
          ELSE if(has_values, 'updated', 'skipped') END AS action""",
        "code", f"if(code IS NULL, NULL, {_error_text()}) AS error",
        "if(by_id, id, held) AS unit_id", *key, "moves", "point", *VALUES, "row",
    )


def _settle_moves(checked: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Moves in file order: per line its target key and whether it holds, and who has which moved key after which line.

    ``owned`` is (olt, unit, from_line, to_line, owner): lines after ``from_line`` up to ``to_line`` meet that owner, a unit id, NULL
    for nobody, or FRESH for the unit that a line of this file inserted.
    """
    good = checked.where("code IS NULL")
    moving = good.where("rekeys").select("id").distinct()
    steps = good.where("by_id AND sets_key").join(moving, "id", "left_semi").selectExpr(
        "line", "id", "old_olt", "old_unit", "if(olt_id.is_set, olt_id.value, NULL) AS set_olt",
        "if(vendor_ont_id.is_set, vendor_ont_id.value, NULL) AS set_unit")
    steps = stored_rows(steps.withColumn("accepted", F.lit(True)), "moves")
    if steps.isEmpty():
        return steps.selectExpr("line", "accepted", "set_olt AS to_olt", "set_unit AS to_unit"), steps.selectExpr(
            "set_olt AS olt", "set_unit AS unit", "line AS from_line", "line AS to_line", "id AS owner")
    lines = stored_rows(good.where("NOT by_id").selectExpr("olt_key AS olt", "unit_key AS unit", "line"), "key-lines")
    while True:
        owned, judged = _judge(steps, lines, stored)
        flips = judged.where("accepted <> guess").select("line")
        if flips.isEmpty():
            return judged.select("line", "accepted", "to_olt", "to_unit"), owned
        steps = _carried(judged, flips).select(*steps.columns)


def _owned(events: DataFrame) -> DataFrame:
    """Who has a key after which line up to which, from (olt, unit, line, owner)."""
    follow = Window.partitionBy("olt", "unit").orderBy("line")
    return events.select(
        "olt", "unit", F.col("line").alias("from_line"), F.coalesce(F.lead("line").over(follow), F.lit(AFTER_ALL)).alias("to_line"), "owner")


def _judge(steps: DataFrame, lines: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: who has which key if the guesses (``accepted``) of the last round hold, and the verdicts that follow.

    The first line without id that meets a free key inserts it. If no verdict differs from its guess, all are right.
    """
    before = Window.partitionBy("id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)

    def latest(part: str):
        return F.coalesce(F.last(F.when(F.col("accepted"), F.col(f"set_{part}")), ignorenulls=True).over(before), F.col(f"old_{part}"))

    placed = steps.withColumn("from_olt", latest("olt")).withColumn("from_unit", latest("unit")).withColumns({
        "to_olt": F.coalesce("set_olt", "from_olt"), "to_unit": F.coalesce("set_unit", "from_unit")})
    placed = placed.withColumn("moves", F.expr("from_olt <> to_olt OR from_unit <> to_unit"))
    changes = placed.where("accepted AND moves")
    keys = placed.selectExpr("from_olt AS olt", "from_unit AS unit").union(placed.select("to_olt", "to_unit")).distinct()
    owners = stored.selectExpr("olt_id AS olt", "vendor_ont_id AS unit", "id AS owner")
    events = keys.join(owners, ["olt", "unit"], "left").selectExpr("olt", "unit", f"{BEFORE_ALL}L AS line", "owner").union(
        changes.selectExpr("from_olt", "from_unit", "line", "CAST(NULL AS bigint)")).union(
        changes.select("to_olt", "to_unit", "line", "id"))
    events = stored_rows(events, "events")
    free = _owned(events).where("owner IS NULL")
    inserts = lines.alias("l").join(free.alias("w"), F.expr(
        "l.olt = w.olt AND l.unit = w.unit AND l.line > w.from_line AND l.line <= w.to_line")).groupBy("w.olt", "w.unit", "w.from_line").agg(
        F.min("l.line").alias("line")).selectExpr("olt", "unit", "line", f"{FRESH}L AS owner")
    owned = stored_rows(_owned(events.union(inserts)), "owners")
    judged = stored_rows(placed.alias("p").join(owned.alias("w"), F.expr(
        "p.to_olt = w.olt AND p.to_unit = w.unit AND p.line > w.from_line AND p.line <= w.to_line"), "left").selectExpr(
        *[f"p.{c}" for c in steps.columns if c != "accepted"], "p.accepted AS guess", "p.to_olt", "p.to_unit", "p.moves", "owner", "from_line",
        "owner IS NULL OR owner = p.id AS accepted"), "moves")
    return owned, judged


def _waits(judged: DataFrame) -> DataFrame:
    """(line, to): the line of another unit that a verdict hangs on, and is the same as: the move that freed the key, or the last one by which
    its owner was to leave and did not."""
    tries = judged.selectExpr("line", "owner AS unit", "CAST(NULL AS bigint) AS tried").where(f"unit <> {FRESH}").union(
        judged.where("moves AND NOT guess").selectExpr("line", "id", "line"))
    before = Window.partitionBy("unit").orderBy("line").rangeBetween(Window.unboundedPreceding, -1)
    last_try = tries.withColumn("refused", F.last("tried", ignorenulls=True).over(before))
    refused = last_try.where("tried IS NULL AND refused IS NOT NULL").select("line", "refused")
    waits = judged.join(refused, "line", "left").selectExpr("line", f"""CASE
        WHEN owner IS NULL AND from_line > {BEFORE_ALL} THEN from_line WHEN owner <> id AND refused > from_line THEN refused END AS to""")
    return stored_rows(waits.where("to IS NOT NULL"), "waits")


def _carried(judged: DataFrame, flips: DataFrame) -> DataFrame:
    """Verdicts with those of the first lines of chains carried to all lines that wait for them, if any of these lines changed."""
    waits = _waits(judged)
    if waits.join(flips.withColumnRenamed("line", "to"), "to", "left_semi").isEmpty():
        return judged
    ends = waits
    while True:
        ends, more = _doubled(ends)
        if not more:
            break
    root = ends.alias("e").join(judged.alias("j"), F.expr("e.to = j.line")).selectExpr("e.line", "j.accepted AS carried")
    return judged.join(root, "line", "left").withColumn("accepted", F.coalesce("carried", "accepted")).drop("carried")


def _doubled(waits: DataFrame) -> tuple[DataFrame, bool]:
    """Each line waits for what the line it waits for waits for; and whether any pointer moved."""
    further = stored_rows(waits.alias("a").join(waits.alias("b"), F.expr("a.to = b.line"), "left").selectExpr(
        "a.line", "coalesce(b.to, a.to) AS to", "b.to IS NOT NULL AS moved"), "waits")
    return further.select("line", "to"), not further.where("moved").isEmpty()


def _last(c: str):
    """The last set value of a cell over lines, in a struct; a later explicit NULL wins."""
    return F.expr(f"max_by(if({c}.is_set, named_struct('v', {c}.value), NULL), if({c}.is_set, line, NULL))").alias(c)


def import_units(ont: DataFrame, olt: DataFrame, lines: DataFrame, last_id: int = 0) -> Imported:
    """Apply CSV lines ``(line, ten text cells)``: the next unit table, what each line did, errors, counts.

    A unit table with a ``pon_id`` has it derived anew.
    """
    done = stored_rows(classify(ont, olt, lines), "done")
    good = done.where("action <> 'error'")
    folds = [_last(c) for c in ["point", *VALUES]]

    # A line of a moving unit says its whole key at that line; the last one stays.
    moved = F.expr("max_by(if(moves, named_struct('olt_id', olt_key, 'vendor_ont_id', unit_key), NULL), if(moves, line, NULL))").alias("moved")
    edits = good.where("unit_id IS NOT NULL").groupBy(F.col("unit_id").alias("id")).agg(*folds, moved)
    new_value = {c: f"if(e.{c} IS NULL, o.{c}, e.{c}.v) AS {c}" for c in VALUES}
    new_value |= {c: f"if(e.point IS NULL, o.{c}, e.point.v.{c}) AS {c}" for c in ("lon", "lat")}
    new_value |= {c: f"if(e.moved IS NULL, o.{c}, e.moved.{c}) AS {c}" for c in KEY}
    known = ont.alias("o").join(edits.alias("e"), F.expr("o.id = e.id"), "left").selectExpr(
        *[new_value.get(c, f"o.{c}") for c in ont.columns]
    )
    fresh = good.where("unit_id IS NULL AND olt_key IS NOT NULL").groupBy("olt_key", "unit_key").agg(*folds).selectExpr(
        "olt_key AS olt_id", "unit_key AS vendor_ont_id", "point.v.lon AS lon", "point.v.lat AS lat",
        *[f"{c}.v AS {c}" for c in VALUES], "'{}' AS props",
    )
    units = known.unionByName(with_new_ids(fresh, ont, KEY, last_id=last_id), allowMissingColumns=True).select(*ont.columns)
    if "pon_id" in ont.columns:
        units = with_pon_id(units, olt)
    errors = done.where("action = 'error'").select(*_where(lines), "code", "error", "row")
    return Imported(units, done.select(*_where(lines), "action", "code", "error"), errors, import_report(done))


def import_report(done: DataFrame) -> DataFrame:
    """One row of counters."""
    return done.selectExpr(
        "count(*) AS processed", *[f"count_if(action = '{a}') AS {a}" for a in ("inserted", "updated", "skipped")],
        "count_if(action = 'error') AS errors", "count_if(action = 'error') = 0 AS ok",
    )
