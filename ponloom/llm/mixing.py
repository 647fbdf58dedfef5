"""Mixing of sources to target weights: rates of documents by entropy balancing, rounded into whole copies.

Among all rates that give each source its target of words, the balanced ones are nearest to one copy of every document in relative
entropy: ``rate = min(most, exp(tilt * size))`` with one tilt a source. The tilts solve the convex dual, whose gradient is the words taken less
the target. Newton steps find them for all sources at once; a step that leaves the interval known to hold the
solution is replaced by its middle, so the search always ends.

Everything is built-in functions. Documents are first counted by source and size, so the iterations read one row for each size that a
source has, and no source, however large, passes through one task. Rates become copies by systematic rounding in order of size:
the sum of rates so far, plus an offset, is rounded down, and a document takes the steps in between. Neighbours have almost
equal sizes, so a source misses its target by less than its longest document; of ``OFFSETS`` offsets the one nearest to the target is taken,
and then one document may get a copy more or less where that comes nearer still.

Defined results: null texts have size 0, as have blank ones, and take no words; a null source is a source of its own, the last one; the order of equal
documents is a hash of their id; rows with equal id, source and size are alike, and it is not said which of them gets a copy more; without
any words every target is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ponloom.llm.frames import null_safe_join
from ponloom.operators.lineage import stored
from ponloom.operators.numbering import numbered

WEIGHTS = (5, 2, 1)
#: Offsets tried by the rounding, documents numbered in one task, and relative error of the words a tilt gives.
OFFSETS, BUCKET, PRECISION = 64, 1 << 16, 1e-9


def size(text: str | Column) -> Column:
    """Number of runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _numbered_sources(sources: DataFrame) -> DataFrame:
    """Sources with their number by code point, null last, from 0: sorted by ranges, each of which starts where those before it end."""
    last = F.col("source").isNull()
    ranges = sources.withColumn("_last", last).repartitionByRange("_last", "source").withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, "sources")
    return numbered(ranges, [], F.col("_range"), ["_last", "source"], "n").withColumn("n", F.col("n") - 1).drop("_last", "_range")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Add the target of each of the (source, source_size) rows: shares of all words by weight, none above ``most`` times its own.

    What a source cannot take is shared anew among the others, by weight, until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    rows = stored(_numbered_sources(sources).withColumn("weight", weight).withColumn("limit", F.col("source_size") * most), "weights")
    total = rows.agg(F.sum("source_size").alias("all")).first()["all"] or 0
    level, full = 0.0, -1
    while True:
        # Sources below their limit share what the full ones leave. A full source stays full, as the level only rises.
        is_full = F.col("limit") <= F.col("weight") * level if full >= 0 else F.lit(False)
        left = rows.agg(
            F.sum(F.when(is_full, F.col("limit")).otherwise(0)).alias("taken"), F.sum(F.when(~is_full, F.col("weight"))).alias("w"),
            F.count_if(is_full).alias("full")).first()
        if left["w"] is None or left["full"] == full:
            break
        full, level = left["full"], (total - left["taken"]) / left["w"]
    return rows.select("source", "source_size", F.least(F.col("limit").cast("double"), F.col("weight") * level).alias("target"))


def _rate(most: int) -> Column:
    """Never above the limit: beyond it the exponent would overflow for long documents."""
    return F.when(F.col("tilt") * F.col("size") >= math.log(most), float(most)).otherwise(F.exp(F.col("tilt") * F.col("size")))


def tilts(cells: DataFrame, goals: DataFrame, most: int = 3, precision: float = PRECISION) -> DataFrame:
    """The tilt of each source, from (source, size, n) counts and (source, source_size, target).

    ``low`` and ``high`` enclose the tilt all the time: at a tilt of log(most) every document is at its limit, and below
    zero a source takes at most exp(tilt) of its words.
    """
    share, top = F.col("target") / F.col("source_size"), math.log(most)
    state = stored(goals.where("source_size > 0").select(
        "source", "target", F.lit(0.0).alias("tilt"), F.least(F.lit(0.0), F.log(share)).alias("low"),
        F.when(share > 1, top).otherwise(0.0).alias("high"), F.lit(False).alias("done")), "tilts")
    x, weight = F.col("size"), F.col("n") * F.col("size") * _rate(most)
    while not (still := state.where("NOT done")).isEmpty():
        sums = null_safe_join(cells.select("source", "size", "n"), still.select("source", "tilt"), ["source"]).groupBy("source").agg(
            F.sum(weight).alias("taken"), F.sum(F.when(F.col("tilt") * x < top, weight * x).otherwise(0.0)).alias("slope"))
        miss = F.col("taken") - F.col("target")
        moved = null_safe_join(still, sums, ["source"]).withColumns({
            "low": F.when(miss < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))})
        step = F.when(F.col("slope") > 0, F.col("tilt") - miss / F.col("slope"))
        middle = (F.col("low") + F.col("high")) / 2
        # Near enough, or no double lies between the ends.
        done = (F.abs(miss) <= precision * F.col("target")) | (middle <= F.col("low")) | (middle >= F.col("high"))
        now = F.when(done, F.col("tilt")).when((step > F.col("low")) & (step < F.col("high")), step).otherwise(middle)
        moved = moved.select("source", "target", now.alias("tilt"), "low", "high", done.alias("done"))
        state = stored(state.where("done").unionByName(moved), "tilts")
    return state.select("source", "tilt")


def _upto(place: Column) -> Column:
    """Copies of the documents of a source up to a place in a cell."""
    return F.floor(F.col("before") + place * F.col("rate") + F.col("offset"))


def _rounded(cells: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """Cells with rate, the sum of rates before, the offset of their source, and the change of their first document."""
    goal = null_safe_join(goals, tilts(cells, goals, most), ["source"], "left").fillna(0.0, ["tilt"])
    rated = null_safe_join(cells, goal, ["source"]).withColumn("rate", F.when(F.col("size") > 0, _rate(most)).otherwise(0.0)).drop("tilt")
    # Sizes of one source: as many rows as it has lengths of documents, not documents.
    earlier = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = stored(rated.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(earlier), F.lit(0.0))), "rates")
    offsets = F.array(*[F.lit(k / OFFSETS) for k in range(OFFSETS)])
    words = F.col("size") * (_upto(F.col("n")) - _upto(F.lit(0)))
    tried = rated.withColumn("offset", F.explode(offsets)).groupBy("source", "offset").agg((F.sum(words) - F.max("target")).alias("miss"))
    best = tried.groupBy("source").agg(F.min(F.struct(F.abs("miss"), "offset", "miss")).alias("best")).select("source", "best.offset", "best.miss")
    rated = stored(null_safe_join(rated, best, ["source"]), "offsets")
    # One document, the first of its size, may take a copy more or less where that comes nearer.
    first = _upto(F.lit(1)) - _upto(F.lit(0))
    change = F.explode(F.array(F.when(first < most, 1), F.when(first > 0, -1))).alias("change")
    after = F.abs(F.col("miss") + F.col("change") * F.col("size"))
    fixed = rated.select("source", "size", "miss", change).where(after < F.abs("miss")).groupBy("source").agg(
        F.min(F.struct(after, "size", "change")).alias("fix")).select("source", "fix.size", F.col("fix.change").alias("change"))
    return null_safe_join(rated.drop("miss"), fixed, ["source", "size"], "left").fillna(0, ["change"])


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = 3, id_col: str = "doc_id", source_col: str = "source",
    size_col: str = "size",
) -> DataFrame:
    """One row for every row of ``docs``: id, source, size, source_size, target, rate, copies and taken (copies times size).

    ``size_col`` holds the words of a document, see ``size``. A document gets at most ``most`` copies.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(size_col, F.lit(0)).cast("long").alias("size"))
    # Rows that are alike are counted, and come out again at the end.
    rows = stored(rows.groupBy("id", "source", "size").agg(F.count("*").alias("m")), "sizes")
    cells = stored(rows.groupBy("source", "size").agg(F.sum("m").alias("n"), F.count("*").alias("ids")), "cells")
    goals = stored(targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, most), "targets")
    rated = _rounded(cells, goals, most)

    # Documents of one source and size are numbered by a hash of the id, in buckets where they are many.
    bucket = F.pmod(F.xxhash64("id"), F.ceil(F.col("ids") / BUCKET)).alias("bucket")
    cell, part = ["source", "size"], ["source", "size", "bucket"]
    placed = null_safe_join(rows, rated, cell).select("*", bucket)
    so_far = Window.partitionBy(*part).orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("upto", F.sum("m").over(so_far))
    sums = null_safe_join(rows, cells.where(F.col("ids") > BUCKET).select(*cell, "ids"), cell).groupBy(*cell, bucket).agg(F.sum("m").alias("rows"))
    earlier = Window.partitionBy(*cell).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*part, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    placed = null_safe_join(placed, starts, part, "left").fillna(0, ["start"])
    each = placed.withColumn("place", F.explode(F.sequence(F.col("start") + F.col("upto") - F.col("m") + 1, F.col("start") + F.col("upto"))))
    change = F.when(F.col("place") == 1, F.col("change")).otherwise(0)
    copies = (F.least(_upto(F.col("place")) - _upto(F.col("place") - 1), F.lit(most)) + change).cast("long")
    return each.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("size").alias(size_col), "source_size", "target", "rate", copies.alias("copies"),
    ).withColumn("taken", F.col("copies") * F.col(size_col))


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as the mix has copies of it. Ids must be unique."""
    n = mixed.select(F.col(id_col).alias("_id"), F.col("copies").alias("_copies")).where("_copies > 0")
    both = docs.join(n, docs[id_col].eqNullSafe(n["_id"]))
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).drop("_id", "_copies", "_copy")
