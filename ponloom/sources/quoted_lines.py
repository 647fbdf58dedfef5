"""Records of quoted text files, found in parallel.

A quoted cell may hold line breaks, so where a record ends depends on all quotes before. Spark reads a file as splits of lines. Of each line it
is known how it changes the state, inside or outside a quoted cell, for both states it can begin in: it keeps the
state, swaps it, or sets it. Such changes add up: first over the lines of every split, then over the splits, of which there are
few. Then each split knows its first state and the number of its first record, and is read on its own.

A split in which no cell with a line break lies and no line is blank needs no shuffle. The lines of the others are sorted inside their split,
and only the lines of records with line breaks are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ponloom.operators.lineage import cut

# A quote opens a cell at the begin of a line or after a comma; inside, two quotes are one. What follows a closed cell up to the comma is plain text.
_CLOSED = r'(^|,)"(?:[^"]|"")*+"'
_OPENS = r'(^|,)"'
_REST = r'^(?:[^"]|"")*+"'


def _opens(text: Column) -> Column:
    """Whether a cell is still open at the end of a line that begins outside."""
    return F.regexp_replace(text, _CLOSED, "$1.").rlike(_OPENS)


def _changes(line: Column) -> tuple[Column, Column]:
    """What the state is after a line that begins outside, and inside, a quoted cell."""
    plain = ~F.contains(line, F.lit('"'))
    closes = line.rlike(_REST)
    inside = F.when(closes, _opens(F.regexp_replace(line, _REST, "."))).otherwise(True)
    return F.when(plain, False).otherwise(_opens(line)), F.when(plain, True).otherwise(inside)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place, and how they change the state."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    outside, inside = _changes(F.col("value"))
    return lines.withColumns({"outside": outside, "inside": inside, "blank": F.rtrim("value", F.lit("\r")) == ""})


def _state(first: Column, window) -> Column:
    """State before a line: the last one that a line set, swapped as often as lines did since."""
    swap = (F.col("outside") & ~F.col("inside")).cast("int")
    swaps = F.coalesce(F.sum(swap).over(window), F.lit(0))
    sets = F.col("outside") == F.col("inside")
    last = F.last(F.when(sets, F.col("outside").cast("int") + 2 * F.col("_swaps")), ignorenulls=True).over(window)
    return F.when(last.isNull(), (first.cast("int") + swaps) % 2).otherwise((last % 2 + swaps - F.floor(last / 2)) % 2) == 1


def _with_swaps(rows: DataFrame, window) -> DataFrame:
    """``_swaps``: lines up to and with this one that swap the state."""
    return rows.withColumn("_swaps", F.sum((F.col("outside") & ~F.col("inside")).cast("bigint")).over(window))


def _splits(lines: DataFrame) -> DataFrame:
    """One row a split: its change of the state, and what is in it."""
    swap = F.col("outside") & ~F.col("inside")
    sets = F.col("outside") == F.col("inside")
    # A line that sets the state makes all before it forgotten: of the lines after the last one only the swaps count.
    last = lines.where(sets).groupBy("file", "split").agg(F.max("at").alias("set_at"), F.max_by("outside", "at").alias("set_to"))
    marked = lines.join(last, ["file", "split"], "left")
    after = F.col("set_at").isNull() | (F.col("at") > F.col("set_at"))
    counted = marked.groupBy("file", "split").agg(
        F.min("at").alias("first"), F.count("*").alias("n"), F.count_if("blank").alias("n_blank"), F.count_if("outside").alias("n_open"),
        F.count_if(~F.is_valid_utf8("value")).alias("n_bad"), F.max("set_to").alias("set_to"), F.count_if(swap & after).alias("swaps"))
    odd = F.col("swaps") % 2 == 1
    return counted.withColumns({
        "outside": F.when(F.col("set_to").isNull(), odd).otherwise(F.col("set_to") != odd),
        "inside": F.when(F.col("set_to").isNull(), ~odd).otherwise(F.col("set_to") != odd)})


def read_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(file, record, place, text): records of all files, without blank ones.

    ``record`` counts in the file from 0, the header, and ``place`` over all files in the order of their paths. Lines end with a line feed, or a
    carriage return and one. Without ``multi_line`` every line is a record. Text that is not UTF-8 is an error.
    """
    lines = read_lines(spark, path)
    if not multi_line:
        lines = lines.withColumns({"outside": F.lit(False), "inside": F.lit(True)})
    splits = cut(_splits(lines))
    bad = splits.where("n_bad > 0").select("file").first()
    if bad is not None:
        raise ValueError(f"the CSV file is not UTF-8: {bad['file']}")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, 0)
    # Every file begins outside.
    splits = cut(_with_swaps(splits, upto).withColumn("begins_inside", F.coalesce(_state(F.lit(False), before), F.lit(False))))
    easy = ~F.col("begins_inside") & (F.col("n_open") == 0) & (F.col("n_blank") == 0)
    starts = splits.select("file", "split", "first", "begins_inside", easy.alias("easy"))
    # One row a split, here and below, so the lines themselves need no shuffle.
    placed = lines.join(F.broadcast(starts), ["file", "split"])

    inner = Window.partitionBy("file", "split").orderBy("at")
    hard = _with_swaps(placed.where("NOT easy"), inner.rowsBetween(Window.unboundedPreceding, 0))
    hard = hard.withColumn("continues", _state(F.col("begins_inside"), inner.rowsBetween(Window.unboundedPreceding, -1)))
    hard = hard.withColumn("begins", (~F.col("continues") & ~F.col("blank")).cast("bigint"))
    # Lines before the first record of a split belong to the last one of the split before.
    hard = hard.withColumn("nth", F.sum("begins").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    hard = hard.where("continues OR NOT blank").select("file", "split", "at", "value", "nth", "continues", F.when(F.col("continues"), F.col("inside")).otherwise(F.col("outside")).alias("open"))
    sizes = splits.where(easy).select("file", "split", F.col("n").alias("records")).unionByName(
        hard.groupBy("file", "split").agg(F.max("nth").alias("records")))
    # One row a split.
    all_before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    numbers = cut(sizes.select(
        "file", "split", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("in_file"), F.coalesce(F.sum("records").over(all_before), F.lit(0)).alias("in_all")))

    key = ["file", "split"]
    text = F.rtrim("value", F.lit("\r")).alias("text")
    whole = placed.where("easy").join(F.broadcast(numbers), key).select(
        "file", (F.col("in_file") + F.col("at") - F.col("first")).alias("record"), (F.col("in_all") + F.col("at") - F.col("first")).alias("place"), text)
    known = hard.join(F.broadcast(numbers), key).withColumns({"record": F.col("in_file") + F.col("nth") - 1, "place": F.col("in_all") + F.col("nth") - 1})
    single = known.where("NOT continues AND NOT open").select("file", "record", "place", text)
    parts = known.where("continues OR open").groupBy("file", "record", "place").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("lines"))
    several = parts.select("file", "record", "place", F.rtrim(F.array_join("lines.value", "\n"), F.lit("\r")).alias("text"))
    return whole.unionByName(single).unionByName(several)
