"""Points along a space-filling curve, so that files and row groups hold neighbours.

A point's key interleaves the bits of its cell's column and row in a grid of 65,536 by 65,536 over the whole earth (Z order). A rectangle
is covered by a few ranges of keys, which reach the scan as plain comparisons; the exact bounds are checked on what is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ponloom.functions.geo import BBox, as_bbox, in_bbox, is_located

BITS = 16
#: Name of the key column.
KEY = "curve_key"
#: Bytes of a row group of units.
ROW_GROUP = 1 << 20


def _place(value: Column, low: float, span: float) -> Column:
    cell = F.floor((value - low) / span * (1 << BITS)).cast("bigint")
    return F.greatest(F.lit(0), F.least(cell, F.lit((1 << BITS) - 1)))


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def curve_key(lon: Column, lat: Column) -> Column:
    """Key of a point; NULL without a position. Points outside the earth count as on its edge."""
    return _spread(_place(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_place(lat, -90.0, 180.0)), 1))


def _cells(box: BBox) -> tuple[int, int, int, int]:
    def place(value: float, low: float, span: float) -> int:
        return max(0, min(int((value - low) / span * (1 << BITS) // 1), (1 << BITS) - 1))

    return (place(box.west, -180, 360), place(box.south, -90, 180), place(box.east, -180, 360), place(box.north, -90, 180))


def cover(bbox: BBox | str | tuple, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys, both ends included, that hold every point of a rectangle.

    Quarters of the grid are split as long as they lie partly in the rectangle, the largest first, and the ranges allow it.
    """
    west, south, east, north = _cells(as_bbox(bbox))
    whole: list[tuple[int, int]] = []
    part = [(BITS, 0, 0, 0)]
    while part and len(whole) + len(part) + 3 <= most:
        level, first, x, y = part.pop(0)
        if level == 0:
            whole.append((first, first))
            continue
        side = 1 << (level - 1)
        for quarter in range(4):
            a, b, at = x + side * (quarter & 1), y + side * (quarter >> 1), first + quarter * side * side
            if a > east or b > north or a + side - 1 < west or b + side - 1 < south:
                continue
            if west <= a and a + side - 1 <= east and south <= b and b + side - 1 <= north:
                whole.append((at, at + side * side - 1))
            else:
                part.append((level - 1, at, a, b))
        part.sort(reverse=True)
    ranges = sorted(whole + [(first, first + (1 << 2 * level) - 1) for level, first, _, _ in part])
    merged: list[tuple[int, int]] = []
    for a, b in ranges:
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def with_curve_key(units: DataFrame) -> DataFrame:
    return units.withColumn(KEY, F.when(is_located(), curve_key(F.col("lon"), F.col("lat"))))


def write_by_position(units: DataFrame, path: str, row_group: int = ROW_GROUP) -> None:
    """Units in ranges of the curve, sorted along it; those without a position come first."""
    keyed = with_curve_key(units).repartitionByRange(KEY).sortWithinPartitions(KEY)
    keyed.write.mode("overwrite").option("parquet.block.size", row_group).parquet(path)


def in_bbox_by_curve(units: DataFrame, bbox: BBox | str | tuple, most: int = 32) -> DataFrame:
    """Located units of a rectangle from a table with the key; the ranges and the bounds both reach the scan."""
    ranges = cover(bbox, most)
    near = F.lit(False)
    for a, b in ranges:
        near = near | F.col(KEY).between(a, b)
    return units.where(near & is_located() & in_bbox(bbox))
