"""Distribution boxes: search, links to units, extents and clusters of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ponloom.functions.geo import cell_index, is_located
from ponloom.functions.text import match_rank
from ponloom.operators.upkeep import one_per_key
from ponloom.plans.checks import at_least_chars, bounded

# Where a map opens when there is nothing to show.
DEFAULT_VIEW = {"lat": 40.4168, "lon": -3.7038, "zoom": 6}
BOX_TYPE = 11


def cto_list(equipment: DataFrame) -> DataFrame:
    """Boxes among all equipment rows."""
    return equipment.where(F.col("tipo") == BOX_TYPE).select("nombre", "uuid")


def search_cto(cto: DataFrame, q: str, k: int = 80) -> DataFrame:
    """The k best matches by uuid or name; ties go by name, then uuid."""
    at_least_chars("q", q.strip(), 2)
    bounded("k", k, 1)
    ranked = cto.withColumn("score", match_rank(q, "uuid", "nombre"))
    return ranked.where(F.col("score").isNotNull()).orderBy("score", "nombre", "uuid").limit(k)


def _boxes(cto: DataFrame, order_by: str | None) -> DataFrame:
    """Boxes by uuid: the last row of a uuid counts; without an order a repeated one is an error."""
    named = cto.where(F.col("uuid") != "").select(
        F.col("uuid").alias("cto_uuid"), F.col("nombre").alias("cto_name"),
        F.col("lon").alias("cto_lon"), F.col("lat").alias("cto_lat"), *([order_by] if order_by else []),
    )
    return one_per_key(named, ["cto_uuid"], order_by)


def enrich_cto(ont: DataFrame, cto: DataFrame, order_by: str | None = None) -> DataFrame:
    """All units, with name and position of their box where it is known; of boxes with one uuid the last by ``order_by``."""
    return ont.join(_boxes(cto, order_by), "cto_uuid", "left")


def cto_links(ont: DataFrame, cto: DataFrame, order_by: str | None = None) -> DataFrame:
    """A line from each located unit to its box, where the box is known; of boxes with one uuid the last by ``order_by``."""
    units = ont.where(is_located() & F.col("cto_uuid").isNotNull()).select("id", "cto_uuid", "lon", "lat")
    return units.join(_boxes(cto, order_by), "cto_uuid").select(
        "id", "cto_uuid", F.col("lon").alias("lon1"), F.col("lat").alias("lat1"),
        F.col("cto_lon").alias("lon2"), F.col("cto_lat").alias("lat2"),
    )


def points(*layers: DataFrame) -> DataFrame:
    """The positions of all layers in one table."""
    first, *rest = [layer.where(is_located()).select("lon", "lat") for layer in layers]
    for layer in rest:
        first = first.union(layer)
    return first


def extent(df: DataFrame, pad: float = 0.15) -> DataFrame:
    """Bounding rectangle of all points, widened on each side by a share of its size.

    One row; the bounds are NULL when there is no point.
    """
    box = df.agg(
        F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"),
        F.max("lat").alias("n"), F.count("lon").alias("n_points"),
    )
    dx, dy = (F.col("e") - F.col("w")) * pad, (F.col("n") - F.col("s")) * pad
    return box.select(
        (F.col("w") - dx).alias("west"), (F.col("s") - dy).alias("south"),
        (F.col("e") + dx).alias("east"), (F.col("n") + dy).alias("north"), "n_points",
    )


def map_view(*layers: DataFrame, pad: float = 0.15) -> DataFrame:
    """Extent and centre of all layers; the default centre when there is no point."""
    lat, lon = DEFAULT_VIEW["lat"], DEFAULT_VIEW["lon"]
    return extent(points(*layers), pad).selectExpr(
        "*", f"coalesce((south + north) / 2, {lat}D) AS center_lat", f"coalesce((west + east) / 2, {lon}D) AS center_lon"
    )


def grid_clusters(df: DataFrame, size: float) -> DataFrame:
    """Points counted by square cells of a grid, with their mean position."""
    if size <= 0:
        raise ValueError("size must be above 0")
    return (
        df.where(is_located())
        .groupBy(cell_index(F.col("lon"), size).alias("cell_x"), cell_index(F.col("lat"), size).alias("cell_y"))
        .agg(F.count("*").alias("n_points"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    )


def grid_pyramid(df: DataFrame, finest: float, levels: int = 12) -> DataFrame:
    """Points counted by square cells for several zooms at once: level 0 has cells of size ``finest``, each next level cells of twice the size.

    Points are read and counted once, in the finest cells; the coarser cells are sums of these, as their numbers are prefixes.
    """
    if finest <= 0 or levels < 1:
        raise ValueError("finest and levels must be above 0")
    cells = df.where(is_located()).groupBy(
        cell_index(F.col("lon"), finest).alias("x"), cell_index(F.col("lat"), finest).alias("y")
    ).agg(F.count("*").alias("n"), F.sum("lon").alias("lon"), F.sum("lat").alias("lat"))
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    up = cells.select(level, "*").groupBy("level", F.expr("shiftright(x, level)").alias("cell_x"), F.expr("shiftright(y, level)").alias("cell_y"))
    return up.agg(
        F.sum("n").alias("n_points"), (F.sum("lon") / F.sum("n")).alias("lon"), (F.sum("lat") / F.sum("n")).alias("lat"))
