"""Points as two columns, rectangles as comparisons, GeoJSON as text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, functions as F


class BBox(NamedTuple):
    west: float
    south: float
    east: float
    north: float

    @classmethod
    def parse(cls, text: str) -> "BBox":
        """Read ``minLon,minLat,maxLon,maxLat``."""
        try:
            box = cls(*map(float, text.split(",")))
        except (TypeError, ValueError):
            raise ValueError("bbox must be 'minLon,minLat,maxLon,maxLat'") from None
        return box.checked()

    def checked(self) -> "BBox":
        if self.west >= self.east or self.south >= self.north:
            raise ValueError("bbox is empty")
        return self

    def text(self) -> str:
        return ",".join(map(str, self))


def as_bbox(box: BBox | str | tuple) -> BBox:
    return BBox.parse(box) if isinstance(box, str) else BBox(*box).checked()


def make_point(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Both coordinates, or NULL for both if one is missing."""
    whole = lon.isNotNull() & lat.isNotNull()
    return F.when(whole, lon), F.when(whole, lat)


def is_located(lon: Column | None = None, lat: Column | None = None) -> Column:
    lon, lat = F.col("lon") if lon is None else lon, F.col("lat") if lat is None else lat
    return lon.isNotNull() & lat.isNotNull()


def in_bbox(box: BBox | str | tuple, lon: Column | None = None, lat: Column | None = None) -> Column:
    """Point in rectangle, edges included. The bounds reach the Parquet scan."""
    box = as_bbox(box)
    lon, lat = F.col("lon") if lon is None else lon, F.col("lat") if lat is None else lat
    return lon.between(box.west, box.east) & lat.between(box.south, box.north)


def geojson_point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def feature(lon: Column, lat: Column, properties: Column) -> Column:
    """One GeoJSON Feature as JSON text, NULL properties kept."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            geojson_point(lon, lat).alias("geometry"),
            properties.alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )


def cell_index(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size))).cast("bigint")
