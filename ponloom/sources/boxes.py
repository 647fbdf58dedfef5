"""Distribution boxes from the answers of the map service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ponloom.operators.numbering import with_record_number

_ROWS = "status string, data struct<rows:array<struct<nombre:string,uuid:string>>>"
_FEATURE = "type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<nombre:string,uuid:string>"
_GEOJSON = f"status string, data struct<type:string,features:array<struct<{_FEATURE}>>>"


def _accepted(envelopes: DataFrame, ok) -> DataFrame:
    refused = F.raise_error(F.concat(F.lit("unexpected answer of the map service, status "), F.coalesce("status", F.lit("missing"))))
    return envelopes.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(refused.cast("boolean")))


def read_cto_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``(nombre, uuid)`` from row answers; an answer that is not OK is an error.

    With ``multi_line`` each file is one answer, read by one task; without it each line is one.
    """
    answers = spark.read.schema(_ROWS).option("multiLine", multi_line).json(path)
    good = _accepted(answers, F.col("status") == "OK")
    return good.select(F.inline("data.rows"))


def read_cto_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Boxes with positions from FeatureCollection answers, one row per feature, in order."""
    answers = spark.read.schema(_GEOJSON).option("multiLine", True).json(path)
    good = _accepted(answers, (F.col("status") == "OK") & (F.col("data.type") == "FeatureCollection"))
    return _points(good.select(F.posexplode("data.features").alias("pos", "f")))


def read_cto_features(spark: SparkSession, path: str) -> DataFrame:
    """The same from GeoJSON lines, one feature a line, which Spark reads in parallel."""
    lines = spark.read.schema(_FEATURE.replace(":", " ", 1).replace(",geometry:", ", geometry ").replace(",properties:", ", properties ")).json(path)
    numbered = with_record_number(lines, "pos", first=0)
    return _points(numbered.select("pos", F.struct("type", "geometry", "properties").alias("f")))


def _points(features: DataFrame) -> DataFrame:
    spot = F.col("f.geometry.coordinates")
    return features.select(
        "pos", F.col("f.properties.uuid").alias("uuid"), F.col("f.properties.nombre").alias("nombre"),
        F.get(spot, F.lit(0)).alias("lon"), F.get(spot, F.lit(1)).alias("lat"),
    )


def cto_points(features: DataFrame) -> DataFrame:
    """Boxes by uuid; the last feature of a uuid counts."""
    newest = F.max_by(F.struct("nombre", "lon", "lat"), "pos").alias("last")
    return features.groupBy("uuid").agg(newest).select("uuid", "last.nombre", "last.lon", "last.lat")
