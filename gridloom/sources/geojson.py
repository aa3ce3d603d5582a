"""GeoJSON areas and regions, and GeoJSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GEOMETRY = "STRUCT<type: STRING, coordinates: STRING>"
_FEATURE = f"STRUCT<type: STRING, properties: MAP<STRING, STRING>, geometry: {_GEOMETRY}>"
_FILE = f"type STRING, coordinates STRING, geometry {_GEOMETRY}, properties MAP<STRING, STRING>, features ARRAY<{_FEATURE}>"
_POLYGON, _MULTI = "ARRAY<ARRAY<ARRAY<DOUBLE>>>", "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"


def rings(geometry: Column) -> Column:
    """All rings of a polygon or multi-polygon, as arrays of struct x, y."""
    polygon = F.from_json(geometry["coordinates"], _POLYGON)
    multi = F.flatten(F.from_json(geometry["coordinates"], _MULTI))
    chosen = F.when(geometry["type"] == "Polygon", polygon).when(geometry["type"] == "MultiPolygon", multi)
    return F.transform(chosen, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def read_area(spark: SparkSession, path: str) -> DataFrame:
    """path, rings of a file's geometry: a feature's, the first feature's of a collection, or its own; else an error."""
    raw = spark.read.schema(_FILE).option("multiLine", True).json(path)
    own = F.when(F.col("coordinates").isNotNull(), F.struct("type", "coordinates"))
    geometry = F.coalesce(F.col("geometry"), F.get("features", F.lit(0))["geometry"], own)
    read = raw.select(F.input_file_name().alias("path"), rings(geometry).alias("rings"))
    return read.withColumn("rings", F.when(F.col("rings").isNotNull(), F.col("rings")).otherwise(F.raise_error(F.lit("no polygon in the file"))))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """A boundary file's regions: NUTS_ID, NAME_LATN, LEVL_CODE, CNTR_CODE, rings."""
    features = spark.read.schema(_FILE).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    prop = lambda k: F.try_element_at(F.col("f.properties"), F.lit(k))
    return features.select(prop("NUTS_ID").alias("NUTS_ID"), prop("NAME_LATN").alias("NAME_LATN"), prop("LEVL_CODE").try_cast("int").alias("LEVL_CODE"), prop("CNTR_CODE").alias("CNTR_CODE"), rings(F.col("f.geometry")).alias("rings"))


def as_geojson(ring_list: Column, properties: Column) -> Column:
    """A polygon feature as JSON text."""
    points = F.transform(ring_list, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    geometry = F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))
