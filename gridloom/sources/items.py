"""Catalog items (nested JSON) as footprints, with a cache of items by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.catalog import selector_cloud
from gridloom.sources.geojson import rings

_GEOMETRY = "STRUCT<type: STRING, coordinates: STRING>"
_ASSET = "STRUCT<href: STRING, alternate: MAP<STRING, STRUCT<href: STRING>>>"
ITEMS = f"id STRING, geometry {_GEOMETRY}, properties MAP<STRING, STRING>, assets MAP<STRING, {_ASSET}>"


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One item per line or file."""
    return spark.read.schema(ITEMS).json(path)


def footprint(geometry: Column, projected: Column) -> Column:
    """The projected geometry if it has a type and coordinates, else the item's own."""
    other = F.from_json(projected, _GEOMETRY)
    return F.when(other["type"].isNotNull() & other["coordinates"].isNotNull(), other).otherwise(geometry)


def footprints(items: DataFrame) -> DataFrame:
    """id, acq_ts, cloud, platform, constellation, collection, rings; an item without a time is an error."""
    prop = lambda k: F.try_element_at("properties", F.lit(k))
    time = F.try_to_timestamp(prop("datetime"))
    return items.select(
        "id",
        F.when(time.isNotNull(), time).otherwise(F.raise_error(F.concat(F.lit("no datetime: "), F.col("id"))).cast("timestamp")).alias("acq_ts"),
        selector_cloud(F.col("properties")).alias("cloud"),
        prop("platform").alias("platform"),
        prop("constellation").alias("constellation"),
        prop("collection").alias("collection"),
        rings(footprint(F.col("geometry"), prop("proj:geometry"))).alias("rings"),
    )


def cached_items(wanted: DataFrame, cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """Items by id: from the cache, and only for its misses from the fetched ones."""
    known = wanted.join(cache, "id")
    missing = wanted.join(cache.select("id"), "id", "left_anti")
    return known.unionByName(missing.join(fetched, "id"))
