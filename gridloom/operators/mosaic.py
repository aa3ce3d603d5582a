"""Mosaics: overlapping tiles to one value per cell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.grid import Grid, onto

METHODS = {
    "first": lambda value, order: F.min_by(value, order),
    "last": lambda value, order: F.max_by(value, order),
    "min": lambda value, order: F.min(value),
    "max": lambda value, order: F.max(value),
    "sum": lambda value, order: F.sum(value),
    "count": lambda value, order: F.count(value),
}


def mosaic(pixels: DataFrame, method: str = "first", keys: tuple[str, ...] = ("row", "col"), value: str = "value", order: str = "tile_ord") -> DataFrame:
    """pixels (keys, value, tile order): missing values never count; cells without any value are not in the result."""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    return pixels.filter(F.col(value).isNotNull()).groupBy(*keys).agg(METHODS[method](F.col(value), F.col(order)).alias(value))


def harmonised(pixels: DataFrame, grids: dict[int, Grid], method: str = "first") -> DataFrame:
    """pixels (tile_ord, row, col, value) of tiles of any zones: their mosaic on the first tile's grid, continued.

    Each tile is brought by nearest cells into the first tile's zone, over its own extent only; the first stays as it is.
    """
    spark, target = pixels.sparkSession, grids[min(grids)]
    moved = []
    for order, source in sorted(grids.items()):
        own = pixels.filter(F.col("tile_ord") == order).select(F.col("row").alias("src_row"), F.col("col").alias("src_col"), "value")
        moved.append(onto(spark, source, target).join(own, ["src_row", "src_col"]).select("row", "col", F.lit(order).alias("tile_ord"), "value"))
    return mosaic(reduce(DataFrame.unionByName, moved), method)


def consistent(layers: DataFrame) -> DataFrame:
    """layers of each mosaic: raises if their types differ, or the first has no projection; else one row each."""
    checked = layers.groupBy("mosaic_id").agg(F.countDistinct("dtype").alias("dtypes"), F.min_by("epsg", "tile_ord").alias("epsg"), F.count(F.lit(1)).alias("tiles"))
    right = (F.col("dtypes") == 1) & F.col("epsg").isNotNull()
    message = F.concat(F.lit("inconsistent tiles: "), F.col("mosaic_id"))
    return checked.select("mosaic_id", "tiles", F.when(right, F.col("epsg")).otherwise(F.raise_error(message).cast("int")).alias("epsg"))


def aligned(left: DataFrame, right: DataFrame, key: str = "scene_id") -> DataFrame:
    """Pairs of layers; raises where projection, origin, cell or shape differ."""
    grid = ["epsg", "x0", "y0", "dx", "dy", "width", "height"]
    both = left.select(key, *(F.col(c).alias(f"l_{c}") for c in grid)).join(right.select(key, *(F.col(c).alias(f"r_{c}") for c in grid)), key)
    same = F.lit(True)
    for c in grid:
        same = same & F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))
    return both.select(key, F.when(same, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("grids differ: "), F.col(key))).cast("boolean")).alias("aligned"))


def output_type(dtype: str, nodata: float | None, requested: float | None, promote: bool = True) -> tuple[str, float | None]:
    """The type and nodata of a mosaic: NaN needs a float type, or else the source's own nodata."""
    if requested is None:
        return dtype, nodata
    if requested == requested or dtype.startswith("float"):
        return dtype, requested
    if promote:
        return "float32", requested
    if nodata is None:
        raise ValueError("NaN cannot be stored in an integer raster without its own nodata")
    return dtype, nodata
