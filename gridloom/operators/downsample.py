"""Block downsampling: cells of factor x factor, from the top left, whole blocks only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blocks(pixels: DataFrame, factor: int, height: int, width: int) -> DataFrame:
    if height // factor == 0 or width // factor == 0:
        raise ValueError("the raster is smaller than one block")
    whole = pixels.filter((F.col("row") < height // factor * factor) & (F.col("col") < width // factor * factor))
    return whole.withColumns({"row": F.floor(F.col("row") / factor).cast("int"), "col": F.floor(F.col("col") / factor).cast("int")})


def _reduce(pixels: DataFrame, factor: int, height: int, width: int, value: Column, keys: tuple[str, ...]) -> DataFrame:
    return _blocks(pixels, factor, height, width).groupBy(*keys, "row", "col").agg(value.alias("value"))


def block_mean(pixels: DataFrame, factor: int, height: int, width: int, keys: tuple[str, ...] = ()) -> DataFrame:
    return pixels if factor <= 1 else _reduce(pixels, factor, height, width, F.avg("value"), keys)


def block_median(pixels: DataFrame, factor: int, height: int, width: int, keys: tuple[str, ...] = ()) -> DataFrame:
    return pixels if factor <= 1 else _reduce(pixels, factor, height, width, F.median("value"), keys)


def block_mode(pixels: DataFrame, factor: int, height: int, width: int, nodata: int = 0, keys: tuple[str, ...] = ()) -> DataFrame:
    """The most frequent class, of several the lowest; nodata where a block has nothing else."""
    if factor <= 1:
        return pixels
    known = F.when(F.col("value") != nodata, F.col("value"))
    return _reduce(pixels, factor, height, width, F.coalesce(F.mode(known, True), F.lit(nodata)), keys)


def block_nearest(pixels: DataFrame, factor: int, height: int, width: int) -> DataFrame:
    """Each block's top left cell."""
    if factor <= 1:
        return pixels
    return _blocks(pixels.filter((F.col("row") % factor == 0) & (F.col("col") % factor == 0)), factor, height, width)


def overviews(pixels: DataFrame, levels: tuple[int, ...], height: int, width: int) -> DataFrame:
    """The nearest cells of each level for which the raster is large enough."""
    out = None
    for level in levels:
        if min(height, width) // level < 1:
            continue
        one = block_nearest(pixels, level, height, width).withColumn("level", F.lit(level))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no level fits")
    return out


def scaled(layers: DataFrame, factor: int) -> DataFrame:
    """The layers' grids after downsampling."""
    changed = {"dx": F.col("dx") * factor, "dy": F.col("dy") * factor, "width": F.floor(F.col("width") / factor).cast("int"), "height": F.floor(F.col("height") / factor).cast("int")}
    return layers.withColumns(changed)
