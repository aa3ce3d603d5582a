"""Composites: observations to one value per cell and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.periods import month_label, quarter_label
from gridloom.functions.spectral import hidden, index, mask
from gridloom.schemas import require_columns


def pivot_bands(pixels: DataFrame, bands: dict[str, str]) -> DataFrame:
    """scene, row, col, band, value to one column per band, in one shuffle; cells without red or nir are dropped."""
    picked = pixels.groupBy("scene", "row", "col").agg(*(F.max(F.when(F.col("band") == band, F.col("value"))).alias(name) for name, band in bands.items()))
    return picked.filter("red IS NOT NULL AND nir IS NOT NULL")


def observations_to_index(obs: DataFrame, nodata: int | None = 0) -> DataFrame:
    """obs (…, red, nir, scl) to index, NULL where hidden or undefined."""
    require_columns(obs, ["red", "nir", "scl"])
    value = mask(index(F.col("nir"), F.col("red")), hidden(F.col("scl"), nodata))
    return obs.withColumn("ndvi", value).drop("red", "nir", "scl")


def inside(obs: DataFrame, cells: DataFrame) -> DataFrame:
    return obs.join(cells.select("row", "col"), ["row", "col"], "left_semi")


def composite(obs: DataFrame, period: Column) -> DataFrame:
    """obs (acq, row, col, ndvi): the median of each cell and period."""
    return obs.filter("ndvi IS NOT NULL").groupBy(period.alias("period"), "row", "col").agg(F.median("ndvi").alias("ndvi"))


def composite_by_timestamp(obs: DataFrame) -> DataFrame:
    return composite(obs, F.col("acq").cast("string"))


def scene_jobs(scenes: DataFrame, min_scenes: int) -> DataFrame:
    """scenes (acq): which scenes make which period: dense months, and whole quarters that have a sparse month.

    A quarter takes all its scenes, also those of its dense months.
    """
    month, quarter = month_label(F.col("acq")), quarter_label(F.col("acq"))
    labelled = scenes.select("acq").distinct().select("acq", month.alias("month"), quarter.alias("quarter"))
    counted = labelled.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("month")))
    sparse = counted.filter(F.col("n") < min_scenes).select("quarter").distinct()
    dense = counted.filter(F.col("n") >= min_scenes).select("acq", F.col("month").alias("period"))
    return dense.unionByName(counted.join(sparse, "quarter", "left_semi").select("acq", F.col("quarter").alias("period")))


def composite_with_fallback(obs: DataFrame, min_scenes: int) -> DataFrame:
    """Monthly composites, and quarterly ones for quarters with a month of too few scenes."""
    jobs = scene_jobs(obs, min_scenes)
    return composite(obs.join(jobs, "acq"), F.col("period"))


def cap_scenes(scenes: DataFrame, most: int) -> DataFrame:
    """The first scenes of each period in name order, before any is found invalid."""
    return scenes.withColumn("nth", F.row_number().over(Window.partitionBy("period").orderBy("scene"))).filter(F.col("nth") <= most).drop("nth")


def composite_stats(composites: DataFrame) -> DataFrame:
    return composites.groupBy("period").agg(
        F.min("ndvi").alias("ndvi_min"),
        F.max("ndvi").alias("ndvi_max"),
        F.try_divide(F.count_if(F.col("ndvi") < 0), F.count("ndvi")).alias("ndvi_share_negative"),
    )


def composite_metadata(jobs: DataFrame, composites: DataFrame, aoi_id: str, cloud_masking: bool = True) -> DataFrame:
    """jobs (acq, period): a document per composite: which scenes it used and the range of its values."""
    used = jobs.groupBy("period").agg(F.sort_array(F.collect_set(F.col("acq").cast("string"))).alias("folders"))
    made = used.join(composite_stats(composites), "period", "left")
    return made.select(F.col("period").alias("label"), F.lit(aoi_id).alias("aoi_id"), F.size("folders").alias("scenes_used"), "folders", F.lit(cloud_masking).alias("cloud_masking"), "ndvi_min", "ndvi_max", "ndvi_share_negative")
