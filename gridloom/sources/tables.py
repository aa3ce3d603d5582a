"""CSV tables with explicit schemas, and discovery of rasters by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.periods import month_label, quarter_label
from gridloom.functions.text import raster_period

TIME_SERIES = "anchor_date DATE, acq_datetime TIMESTAMP, tile_ids STRING, tiles_count INT, cloud_score DOUBLE, coverage_frac DOUBLE, coverage_area DOUBLE"
SCENES_SELECTED = "anchor_date DATE, acq_datetime TIMESTAMP, id STRING, datetime TIMESTAMP, cloud_cover DOUBLE, platform STRING, constellation STRING, collection STRING, coverage_frac_union DOUBLE, coverage_area_union DOUBLE"
TIMESTAMPS_COVERAGE = "acq_datetime TIMESTAMP, coverage_frac DOUBLE, tiles_count INT, min_cloud DOUBLE, max_cloud DOUBLE, has_full_cover BOOLEAN"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def write_csv(df: DataFrame, path: str, parts: int | None = 1) -> None:
    """One file with a header, also when there are no rows; or so many parts, or with None as many as there are tasks."""
    (df if parts is None else df.coalesce(parts)).write.mode("overwrite").csv(path, header=True)


def scene_folders(paths: DataFrame) -> DataFrame:
    """paths (path): folders whose name is a UTC time, with its month and quarter; others go."""
    name = F.regexp_extract("path", r"([^/]+)/?$", 1)
    shaped = F.regexp_replace(F.regexp_replace(name, " ", "T"), "_", ":")
    found = paths.select("path", name.alias("folder"), F.coalesce(F.try_to_timestamp(name), F.try_to_timestamp(shaped)).alias("acq_ts"))
    return found.filter("acq_ts IS NOT NULL").withColumns({"month": month_label(F.col("acq_ts")), "quarter": quarter_label(F.col("acq_ts"))})


def composite_files(paths: DataFrame, aoi: str | None = None, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """paths (path): composites with their period and year, of the area and within the years."""
    found = paths.select("path", raster_period(F.col("path"), aoi).alias("period")).filter("period <> ''").withColumn("year", F.substring("period", 1, 4).cast("int"))
    if first_year is not None:
        found = found.filter(F.col("year") >= first_year)
    return found if last_year is None else found.filter(F.col("year") <= last_year)


def anomaly_files(paths: DataFrame, aoi: str | None = None) -> DataFrame:
    """Anomaly rasters, but no climatologies or medians."""
    name = F.lower(F.regexp_extract("path", r"([^/]*)$", 1))
    kept = paths.filter(~name.contains("climatology") & ~name.contains("median"))
    return kept.select("path", raster_period(F.regexp_replace("path", "ndvi_anomaly_", "ndvi_"), aoi).alias("period")).filter("period <> ''")
