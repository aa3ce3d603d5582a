"""Statistics of composites, the monthly series with quarterly fill, and climatology tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.periods import is_month, is_quarter, month_name, month_to_quarter, quarter_start


def period_stats(composites: DataFrame, total_cells: Column | None = None) -> DataFrame:
    """composites (aoi_id, period, ndvi): total_cells is the whole grid's size (cells outside the area count too)."""
    value = F.col("ndvi")
    total = F.count(F.lit(1)) if total_cells is None else F.max(total_cells)
    tails = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9)))
    stats = composites.groupBy("aoi_id", "period").agg(
        F.avg(value).alias("mean_ndvi"),
        F.median(value).alias("median_ndvi"),
        tails.alias("tails"),
        F.stddev_pop(value).alias("std_ndvi"),
        F.count(value).alias("count_valid_pixels"),
        total.cast("long").alias("count_total_pixels"),
    )
    out = ["aoi_id", "period", "mean_ndvi", "median_ndvi", F.col("tails")[0].alias("p10_ndvi"), F.col("tails")[1].alias("p90_ndvi"), "std_ndvi"]
    return stats.select(*out, (F.col("count_valid_pixels") / F.col("count_total_pixels")).alias("valid_pixel_ratio"), "count_valid_pixels", "count_total_pixels")


def filled_series(stats: DataFrame) -> DataFrame:
    """stats (aoi_id, period, mean_ndvi, median_ndvi): every month between an area's first and last, with the quarter's
    numbers where the month's are missing; months that miss either after that are dropped."""
    months = stats.filter(is_month(F.col("period")))
    quarters = stats.filter(is_quarter(F.col("period"))).select("aoi_id", F.col("period").alias("quarter"), F.col("mean_ndvi").alias("q_mean"), F.col("median_ndvi").alias("q_median"))
    start = lambda c: F.to_date(F.concat(c, F.lit("-01")))
    spans = months.groupBy("aoi_id").agg(F.sequence(start(F.min("period")), start(F.max("period")), F.expr("interval 1 month")).alias("months"))
    calendar = spans.select("aoi_id", F.explode("months").alias("time")).withColumn("period", F.date_format("time", "yyyy-MM"))
    joined = calendar.join(months.select("aoi_id", "period", "mean_ndvi", "median_ndvi"), ["aoi_id", "period"], "left")
    joined = joined.withColumn("quarter", month_to_quarter(F.col("period"))).join(quarters, ["aoi_id", "quarter"], "left")
    filled = joined.select("aoi_id", "time", F.coalesce("mean_ndvi", "q_mean").alias("mean_ndvi"), F.coalesce("median_ndvi", "q_median").alias("median_ndvi"))
    return filled.filter("mean_ndvi IS NOT NULL AND median_ndvi IS NOT NULL")


def quarterly_series(stats: DataFrame) -> DataFrame:
    """Where there are no months at all: the quarters at their starts."""
    quarters = stats.filter(is_quarter(F.col("period"))).filter("mean_ndvi IS NOT NULL AND median_ndvi IS NOT NULL")
    return quarters.select("aoi_id", quarter_start(F.col("period")).alias("time"), "mean_ndvi", "median_ndvi")


def climatology_by_month(stats: DataFrame) -> DataFrame:
    months = stats.filter(is_month(F.col("period"))).withColumn("month_of_year", F.substring("period", 6, 2).cast("int"))
    return _climatology(months, "month_of_year").withColumn("label", month_name(F.col("month_of_year")))


def climatology_by_quarter(stats: DataFrame) -> DataFrame:
    quarters = stats.filter(is_quarter(F.col("period"))).withColumn("quarter_of_year", F.substring("period", 7, 1).cast("int"))
    return _climatology(quarters, "quarter_of_year").withColumn("label", F.concat(F.lit("Q"), F.col("quarter_of_year").cast("string")))


def _climatology(stats: DataFrame, key: str) -> DataFrame:
    """Mean of means, median of medians, and all periods counted, missing ones too."""
    return stats.groupBy(key).agg(F.avg("mean_ndvi").alias("mean_ndvi_clim"), F.median("median_ndvi").alias("median_ndvi_clim"), F.count(F.lit(1)).alias("n_periods"))


def climatology(stats: DataFrame) -> DataFrame:
    """By month if there is any month, else by quarter; never both."""
    return climatology_by_quarter(stats) if stats.filter(is_month(F.col("period"))).isEmpty() else climatology_by_month(stats)


def stretch(values: DataFrame, value: str = "value", low: float = 0.02, high: float = 0.98) -> DataFrame:
    """The percentiles between which a viewer stretches colours; (-1, 1) if there are no values."""
    ends = values.agg(F.percentile(F.col(value), F.array(F.lit(low), F.lit(high))).alias("p"))
    return ends.select(F.coalesce(F.col("p")[0], F.lit(-1.0)).alias("low"), F.coalesce(F.col("p")[1], F.lit(1.0)).alias("high"))
