"""Pixel climatologies and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.periods import is_month, is_quarter, period_of_year
from gridloom.functions.spectral import anomaly


def pixel_climatology(composites: DataFrame) -> DataFrame:
    """composites (period, row, col, ndvi): the median over years of each cell and period of the year."""
    known = composites.filter("ndvi IS NOT NULL").withColumn("poy", period_of_year(F.col("period")))
    return known.groupBy("poy", "row", "col").agg(F.median("ndvi").alias("climatology"), F.countDistinct(F.substring("period", 1, 4)).alias("years"))


def anomalies(composites: DataFrame, climatology: DataFrame | None = None) -> DataFrame:
    """Each composite less its climatology; a period of the year without one is skipped."""
    clim = climatology if climatology is not None else pixel_climatology(composites)
    own = composites.withColumn("poy", period_of_year(F.col("period")))
    return own.join(clim.select("poy", "row", "col", "climatology"), ["poy", "row", "col"]).select("period", "row", "col", anomaly(F.col("ndvi"), F.col("climatology")).alias("anomaly"))


def anomalies_of_both_kinds(composites: DataFrame) -> DataFrame:
    """Months against months and quarters against quarters, in one table."""
    return anomalies(composites.filter(is_month(F.col("period")))).unionByName(anomalies(composites.filter(is_quarter(F.col("period")))))
