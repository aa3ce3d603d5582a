"""The grouped aggregates over unbounded input: coverage per timestamp and composites per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.periods import month_label
from gridloom.operators.composite import composite


def windowed_coverage(tiles: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """A stream of tiles (acq_ts, tile, cloud): tumbling windows with counts and the cloud's range; late rows count
    while the watermark lets them."""
    grouped = tiles.withWatermark("acq_ts", late).groupBy(F.window("acq_ts", window).alias("w"))
    stats = grouped.agg(F.count(F.lit(1)).alias("tiles_count"), F.min("cloud").alias("min_cloud"), F.max("cloud").alias("max_cloud"))
    return stats.select(F.col("w.start").alias("start"), "tiles_count", "min_cloud", "max_cloud")


def recompute_touched(batch: DataFrame, store: str, composites: str) -> None:
    """For foreachBatch: adds observations (acq, row, col, ndvi) to the store, and writes the composites of the months
    they touch anew, as an exact median can't be kept up by increments."""
    spark = batch.sparkSession
    own = batch.withColumn("period", month_label(F.col("acq"))).persist()
    own.write.mode("append").partitionBy("period").parquet(store)
    touched = own.select("period").distinct()
    whole = spark.read.schema(own.schema).parquet(store).join(touched, "period", "left_semi")
    made = composite(whole.drop("period"), month_label(F.col("acq")))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(composites)
    own.unpersist()
