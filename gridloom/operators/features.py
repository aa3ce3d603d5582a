"""Seven temporal features per cell, from a stack of layers with global time slots."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.periods import period_mid

FEATURES = ["trend_slope", "seasonal_std", "min_anomaly", "recovery_ratio", "anomaly_persistence", "ndvi_variance", "ndvi_skew"]
#: Fixed value: how far below its month's mean a value counts as a persistent anomaly.
PERSISTENT = -0.2
#: Means of doubles err by far less. An anomaly so near PERSISTENT ties with it, and a tie is not below, however it was rounded.
TIE = 1e-12


@dataclass(frozen=True)
class TimeAxis:
    """All slots of a stack, whether or not a cell has a value there."""

    dates: tuple[date, ...]

    @property
    def slots(self) -> int:
        return len(self.dates)

    @property
    def mean_slot(self) -> float:
        return (self.slots - 1) / 2

    @property
    def squares(self) -> float:
        return sum((t - self.mean_slot) ** 2 for t in range(self.slots))

    def frame(self, years: int = 2) -> int:
        """How many slots the early and the late mean take."""
        days = (self.dates[-1] - self.dates[0]).days
        per_year = max(1, round(self.slots * 365.25 / (days + 1)))
        return max(1, min(self.slots // 2, years * per_year))


def slots_of(layers: DataFrame) -> tuple[DataFrame, TimeAxis]:
    """layers (period): period, t and mid date of each layer in time order, and the axis. As small as a catalog."""
    rows = layers.select("period").distinct().select("period", period_mid(F.col("period")).alias("mid")).orderBy("mid", "period").collect()
    spark = layers.sparkSession
    table = spark.createDataFrame([(r.period, t, r.mid) for t, r in enumerate(rows)], "period string, t int, mid date")
    return table, TimeAxis(tuple(r.mid for r in rows))


def _ratio(late: Column, early: Column) -> Column:
    """late / early; by zero it is infinite, and missing only for 0 / 0."""
    infinite = F.when(late > 0, F.lit(float("inf"))).when(late < 0, F.lit(float("-inf")))
    return F.when(early != 0, late / early).otherwise(F.when(early == 0, infinite))


def pixel_features(stack: DataFrame, axis: TimeAxis) -> DataFrame:
    """stack (row, col, t, mid, x): a row per cell. One shuffle by cell serves windows and aggregates alike.

    Gaps keep their slots: the slope's mean time and denominator are the axis's, as are the early and late frames. The one
    sort serves all windows and fixes the order in which a cell's values are added, so that runs agree to the last bit.
    """
    cell = Window.partitionBy("row", "col")
    known = stack.filter("x IS NOT NULL").repartition("row", "col").withColumn("month", F.month("mid")).sortWithinPartitions("row", "col", "month", "t")
    known = known.withColumn("mu", F.avg("x").over(cell)).withColumn("an", F.col("x") - F.avg("x").over(Window.partitionBy("row", "col", "month")))
    slope = F.sum((F.col("t") - axis.mean_slot) * (F.col("x") - F.col("mu")))
    slope = slope / F.lit(axis.squares) if axis.squares else F.lit(None).cast("double")
    late_early = F.lit(None).cast("double")
    if axis.slots >= 4:
        w = axis.frame()
        late_early = _ratio(F.avg(F.when(F.col("t") >= axis.slots - w, F.col("x"))), F.avg(F.when(F.col("t") < w, F.col("x"))))
    return known.groupBy("row", "col").agg(
        slope.alias("trend_slope"),
        F.stddev_pop("an").alias("seasonal_std"),
        F.min("an").alias("min_anomaly"),
        late_early.alias("recovery_ratio"),
        F.count_if(F.col("an") < PERSISTENT - TIE).alias("anomaly_persistence"),
        F.var_pop("x").alias("ndvi_variance"),
        F.skewness("x").alias("ndvi_skew"),
    )


def zonal_means(features: DataFrame, zones: DataFrame, columns: list[str]) -> DataFrame:
    """Means of features over the cells of each zone (label, row, col), and how many cells it has."""
    joined = zones.join(features, ["row", "col"])
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("cells"), *(F.avg(c).alias(c) for c in columns))
