"""Period labels and calendars as column expressions; anchors as driver arithmetic."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The shapes of period labels.
MONTH_PATTERN, QUARTER_PATTERN = r"^\d{4}-\d{2}$", r"^\d{4}-Q[1-4]$"


def month_label(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")


def quarter_label(when: Column) -> Column:
    return F.concat(F.year(when).cast("string"), F.lit("-Q"), F.quarter(when).cast("string"))


def month_to_quarter(label: Column) -> Column:
    """`2021-05` to `2021-Q2`."""
    return quarter_label(F.to_date(F.concat(label, F.lit("-01"))))


def quarter_start(label: Column) -> Column:
    """`2021-Q2` to 2021-04-01."""
    return F.make_date(F.substring(label, 1, 4).cast("int"), 3 * F.substring(label, 7, 1).cast("int") - 2, F.lit(1))


def is_month(label: Column) -> Column:
    return label.rlike(MONTH_PATTERN)


def is_quarter(label: Column) -> Column:
    return label.rlike(QUARTER_PATTERN)


def period_mid(label: Column) -> Column:
    """The 15th of a month, or of a quarter's middle month; any other label raises."""
    month = F.when(is_month(label), F.substring(label, 6, 2).cast("int")).when(is_quarter(label), 3 * F.substring(label, 7, 1).try_cast("int") - 1)
    return F.when(month.isNotNull(), F.make_date(F.substring(label, 1, 4).cast("int"), month, F.lit(15))).otherwise(F.raise_error(F.concat(F.lit("not a period: "), F.coalesce(label, F.lit("null")))).cast("date"))


def period_of_year(label: Column) -> Column:
    """`05` of a month label, `Q2` of a quarter label."""
    return F.substring(label, 6, 2)


def month_name(month: Column) -> Column:
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def month_calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """A row per month from first to last: period, start."""
    bounds = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))).alias("start"))
    return bounds.select(month_label(F.col("start")).alias("period"), "start")


def midpoint_anchors(start: date, end: date, n: int) -> list[date]:
    """n dates, one in the middle of each n-th of the span; distinct while the span allows, else padded with its end."""
    if n <= 0:
        return []
    span = (end - start).days
    if span <= 0:
        return [start] * n
    step = span / n
    chosen = sorted({min(end, max(start, start + timedelta(days=int((i + 0.5) * step)))) for i in range(n)})
    day = start
    while len(chosen) < n and day <= end:
        if day not in chosen:
            chosen.append(day)
        day += timedelta(days=1)
    return sorted(chosen) + [end] * (n - len(chosen))
