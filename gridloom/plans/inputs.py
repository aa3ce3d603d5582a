"""How the driver's tables stand in for rasters, catalogs and regions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.periods import midpoint_anchors, month_label, quarter_label
from gridloom.operators.composite import composite, observations_to_index

THRESHOLD, WINDOW_DAYS = 0.9, 5
ANCHORS = midpoint_anchors(date(2024, 1, 1), date(2024, 1, 30), 6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column) -> Column:
    """Six digits, and no negative zero."""
    return F.round(value, 6) + F.lit(0.0)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations of a grid: a supplier is a cell, discount and tax are the bands."""
    return table(spark, sf_dir, "lineitem").select(
        F.floor(F.col("l_suppkey") / 10).cast("int").alias("row"),
        (F.col("l_suppkey") % 10).cast("int").alias("col"),
        F.to_date("l_shipdate").alias("acq"),
        F.col("l_discount").alias("red"),
        F.col("l_tax").alias("nir"),
        F.col("l_linenumber").alias("scl"),
        F.struct("l_orderkey", "l_linenumber").alias("tile_ord"),
    )


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_to_index(observations(spark, sf_dir))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite(indexed(spark, sf_dir), month_label(F.col("acq")))


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite(indexed(spark, sf_dir), quarter_label(F.col("acq")))


def composites_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as composites' cells: a priority is an area; every fifth order has no value (7.3 keeps means off decimal ties)."""
    value = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 7.3)
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("aoi_id"), month_label(F.to_date("o_orderdate")).alias("period"), quarter_label(F.to_date("o_orderdate")).alias("quarter"), value.alias("ndvi"))


def tile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as tiles: a day's events of one type are a tile, users are cells, the mean value is its cloud."""
    day = F.to_timestamp(F.to_date("ts"))
    seen = table(spark, sf_dir, "events").select(day.alias("acq_ts"), F.col("event_type").alias("tile"), F.col("user_id").alias("cell"), "value")
    clouds = seen.groupBy("acq_ts", "tile").agg(F.round(F.avg("value"), 6).alias("cloud"))
    return seen.select("acq_ts", "tile", "cell").distinct().join(clouds, ["acq_ts", "tile"])


def total_cells(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "events").agg(F.countDistinct("user_id")).first()[0]


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("NUTS_ID"), F.col("n_name").alias("NAME_LATN"), (F.col("n_nationkey") % 4).alias("LEVL_CODE"), F.substring(F.upper("r_name"), 1, 2).alias("CNTR_CODE"))


#: The same stand-ins for DuckDB.
OBS = """
WITH obs AS (
  SELECT l_suppkey // 10 AS r, l_suppkey % 10 AS c, l_shipdate::DATE AS acq, l_discount AS red, l_tax AS nir, l_linenumber AS scl, l_orderkey AS o1, l_linenumber AS o2 FROM lineitem
), idx AS (
  SELECT r, c, acq, CASE WHEN scl IN (0, 3, 8, 9, 10) THEN NULL WHEN nir + red <> 0 THEN greatest(-1, least(1, (nir - red) / (nir + red))) END AS ndvi FROM obs
), mon AS (
  SELECT strftime(acq, '%Y-%m') AS period, r, c, median(ndvi) AS ndvi FROM idx WHERE ndvi IS NOT NULL GROUP BY ALL
), qua AS (
  SELECT year(acq) || '-Q' || quarter(acq) AS period, r, c, median(ndvi) AS ndvi FROM idx WHERE ndvi IS NOT NULL GROUP BY ALL
)"""
ORD = """
WITH com AS (
  SELECT o_orderpriority AS aoi_id, strftime(o_orderdate, '%Y-%m') AS period, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice / 7.3 END AS ndvi FROM orders
), ms AS (
  SELECT aoi_id, period, avg(ndvi) AS mean_ndvi, median(ndvi) AS median_ndvi FROM com GROUP BY ALL
), qs AS (
  SELECT aoi_id, quarter AS period, avg(ndvi) AS mean_ndvi, median(ndvi) AS median_ndvi FROM com GROUP BY ALL
)"""
EVT = """
WITH seen AS (
  SELECT date_trunc('day', ts)::DATE AS acq, event_type AS tile, user_id AS cell, value FROM events
), clouds AS (
  SELECT acq, tile, round(avg(value), 6) AS cloud FROM seen GROUP BY ALL
), tc AS (
  SELECT DISTINCT acq, tile, cell, cloud FROM seen JOIN clouds USING (acq, tile)
), total AS (
  SELECT count(DISTINCT user_id) AS n FROM events
), cov AS (
  SELECT acq, count(DISTINCT cell) / (SELECT n FROM total) AS coverage_frac, count(DISTINCT tile) AS tiles_count, min(cloud) AS min_cloud, max(cloud) AS max_cloud FROM tc GROUP BY ALL
)"""
ANCHOR_VALUES = ", ".join(f"(DATE '{a}')" for a in ANCHORS)
REG = """
WITH reg AS (
  SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS nuts_id, n_name AS name, n_nationkey % 4 AS level, substr(upper(r_name), 1, 2) AS country FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
