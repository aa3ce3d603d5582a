"""Queries of rasters: index, mosaics, downsampling, composites, statistics, anomalies and features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import grid, periods, spectral
from gridloom.operators import anomaly, composite, downsample, features, footprints, mosaic, stats
from gridloom.plans.inputs import OBS, ORD, composites_of_orders, indexed, monthly, observations, quarterly, r6, table
from gridloom.plans.registry import query

CELL = 'r::INTEGER AS "row", c::INTEGER AS col'


def _six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})


# ---- index and masks -------------------------------------------------------------------------------------------------


@query("ndvi", OBS + " SELECT o1 AS l_orderkey, o2 AS l_linenumber, round(CASE WHEN nir + red <> 0 THEN greatest(-1, least(1, (nir - red) / (nir + red))) END, 6) + 0.0 AS ndvi FROM obs")
def ndvi(spark, d):
    return observations(spark, d).select("tile_ord.*", r6(spectral.index(F.col("nir"), F.col("red"))).alias("ndvi"))


@query("cloud_mask", OBS + " SELECT scl, count(*) AS n, count(*) FILTER (WHERE scl IN (0, 3, 8, 9, 10)) AS hidden FROM obs GROUP BY scl")
def cloud_mask(spark, d):
    return observations(spark, d).groupBy("scl").agg(F.count(F.lit(1)).alias("n"), F.count_if(spectral.hidden(F.col("scl"))).alias("hidden"))


@query("nodata_round_trip", OBS + " SELECT count(*) AS n, count(*) FILTER (WHERE ndvi IS NULL) AS missing, count(ndvi) AS back FROM idx")
def nodata_round_trip(spark, d):
    disk = indexed(spark, d).select(spectral.to_nodata(F.col("ndvi")).alias("v"))
    return disk.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == spectral.NODATA).alias("missing"), F.count(spectral.from_nodata(F.col("v"))).alias("back"))


@query(
    "band_pivot",
    """SELECT l_orderkey AS scene, max(l_discount) AS red, max(l_tax) AS nir, max(l_quantity) FILTER (WHERE l_linenumber = 2) AS scl FROM lineitem WHERE l_linenumber <= 2 GROUP BY l_orderkey HAVING max(l_discount) FILTER (WHERE l_linenumber = 1) IS NOT NULL""".replace("max(l_discount) AS red", "max(l_discount) FILTER (WHERE l_linenumber = 1) AS red").replace("max(l_tax) AS nir", "max(l_tax) FILTER (WHERE l_linenumber = 1) AS nir"),
)
def band_pivot(spark, d):
    """Lines as bands: the first holds B04 and B08, the second SCL, the others bands that the pivot has to ignore."""
    lines = table(spark, d, "lineitem")
    bands = F.when(F.col("l_linenumber") == 1, F.array(F.struct(F.lit("B04").alias("band"), F.col("l_discount").alias("value")), F.struct(F.lit("B08").alias("band"), F.col("l_tax").alias("value")))).otherwise(F.array(F.struct(F.when(F.col("l_linenumber") == 2, "SCL").otherwise(F.concat(F.lit("L"), F.col("l_linenumber").cast("string"))).alias("band"), F.col("l_quantity").alias("value"))))
    pixels = lines.select(F.col("l_orderkey").alias("scene"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.inline(bands))
    return composite.pivot_bands(pixels, {"red": "B04", "nir": "B08", "scl": "SCL"}).select("scene", "red", "nir", "scl")


# ---- mosaics ---------------------------------------------------------------------------------------------------------


def _mosaic(method: str, expression: str) -> None:
    cast = "::BIGINT" if method == "count" else ""

    @query(f"mosaic_{method}", OBS + f" SELECT {CELL}, {expression}{cast} AS value FROM (SELECT *, red AS v FROM obs WHERE scl <> 3) GROUP BY r, c")
    def run(spark, d):
        pixels = observations(spark, d).withColumn("value", F.when(F.col("scl") != 3, F.col("red")))
        out = mosaic.mosaic(pixels, method)
        return out if method in ("first", "last", "min", "max", "count") else _six(out, "value")


for _method, _expression in {
    "first": "arg_min(v, (o1, o2))",
    "last": "arg_max(v, (o1, o2))",
    "min": "min(v)",
    "max": "max(v)",
    "sum": "round(sum(v), 6) + 0.0",
    "count": "count(v)",
}.items():
    _mosaic(_method, _expression)


# ---- downsampling: parts as a raster of classes and prices --------------------------------------------------------------

PIX = """
WITH px AS (SELECT p_partkey // 40 AS r, p_partkey % 40 AS c, p_retailprice AS v, p_size % 6 AS k FROM part WHERE p_partkey < 1600),
blocks AS (SELECT r // 3 AS r, c // 3 AS c, v, k FROM px WHERE r < (SELECT (max(r) + 1) // 3 * 3 FROM px) AND c < 39)"""


def _pixels(spark, d, value: Column) -> tuple[DataFrame, int]:
    part = table(spark, d, "part")
    at = F.col("p_partkey")
    pixels = part.select(F.floor(at / 40).cast("int").alias("row"), (at % 40).cast("int").alias("col"), value.alias("value"))
    return pixels, pixels.agg(F.max("row")).first()[0] + 1


@query("down_mean", PIX + f" SELECT {CELL}, round(avg(v), 6) + 0.0 AS value FROM blocks GROUP BY r, c")
def down_mean(spark, d):
    return _six(downsample.block_mean(*_args(_pixels(spark, d, F.col("p_retailprice")))), "value")


@query("down_median", PIX + f" SELECT {CELL}, round(median(v), 6) + 0.0 AS value FROM blocks GROUP BY r, c")
def down_median(spark, d):
    return _six(downsample.block_median(*_args(_pixels(spark, d, F.col("p_retailprice")))), "value")


@query(
    "down_mode",
    PIX
    + f""", n AS (SELECT r, c, k, count(*) AS n FROM blocks WHERE k <> 0 GROUP BY ALL), best AS (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY n DESC, k) AS nth FROM n)
SELECT b.r::INTEGER AS "row", b.c::INTEGER AS col, coalesce(best.k, 0)::INTEGER AS value FROM (SELECT DISTINCT r, c FROM blocks) b LEFT JOIN best ON best.r = b.r AND best.c = b.c AND nth = 1""",
)
def down_mode(spark, d):
    return downsample.block_mode(*_args(_pixels(spark, d, (F.col("p_size") % 6).cast("int"))))


@query("down_nearest", PIX + ' SELECT (r // 3)::INTEGER AS "row", (c // 3)::INTEGER AS col, v AS value FROM px WHERE r % 3 = 0 AND c % 3 = 0 AND c < 39 AND r < (SELECT (max(r) + 1) // 3 * 3 FROM px)')
def down_nearest(spark, d):
    return downsample.block_nearest(*_args(_pixels(spark, d, F.col("p_retailprice"))))


@query(
    "overview",
    PIX
    + ' , s AS (SELECT max(r) + 1 AS h FROM px), l AS (SELECT unnest([2, 4, 8, 16]) AS level) SELECT level::INTEGER AS level, (r // level)::INTEGER AS "row", (c // level)::INTEGER AS col, v AS value FROM px, l, s WHERE least(h, 40) // level >= 1 AND r % level = 0 AND c % level = 0 AND r < h // level * level AND c < 40 // level * level',
)
def overview(spark, d):
    pixels, height = _pixels(spark, d, F.col("p_retailprice"))
    return downsample.overviews(pixels, (2, 4, 8, 16), height, 40)


def _args(made: tuple[DataFrame, int]) -> tuple[DataFrame, int, int, int]:
    return made[0], 3, made[1], 40


# ---- composites --------------------------------------------------------------------------------------------------------


@query("composite_month", OBS + f" SELECT period, {CELL}, round(ndvi, 6) + 0.0 AS ndvi FROM mon")
def composite_month(spark, d):
    return _six(monthly(spark, d), "ndvi")


@query("composite_quarter", OBS + f" SELECT period, {CELL}, round(ndvi, 6) + 0.0 AS ndvi FROM qua")
def composite_quarter(spark, d):
    return _six(quarterly(spark, d), "ndvi")


@query("composite_timestamp", OBS + f" SELECT acq::VARCHAR AS period, {CELL}, round(median(ndvi), 6) + 0.0 AS ndvi FROM idx WHERE ndvi IS NOT NULL GROUP BY ALL")
def composite_timestamp(spark, d):
    return _six(composite.composite_by_timestamp(indexed(spark, d)), "ndvi")


JOBS = """, sc AS (SELECT DISTINCT acq, strftime(acq, '%Y-%m') AS m, year(acq) || '-Q' || quarter(acq) AS q FROM idx),
cnt AS (SELECT *, count(*) OVER (PARTITION BY m) AS n FROM sc),
jobs AS (SELECT acq, m AS period FROM cnt WHERE n >= 31 UNION ALL SELECT acq, q FROM cnt WHERE q IN (SELECT q FROM cnt WHERE n < 31))"""


@query("composite_quarter_fallback", OBS + JOBS + f" SELECT period, {CELL}, round(median(ndvi), 6) + 0.0 AS ndvi FROM idx JOIN jobs USING (acq) WHERE ndvi IS NOT NULL GROUP BY ALL")
def composite_quarter_fallback(spark, d):
    return _six(composite.composite_with_fallback(indexed(spark, d), 31), "ndvi")


@query("composite_cap", OBS + " SELECT period, scene FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY scene) AS nth FROM (SELECT DISTINCT strftime(acq, '%Y-%m') AS period, acq::VARCHAR AS scene FROM obs)) WHERE nth <= 5")
def composite_cap(spark, d):
    scenes = observations(spark, d).select(periods.month_label(F.col("acq")).alias("period"), F.col("acq").cast("string").alias("scene")).distinct()
    return composite.cap_scenes(scenes, 5)


@query("composite_stats", OBS + " SELECT period, round(min(ndvi), 6) + 0.0 AS ndvi_min, round(max(ndvi), 6) + 0.0 AS ndvi_max, round(count(*) FILTER (WHERE ndvi < 0) / count(ndvi), 6) + 0.0 AS ndvi_share_negative FROM mon GROUP BY period")
def composite_stats(spark, d):
    return _six(composite.composite_stats(monthly(spark, d)), "ndvi_min", "ndvi_max", "ndvi_share_negative")


@query("composite_inside", OBS + f" SELECT period, {CELL}, round(ndvi, 6) + 0.0 AS ndvi FROM mon WHERE (r - c) % 2 = 0")
def composite_inside(spark, d):
    cells = table(spark, d, "supplier").select(F.floor(F.col("s_suppkey") / 10).cast("int").alias("row"), (F.col("s_suppkey") % 10).cast("int").alias("col")).filter("(row - col) % 2 = 0")
    return _six(composite.composite(composite.inside(indexed(spark, d), cells), periods.month_label(F.col("acq"))), "ndvi")


# ---- statistics and series ---------------------------------------------------------------------------------------------


@query(
    "period_stats",
    ORD
    + """ SELECT aoi_id, period, round(avg(ndvi), 4) + 0.0 AS mean_ndvi, round(median(ndvi), 4) + 0.0 AS median_ndvi, round(quantile_cont(ndvi, 0.1), 4) + 0.0 AS p10_ndvi, round(quantile_cont(ndvi, 0.9), 4) + 0.0 AS p90_ndvi,
round(stddev_pop(ndvi), 4) + 0.0 AS std_ndvi, round(count(ndvi) / count(*), 6) + 0.0 AS valid_pixel_ratio, count(ndvi) AS count_valid_pixels, count(*) AS count_total_pixels FROM com GROUP BY ALL""",
)
def period_stats(spark, d):
    made = stats.period_stats(composites_of_orders(spark, d).select("aoi_id", "period", "ndvi"))
    return made.withColumns({c: F.round(c, 4) + 0.0 for c in ("mean_ndvi", "median_ndvi", "p10_ndvi", "p90_ndvi", "std_ndvi")}).withColumn("valid_pixel_ratio", r6(F.col("valid_pixel_ratio")))


def _stats_of_orders(spark, d) -> tuple[DataFrame, DataFrame]:
    made = composites_of_orders(spark, d)
    kept = ["aoi_id", "period", "mean_ndvi", "median_ndvi"]
    return stats.period_stats(made.select("aoi_id", "period", "ndvi")).select(*kept), stats.period_stats(made.select("aoi_id", F.col("quarter").alias("period"), "ndvi")).select(*kept)


_SERIES = "round(mean_ndvi, 4) + 0.0 AS mean_ndvi, round(median_ndvi, 4) + 0.0 AS median_ndvi"


@query(
    "series_quarter_fill",
    ORD
    + f""", kept AS (SELECT * FROM ms WHERE period NOT LIKE '%-02' AND period NOT LIKE '%-07'),
cal AS (SELECT aoi_id, unnest(generate_series(min(period || '-01')::DATE, max(period || '-01')::DATE, INTERVAL 1 MONTH))::DATE AS time FROM kept GROUP BY aoi_id),
filled AS (SELECT cal.aoi_id, time, coalesce(kept.mean_ndvi, qs.mean_ndvi) AS mean_ndvi, coalesce(kept.median_ndvi, qs.median_ndvi) AS median_ndvi FROM cal LEFT JOIN kept ON kept.aoi_id = cal.aoi_id AND kept.period = strftime(time, '%Y-%m') LEFT JOIN qs ON qs.aoi_id = cal.aoi_id AND qs.period = year(time) || '-Q' || quarter(time))
SELECT aoi_id, time::VARCHAR AS time, {_SERIES} FROM filled WHERE mean_ndvi IS NOT NULL AND median_ndvi IS NOT NULL""",
)
def series_quarter_fill(spark, d):
    months, quarters = _stats_of_orders(spark, d)
    kept = months.filter("period NOT LIKE '%-02' AND period NOT LIKE '%-07'")
    return _four(stats.filled_series(kept.unionByName(quarters)))


def _four(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) + 0.0 for c in ("mean_ndvi", "median_ndvi")})


@query("series_quarterly", ORD + f" SELECT aoi_id, make_date(left(period, 4)::INT, 3 * right(period, 1)::INT - 2, 1)::VARCHAR AS time, {_SERIES} FROM qs WHERE mean_ndvi IS NOT NULL")
def series_quarterly(spark, d):
    return _four(stats.quarterly_series(_stats_of_orders(spark, d)[1]))


def _clim(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) + 0.0 for c in ("mean_ndvi_clim", "median_ndvi_clim")})


_CLIM = "round(avg(mean_ndvi), 4) + 0.0 AS mean_ndvi_clim, round(median(median_ndvi), 4) + 0.0 AS median_ndvi_clim, count(*) AS n_periods"


@query("clim_month", ORD + f" SELECT right(period, 2)::INTEGER AS month_of_year, {_CLIM}, strftime(make_date(2000, right(period, 2)::INTEGER, 1), '%b') AS label FROM ms GROUP BY ALL")
def clim_month(spark, d):
    return _clim(stats.climatology_by_month(_stats_of_orders(spark, d)[0]))


@query("clim_quarter", ORD + f" SELECT right(period, 1)::INTEGER AS quarter_of_year, {_CLIM}, 'Q' || right(period, 1) AS label FROM qs GROUP BY ALL")
def clim_quarter(spark, d):
    return _clim(stats.climatology_by_quarter(_stats_of_orders(spark, d)[1]))


@query("clim_table", ORD + f" SELECT right(period, 2)::INTEGER AS month_of_year, {_CLIM}, strftime(make_date(2000, right(period, 2)::INTEGER, 1), '%b') AS label FROM ms GROUP BY ALL")
def clim_table(spark, d):
    months, quarters = _stats_of_orders(spark, d)
    return _clim(stats.climatology(months.unionByName(quarters)))


@query("stretch_p2_p98", OBS + " SELECT round(quantile_cont(ndvi, 0.02), 6) + 0.0 AS low, round(quantile_cont(ndvi, 0.98), 6) + 0.0 AS high FROM idx")
def stretch_p2_p98(spark, d):
    return _six(stats.stretch(indexed(spark, d), "ndvi"), "low", "high")


# ---- climatologies and anomalies ---------------------------------------------------------------------------------------

_AN = """, {n}c AS (SELECT substr(period, 6, 2) AS poy, r, c, median(ndvi) AS clim, count(DISTINCT left(period, 4)) AS years FROM {n} GROUP BY ALL),
{n}a AS (SELECT period, r, c, ndvi - clim AS anomaly FROM {n} JOIN {n}c USING (r, c) WHERE substr(period, 6, 2) = poy)"""
AN = _AN.format(n="mon") + _AN.format(n="qua")


@query("pixel_clim", OBS + AN + f" SELECT poy, {CELL}, round(clim, 6) + 0.0 AS climatology, years FROM monc")
def pixel_clim(spark, d):
    return _six(anomaly.pixel_climatology(monthly(spark, d)), "climatology")


@query("anomaly_month", OBS + AN + f" SELECT period, {CELL}, round(anomaly, 6) + 0.0 AS anomaly FROM mona")
def anomaly_month(spark, d):
    return _six(anomaly.anomalies(monthly(spark, d)), "anomaly")


@query("anomaly_quarter", OBS + AN + f" SELECT period, {CELL}, round(anomaly, 6) + 0.0 AS anomaly FROM quaa")
def anomaly_quarter(spark, d):
    return _six(anomaly.anomalies(quarterly(spark, d)), "anomaly")


@query("anomaly_both", OBS + AN + f" SELECT period, {CELL}, round(anomaly, 6) + 0.0 AS anomaly FROM (SELECT * FROM mona UNION ALL SELECT * FROM quaa)")
def anomaly_both(spark, d):
    return _six(anomaly.anomalies_of_both_kinds(monthly(spark, d).unionByName(quarterly(spark, d))), "anomaly")


# ---- temporal features ---------------------------------------------------------------------------------------------------

FT = """, slots AS (SELECT period, (row_number() OVER (ORDER BY period) - 1) AS t, make_date(left(period, 4)::INT, right(period, 2)::INT, 15) AS mid FROM (SELECT DISTINCT period FROM mon)),
ax AS (SELECT count(*) AS n, avg(t) AS tb, var_pop(t) * count(*) AS den, greatest(1, least(count(*) // 2, 2 * greatest(1, round_even(count(*) * 365.25 / (max(mid) - min(mid) + 1), 0)::BIGINT))) AS w FROM slots),
st AS (SELECT r, c, t, month(mid) AS m, ndvi AS x FROM mon JOIN slots USING (period)),
an AS (SELECT *, avg(x) OVER (PARTITION BY r, c) AS mu, x - avg(x) OVER (PARTITION BY r, c, m) AS a FROM st),
ft AS (SELECT r, c, sum((t - tb) * (x - mu)) / any_value(den) AS trend_slope, stddev_pop(a) AS seasonal_std, min(a) AS min_anomaly,
 CASE WHEN avg(x) FILTER (WHERE t < w) <> 0 THEN avg(x) FILTER (WHERE t >= n - w) / avg(x) FILTER (WHERE t < w) END AS recovery_ratio,
 count(*) FILTER (WHERE a < -0.2) AS anomaly_persistence, var_pop(x) AS ndvi_variance, CASE WHEN var_pop(x) > 1e-20 THEN avg(pow(x - mu, 3)) / pow(var_pop(x), 1.5) END AS ndvi_skew FROM an, ax GROUP BY r, c)"""
FT_OUT = {f: ("anomaly_persistence" if f == "anomaly_persistence" else f"round({f}, 6) + 0.0 AS {f}") for f in features.FEATURES}


def _features(spark, d) -> DataFrame:
    made = monthly(spark, d)
    slots, axis = features.slots_of(made)
    stack = made.join(slots, "period").withColumnRenamed("ndvi", "x")
    out = features.pixel_features(stack, axis)
    return out.withColumns({f: r6(F.col(f)) for f in features.FEATURES if f != "anomaly_persistence"})


def _feature(name: str) -> None:
    short = name.replace("ndvi_", "").replace("trend_", "").replace("_ratio", "").replace("anomaly_persistence", "persistence")

    @query(f"feat_{short}", OBS + FT + f" SELECT {CELL}, {FT_OUT[name]} FROM ft")
    def run(spark, d):
        return _features(spark, d).select("row", "col", name)


for _name in features.FEATURES:
    _feature(_name)


@query("features_7d", OBS + FT + f" SELECT {CELL}, {', '.join(FT_OUT.values())} FROM ft")
def features_7d(spark, d):
    return _features(spark, d)


@query("deseasonalise", OBS + FT + f" SELECT {CELL}, t::INTEGER AS t, round(a, 6) + 0.0 AS an FROM an")
def deseasonalise(spark, d):
    from pyspark.sql import Window

    made = monthly(spark, d)
    slots, _ = features.slots_of(made)
    own = Window.partitionBy("row", "col", F.month("mid"))
    return made.join(slots, "period").select("row", "col", "t", r6(F.col("ndvi") - F.avg("ndvi").over(own)).alias("an"))


@query("zonal_features", OBS + FT + ' SELECT s_nationkey AS label, count(*) AS cells, round(avg(seasonal_std), 6) + 0.0 AS seasonal_std, round(avg(ndvi_variance), 6) + 0.0 AS ndvi_variance FROM ft JOIN supplier ON r = s_suppkey // 10 AND c = s_suppkey % 10 GROUP BY s_nationkey')
def zonal_features(spark, d):
    zones = table(spark, d, "supplier").select(F.col("s_nationkey").alias("label"), F.floor(F.col("s_suppkey") / 10).cast("int").alias("row"), (F.col("s_suppkey") % 10).cast("int").alias("col"))
    made = monthly(spark, d)
    slots, axis = features.slots_of(made)
    raw = features.pixel_features(made.join(slots, "period").withColumnRenamed("ndvi", "x"), axis)
    return _six(features.zonal_means(raw, zones, ["seasonal_std", "ndvi_variance"]), "seasonal_std", "ndvi_variance")


@query(
    "embedding_stack",
    """WITH st AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS t, len(embedding) AS n FROM embeddings)
SELECT vec_id, round(sum((t - (n - 1) / 2) * x) / any_value(n * (n * n - 1) / 12), 5) + 0.0 AS trend_slope, round(var_pop(x::DOUBLE), 5) + 0.0 AS ndvi_variance FROM st GROUP BY vec_id""",
)
def embedding_stack(spark, d):
    """Dense stacks: each vector is a cell, each place a slot."""
    rows = table(spark, d, "embeddings").select("vec_id", F.size("embedding").alias("n"), F.posexplode("embedding").alias("t", "x")).withColumn("x", F.col("x").cast("double"))
    slope = F.sum((F.col("t") - (F.col("n") - 1) / 2) * F.col("x")) / F.max(F.col("n") * (F.col("n") * F.col("n") - 1) / 12)
    return rows.groupBy("vec_id").agg((F.round(slope, 5) + 0.0).alias("trend_slope"), (F.round(F.var_pop("x"), 5) + 0.0).alias("ndvi_variance"))


# ---- grids ---------------------------------------------------------------------------------------------------------------

RING = np.array([[0.0, 0.0], [90.0, 0.0], [90.0, 40.0], [50.0, 40.0], [50.0, 80.0], [0.0, 80.0]])


@query(
    "aoi_cells",
    """WITH g AS (SELECT r, c, (c + 0.5) * 10.0 AS x, 80 - (r + 0.5) * 10.0 AS y FROM range(8) a(r), range(9) b(c))
SELECT r::INTEGER AS "row", c::INTEGER AS col FROM g WHERE (x < 90 AND y < 40) OR (x < 50 AND y < 80)""",
)
def aoi_cells(spark, d):
    return grid.cells_inside(spark, grid.Grid.around(RING, 10.0), RING)


@query("target_grid", "SELECT 0.0::DOUBLE AS x0, 80.0::DOUBLE AS y0, 10.0::DOUBLE AS cell, 9 AS width, 8 AS height")
def target_grid(spark, d):
    made = grid.Grid.around(RING, 10.0)
    return spark.range(1).select(F.lit(made.x0).alias("x0"), F.lit(made.y0).alias("y0"), F.lit(made.cell).alias("cell"), F.lit(made.width).alias("width"), F.lit(made.height).alias("height"))


@query(
    "reproject_nearest",
    OBS
    + """, px AS (SELECT r, c, max(red) AS v FROM obs WHERE r < 10 GROUP BY r, c), g AS (SELECT r, c, (c + 0.5) * 5.0 AS x, 100 - (r + 0.5) * 5.0 AS y FROM range(20) a(r), range(20) b(c))
SELECT 'a' AS layer_id, g.r::INTEGER AS "row", g.c::INTEGER AS col, v AS value FROM g JOIN px ON px.r = floor((100 - y) / 10) AND px.c = floor(x / 10)""",
)
def reproject_nearest(spark, d):
    """All cells of the source, 10 wide, onto a grid of cells 5 wide over the source's extent."""
    pixels = observations(spark, d).groupBy("row", "col").agg(F.max("red").alias("value")).withColumn("layer_id", F.lit("a"))
    last = pixels.agg(F.max("row"), F.max("col")).first()
    rows, cols = (0 if n is None else n + 1 for n in last)
    target = grid.Grid(0.0, rows * 10.0, 5.0, cols * 2, rows * 2)
    layers = spark.range(1).select(F.lit("a").alias("layer_id"), F.lit(0.0).alias("x0"), F.lit(target.y0).alias("y0"), F.lit(10.0).alias("dx"), F.lit(10.0).alias("dy"))
    cells = spark.range(target.height * target.width).select(F.floor(F.col("id") / target.width).cast("int").alias("row"), (F.col("id") % target.width).cast("int").alias("col"))
    return grid.reproject_nearest(cells, layers, pixels, target)


@query("aoi_window", OBS + f" SELECT DISTINCT {CELL} FROM obs WHERE r BETWEEN 2 AND 5 AND c BETWEEN 1 AND 6")
def aoi_window(spark, d):
    window = grid.Grid(0.0, 100.0, 10.0, 10, 10).window(np.array([[10.0, 40.0], [70.0, 80.0]]))
    return observations(spark, d).filter(grid.in_window(window)).select("row", "col").distinct()


# ---- metadata, layers and footprints -----------------------------------------------------------------------------------


@query(
    "composite_metadata",
    OBS + """, used AS (SELECT strftime(acq, '%Y-%m') AS label, string_agg(DISTINCT acq::VARCHAR, '|' ORDER BY acq::VARCHAR) AS folders, count(DISTINCT acq)::INTEGER AS scenes_used FROM idx GROUP BY ALL)
SELECT label, folders, scenes_used, round(min(ndvi), 6) + 0.0 AS ndvi_min, round(max(ndvi), 6) + 0.0 AS ndvi_max FROM used LEFT JOIN mon ON period = label GROUP BY ALL""",
)
def composite_metadata(spark, d):
    jobs = indexed(spark, d).select("acq", periods.month_label(F.col("acq")).alias("period"))
    made = composite.composite_metadata(jobs, monthly(spark, d), "grid")
    return _six(made.select("label", F.array_join("folders", "|").alias("folders"), "scenes_used", "ndvi_min", "ndvi_max"), "ndvi_min", "ndvi_max")


@query("layers_scaled", "SELECT s_suppkey AS layer_id, 30.0::DOUBLE AS dx, 30.0::DOUBLE AS dy, ((s_suppkey + 10) // 3)::INTEGER AS width, 33 AS height FROM supplier")
def layers_scaled(spark, d):
    layers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("layer_id"), F.lit(10.0).alias("dx"), F.lit(10.0).alias("dy"), (F.col("s_suppkey") + 10).cast("int").alias("width"), F.lit(100).alias("height"))
    return downsample.scaled(layers, 3)


@query("layers_consistent", "SELECT s_nationkey AS mosaic_id, count(*) AS tiles, 32634 AS epsg FROM supplier GROUP BY s_nationkey")
def layers_consistent(spark, d):
    layers = table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("mosaic_id"), F.col("s_suppkey").alias("tile_ord"), F.lit("float32").alias("dtype"), F.lit(32634).alias("epsg"))
    return mosaic.consistent(layers).withColumn("mosaic_id", F.col("mosaic_id").cast("int"))


BOXES = """WITH f AS (SELECT s_suppkey AS id, s_nationkey AS k, s_acctbal AS cloud, (s_suppkey % 10) * 10.0 AS x, (s_suppkey // 10) * 10.0 AS y FROM supplier),
o AS (SELECT *, greatest(0, least(x + 15, 72) - greatest(x, 5)) * greatest(0, least(y + 15, 58) - greatest(y, 5)) / (67 * 53) AS frac FROM f)"""


def _footprints(spark, d) -> DataFrame:
    x, y = F.col("s_suppkey") % 10 * 10.0, F.floor(F.col("s_suppkey") / 10) * 10.0
    corner = lambda a, b: F.struct((x + a).alias("x"), (y + b).alias("y"))
    ring = F.array(corner(0.0, 0.0), corner(15.0, 0.0), corner(15.0, 15.0), corner(0.0, 15.0))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("acq_ts"), F.col("s_acctbal").alias("cloud"), F.array(ring).alias("rings"))


AREA = np.array([[5.0, 5.0], [72.0, 5.0], [72.0, 58.0], [5.0, 58.0]])


@query("footprint_overlap", BOXES + " SELECT id, round(frac, 9) + 0.0 AS coverage_frac FROM o WHERE frac >= 1e-6")
def footprint_overlap(spark, d):
    return footprints.overlaps(_footprints(spark, d), AREA).select("id", (F.round("coverage_frac", 9) + 0.0).alias("coverage_frac"))


@query(
    "footprint_union",
    BOXES
    + """, cut AS (SELECT * FROM o WHERE frac >= 1e-6), cells AS (SELECT a + 0.5 AS px, b + 0.5 AS py FROM range(5, 72) t(a), range(5, 58) u(b)),
area AS (SELECT k, count(DISTINCT (px, py)) / (67 * 53) AS c FROM cut JOIN cells ON px > x AND px < x + 15 AND py > y AND py < y + 15 GROUP BY k)
SELECT k AS acq, round(any_value(c), 9) + 0.0 AS coverage_frac, count(*) AS tiles_count, min(cloud) AS min_cloud, max(cloud) AS max_cloud FROM cut JOIN area USING (k) GROUP BY k""",
)
def footprint_union(spark, d):
    made = footprints.union_coverage(footprints.overlaps(_footprints(spark, d), AREA), AREA, 0.5)
    return made.select(F.col("acq_ts").alias("acq"), (F.round("coverage_frac", 9) + 0.0).alias("coverage_frac"), F.col("tiles_count").cast("long").alias("tiles_count"), "min_cloud", "max_cloud")
