"""Known answers and differential tests of the raster operators."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry, grid, periods, spectral
from gridloom.operators import anomaly, composite, downsample, features, mosaic, stats


def pixels(spark, array, **more):
    rows = [(r, c, None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(np.asarray(array, float))]
    df = spark.createDataFrame(rows, "row int, col int, value double")
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def dense(df, shape, value="value"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[value] is None else r[value]
    return out


@pytest.mark.parametrize("n", [16, 128])
def test_index_inverts_bands(spark, n):
    draw = np.random.default_rng(3)
    v, s = draw.uniform(-0.2, 0.9, (n, n)), draw.uniform(0.2, 0.8, (n, n))
    nir, red = s * (1 + v) / 2, s * (1 - v) / 2
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(nir.ravel(), red.ravel(), strict=True))]
    got = spark.createDataFrame(rows, "i int, nir double, red double").select("i", spectral.index(F.col("nir"), F.col("red")).alias("x")).orderBy("i").toPandas()
    assert np.allclose(got.x.to_numpy().reshape(n, n), v, atol=1e-5)


def test_index_is_missing_without_a_sum(spark):
    df = spark.createDataFrame([(0.0, 0.0), (None, 1.0), (3.0, -1.0)], "nir double, red double")
    assert [r[0] for r in df.select(spectral.index(F.col("nir"), F.col("red"))).collect()] == [None, None, 1.0]


def test_mask_hides_clouds_and_nodata(spark):
    df = spark.createDataFrame([(k,) for k in [0, 1, 3, 4, 8, 9, 10, 11, None]], "k int")
    assert [r[0] for r in df.select(spectral.hidden(F.col("k"))).collect()] == [True, False, True, False, True, True, True, False, False]


def test_nodata_round_trip(spark):
    df = spark.createDataFrame([(0.5,), (None,), (float("nan"),), (-9999.0,)], "v double")
    disk = df.select(spectral.to_nodata(F.col("v")).alias("v"))
    assert [r[0] for r in disk.collect()] == [0.5, -9999.0, -9999.0, -9999.0]
    assert [r[0] for r in disk.select(spectral.from_nodata(F.col("v"))).collect()] == [0.5, None, None, None]


def test_block_mean_known_answer(spark):
    array = np.arange(1, 37, dtype=float).reshape(6, 6)
    assert dense(downsample.block_mean(pixels(spark, array), 3, 6, 6), (2, 2)).tolist() == [[8, 11], [26, 29]]
    array[0, 0] = np.nan
    assert dense(downsample.block_mean(pixels(spark, array), 3, 6, 6), (2, 2))[0, 0] == 8.875


def test_block_mode_ties_take_the_lowest_and_ignore_nodata(spark):
    array = [[8, 4, 0, 0], [8, 4, 0, 0]]
    df = pixels(spark, array).withColumn("value", F.col("value").cast("int"))
    assert dense(downsample.block_mode(df, 2, 2, 4), (1, 2)).tolist() == [[4, 0]]
    assert downsample.block_mode(df, 1, 2, 4) is df
    with pytest.raises(ValueError, match="smaller"):
        downsample.block_mean(df, 3, 2, 4)


def test_mosaic_of_a_split_is_the_whole(spark):
    array = np.random.default_rng(1).random((10, 20))
    tiles = pixels(spark, array).withColumn("tile_ord", F.when(F.col("col") < 10, 0).otherwise(1))
    assert np.array_equal(dense(mosaic.mosaic(tiles, "first"), (10, 20)), array)


def test_mosaic_order_skips_missing(spark):
    df = spark.createDataFrame([(0, 0, None, 0), (0, 0, 2.0, 1), (0, 0, 5.0, 2)], "row int, col int, value double, tile_ord int")
    got = {m: mosaic.mosaic(df, m).first()["value"] for m in mosaic.METHODS}
    assert got == {"first": 2, "last": 5, "min": 2, "max": 5, "sum": 7, "count": 2}
    with pytest.raises(ValueError, match="unknown"):
        mosaic.mosaic(df, "mean")


def test_fallback_takes_the_dense_months_of_a_sparse_quarter(spark):
    days = [date(2021, 1, 1), date(2021, 1, 9), date(2021, 2, 2), date(2021, 4, 1), date(2021, 4, 2)]
    jobs = composite.scene_jobs(spark.createDataFrame([(d,) for d in days], "acq date"), 2)
    got = {}
    for r in jobs.collect():
        got.setdefault(r.period, set()).add(r.acq)
    assert got == {"2021-01": set(days[:2]), "2021-Q1": set(days[:3]), "2021-04": set(days[3:])}


def reference_features(x, dates):
    """One cell, straight from the definitions."""
    t, good = np.arange(len(x)), ~np.isnan(x)
    months = np.array([d.month for d in dates])
    a = np.array([v - np.nanmean(x[months == m]) if g else np.nan for v, m, g in zip(x, months, good, strict=True)])
    axis = features.TimeAxis(tuple(dates))
    tb, den = t.mean(), ((t - t.mean()) ** 2).sum()
    v = x[good]
    out = [((t - tb)[good] * (v - v.mean())).sum() / den if den else np.nan, np.nanstd(a), np.nanmin(a)]
    if len(x) < 4:
        out.append(np.nan)
    else:
        w = axis.frame()
        early, late = x[:w][good[:w]], x[-w:][good[-w:]]
        out.append(late.mean() / early.mean() if len(early) and len(late) else np.nan)
    out += [(a[good] < -0.2).sum(), v.var(), ((v - v.mean()) ** 3).mean() / v.var() ** 1.5 if v.var() > 1e-18 else np.nan]
    return out


@pytest.mark.parametrize("slots", [1, 3, 4, 20, 40])
def test_features_with_gaps(spark, slots):
    draw = np.random.default_rng(slots)
    dates = [date(2020 + i // 12, i % 12 + 1, 15) for i in range(slots)]
    x = draw.uniform(-0.2, 0.9, (12, slots))
    x[draw.random(x.shape) < 0.3] = np.nan
    x[0] = np.nan
    rows = [(i, 0, t, dates[t], None if np.isnan(v) else float(v)) for (i, t), v in np.ndenumerate(x)]
    stack = spark.createDataFrame(rows, "row int, col int, t int, mid date, x double")
    got = {r["row"]: [r[f] for f in features.FEATURES] for r in features.pixel_features(stack, features.TimeAxis(tuple(dates))).collect()}
    for i in range(12):
        if np.isnan(x[i]).all():
            assert i not in got
            continue
        for mine, want in zip(got[i], reference_features(x[i], dates), strict=True):
            assert (mine is None and np.isnan(want)) or math.isclose(mine, want, rel_tol=1e-7, abs_tol=1e-9)


def test_recovery_by_zero_is_infinite(spark):
    dates = tuple(date(2020, m, 15) for m in range(1, 5))
    rows = [(0, 0, t, dates[t], v) for t, v in enumerate([1.0, -1.0, 1.0, 1.0])]
    stack = spark.createDataFrame(rows, "row int, col int, t int, mid date, x double")
    assert features.TimeAxis(dates).frame() == 2
    assert features.pixel_features(stack, features.TimeAxis(dates)).first()["recovery_ratio"] == float("inf")


def test_features_take_one_exchange(spark):
    stack = spark.createDataFrame([(0, 0, 0, date(2020, 1, 15), 0.5)], "row int, col int, t int, mid date, x double").repartition(3)
    plan = features.pixel_features(stack, features.TimeAxis((date(2020, 1, 15),)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_tie_with_the_limit_does_not_persist(spark):
    """0.6 - 0.8 is below -0.2 in doubles, not in truth; 1e-9 less is below in both."""
    stacks = [[0.6, 1.0], [0.6 - 1e-9, 1.0 + 1e-9], [0.1, 0.2, 0.6], [0.6, 0.2, 0.1]]
    assert stacks[0][0] - sum(stacks[0]) / 2 < features.PERSISTENT
    rows = [(i, 0, t, date(2020 + t, 5, 15), v) for i, values in enumerate(stacks) for t, v in enumerate(values)]
    stack = spark.createDataFrame(rows, "row int, col int, t int, mid date, x double")
    got = features.pixel_features(stack, features.TimeAxis(tuple(date(2020 + t, 5, 15) for t in range(3)))).collect()
    assert {r["row"]: r["anomaly_persistence"] for r in got} == {i: int(i == 1) for i in range(len(stacks))}


def test_features_do_not_depend_on_the_order_of_rows(spark):
    dates = tuple(date(2016 + t // 12, t % 12 + 1, 15) for t in range(84))
    x = np.random.default_rng(5).uniform(-1, 1, (10, 84))
    rows = [(i, 0, t, dates[t], float(v)) for (i, t), v in np.ndenumerate(x)]
    made = [features.pixel_features(spark.createDataFrame(r, "row int, col int, t int, mid date, x double").coalesce(1), features.TimeAxis(dates)) for r in (rows, rows[::-1])]
    assert sorted(map(tuple, made[0].collect())) == sorted(map(tuple, made[1].collect()))


def test_filled_series(spark):
    rows = [("a", "2021-01", 1.0, 1.0), ("a", "2021-03", 3.0, None), ("a", "2021-05", 5.0, 5.0), ("a", "2021-Q1", 9.0, 8.0), ("b", "2021-Q1", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "aoi_id string, period string, mean_ndvi double, median_ndvi double")
    got = [tuple(r) for r in stats.filled_series(df).orderBy("time").collect()]
    assert got == [("a", date(2021, 1, 1), 1.0, 1.0), ("a", date(2021, 2, 1), 9.0, 8.0), ("a", date(2021, 3, 1), 3.0, 8.0), ("a", date(2021, 5, 1), 5.0, 5.0)]


def test_climatology_never_mixes(spark):
    rows = [("a", "2021-01", 1.0, 1.0), ("a", "2022-01", 3.0, None), ("a", "2021-Q2", 9.0, 8.0)]
    df = spark.createDataFrame(rows, "aoi_id string, period string, mean_ndvi double, median_ndvi double")
    assert [tuple(r) for r in stats.climatology(df).collect()] == [(1, 2.0, 1.0, 2, "Jan")]
    assert stats.climatology(df.filter("period LIKE '%Q%'")).first()["label"] == "Q2"


def test_anomaly_skips_periods_without_climatology(spark):
    made = spark.createDataFrame([("2021-01", 0, 0, 0.5), ("2022-01", 0, 0, 0.7)], "period string, row int, col int, ndvi double")
    clim = spark.createDataFrame([("02", 0, 0, 0.1)], "poy string, row int, col int, climatology double")
    assert anomaly.anomalies(made, clim).count() == 0
    assert sorted(round(r.anomaly, 6) for r in anomaly.anomalies(made).collect()) == [-0.1, 0.1]


def test_anchors_of_the_published_series():
    assert periods.midpoint_anchors(date(2023, 1, 1), date(2026, 3, 23), 18)[0] == date(2023, 2, 2)
    assert periods.midpoint_anchors(date(2023, 1, 5), date(2023, 1, 5), 3) == [date(2023, 1, 5)] * 3
    assert len(periods.midpoint_anchors(date(2023, 1, 1), date(2023, 1, 3), 5)) == 5


def test_period_mid_rejects_other_labels(spark):
    df = spark.createDataFrame([("2021-05",), ("2021-Q4",)], "p string")
    assert [r[0] for r in df.select(periods.period_mid(F.col("p"))).collect()] == [date(2021, 5, 15), date(2021, 11, 15)]
    with pytest.raises(Exception, match="not a period"):
        spark.createDataFrame([("x",)], "p string").select(periods.period_mid(F.col("p"))).collect()


def test_grid_snaps_outwards_and_cells_follow_centres(spark):
    ring = np.array([[1.0, 1.0], [39.0, 1.0], [39.0, 21.0], [19.0, 21.0], [19.0, 39.0], [1.0, 39.0]])
    made = grid.Grid.around(ring, 10.0)
    assert (made.x0, made.y0, made.width, made.height) == (0.0, 40.0, 4, 4)
    cells = {(r.row, r.col) for r in grid.cells_inside(spark, made, ring).collect()}
    assert cells == {(r, c) for r in range(4) for c in range(4) if r >= 2 or c < 2}
    areas = spark.createDataFrame([("a", [[(float(x), float(y)) for x, y in ring]])], "aoi_id string, rings array<array<struct<x:double,y:double>>>")
    assert {(r.row, r.col) for r in grid.cells_inside_many(areas, made).collect()} == cells


def test_reprojection_between_zones_round_trips(spark):
    target, source = grid.Grid(500000.0, 4500000.0, 10.0, 4, 4, 32634), grid.Grid(500000.0 - 1000, 4500000.0 + 1000, 10.0, 400, 400, 32634)
    cells = spark.createDataFrame([(r, c) for r in range(4) for c in range(4)], "row int, col int")
    assert all((r.src_row, r.src_col) == (r.row + 100, r.col + 100) for r in grid.source_keys(cells, target, source).collect())


def test_mosaic_of_two_zones_lies_on_the_first_tiles_grid(spark):
    lon, lat = np.array([23.99]), np.array([40.5])  # either side of the border of zones 34 and 35
    centre = {epsg: [float(v[0]) for v in geometry.to_utm(lon, lat, epsg)] for epsg in (32634, 32635)}
    grids = {k: grid.Grid(round(centre[e][0], -1) + 200 * k, round(centre[e][1], -1), 10.0, 30, 20, e) for k, e in ((0, 32634), (1, 32635))}
    values = {k: np.arange(600).reshape(20, 30) + 1000.0 * k for k in grids}
    pixels = spark.createDataFrame([(k, r, c, float(v[r, c])) for k, v in values.items() for r in range(20) for c in range(30)], "tile_ord int, row int, col int, value double")
    want, target = {}, grids[0]
    for row in range(-60, 80):
        col = np.arange(-60, 120)
        x, y = geometry.to_utm(*geometry.from_utm(target.x0 + (col + 0.5) * 10, np.full(len(col), target.y0 - (row + 0.5) * 10), 32634), 32635)
        r, c = np.floor((grids[1].y0 - y) / 10).astype(int), np.floor((x - grids[1].x0) / 10).astype(int)
        want |= {(row, int(k)): float(values[1][a, b]) for k, a, b in zip(col, r, c, strict=True) if 0 <= a < 20 and 0 <= b < 30}
    assert len(want) > 300
    want |= {(r, c): float(values[0][r, c]) for r in range(20) for c in range(30)}
    assert {(r["row"], r["col"]): r["value"] for r in mosaic.harmonised(pixels, grids).collect()} == want
    one = mosaic.harmonised(pixels.filter("tile_ord = 0"), {0: target})
    assert one.count() == 600
