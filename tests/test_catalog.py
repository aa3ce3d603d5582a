"""Selection, manifests, names, geometry and files."""

import random
from datetime import date, datetime
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import geometry, text
from gridloom.operators import catalog, footprints, manifest, mosaic
from gridloom.schemas import require_columns
from gridloom.settings import RunSettings, effective
from gridloom.sources import geojson, geotiff, items, tables


def brute_union(tiles, total, threshold, most):
    best = None
    for k in range(1, most + 1):
        for combo in combinations(tiles, k):
            n = len(set().union(*({i for i in range(total) if b >> i & 1} for _, _, b in combo)))
            if n >= threshold * total:
                key = (max(c for _, c, _ in combo), -n, k)
                if best is None or key < best[0]:
                    best = (key, [t for t, _, _ in combo])
    return best and (best[1], best[0][0], -best[0][1] / total)


def test_best_union_equals_brute_force():
    draw = random.Random(5)
    for _ in range(400):
        total, n = 8, draw.randint(1, 6)
        tiles = [(f"t{i}", float(draw.randint(0, 4)), draw.getrandbits(total)) for i in range(n)]
        for most in (1, 2, n):
            assert catalog.best_union(tiles, total, 0.75, most) == brute_union(tiles, total, 0.75, min(most, n))


def test_ties_between_timestamps(spark):
    rows = [(date(2021, 1, 10), datetime(2021, 1, d), c, f, abs(d - 10), n) for d, c, f, n in [(9, 5.0, 1.0, 2), (11, 5.0 + 1e-14, 1.0, 2), (12, 5.0, 1.0 - 1e-15, 1), (8, 6.0, 1.0, 1)]]
    found = spark.createDataFrame(rows, "anchor date, acq_ts timestamp, cloud_score double, coverage_frac double, dist_days int, tiles_count int")
    assert catalog.best_per_anchor(found).first().acq_ts == datetime(2021, 1, 9)
    assert [r.rank for r in catalog.top_candidates(found, 2).collect()] == [1, 2]
    assert catalog.top_candidates(found, 0).count() == 0


def test_window_is_half_rounded_down_and_inclusive(spark):
    anchors = spark.createDataFrame([(date(2021, 1, 20),)], "anchor date")
    times = spark.createDataFrame([(datetime(2021, 1, d, 23),) for d in range(1, 31)], "acq_ts timestamp")
    got = sorted(r.acq_ts.day for r in catalog.candidates(anchors, times, 21).collect())
    assert got == list(range(10, 31))
    plan = catalog.candidates(anchors, times, 21)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="positive"):
        catalog.candidates(anchors, times, 0)


def test_partial_unions_raise_on_demand(spark):
    rows = [(datetime(2021, 1, 1), "a", 1.0, 0)]
    cells = spark.createDataFrame(rows, "acq_ts timestamp, tile string, cloud double, cell int")
    assert catalog.unions(cells, 4, 0.9, 2).count() == 0
    with pytest.raises(Exception, match="partial"):
        catalog.unions(cells, 4, 0.9, 2, on_partial="raise").collect()


def test_links(spark):
    schema = "assets map<string, struct<href: string, alternate: map<string, struct<href: string>>>>"
    rows = [
        ({"B04_10m": ("http://a", None)},),
        ({"B04_20m": ("s3://eodata/x", {"https": ("https://m",)})},),
        ({"B04_60m": ("s3://eodata/x/y", None)},),
        ({"B04_10m": ("s3://other/x", None)},),
        ({},),
    ]
    keys = text.asset_keys("B04", (10, 20, 60), 10)
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(text.first_link(F.col("assets"), keys)).collect()]
    assert got == ["http://a", "https://m", text.HOST + "x/y", None, None]
    assert text.asset_keys("B04", (10, 20, 60), 20) == ["B04_20m", "B04_10m", "B04_60m"]


def test_lists_and_names(spark):
    df = spark.createDataFrame([(" b| a;;b,c ",), (None,)], "s string")
    assert [r[0] for r in df.select(text.split_ids(F.col("s"))).collect()] == [["b", "a", "c"], []]
    assert spark.createDataFrame([("  A b/ç-1 ",)], "s string").select(text.slug(F.col("s"))).first()[0] == "A_b-1"


def test_manifest_keeps_repeats_and_finds_links(spark):
    known = spark.createDataFrame([("s1", {"B04_10m": ("http://4", None), "B08": ("http://8", None), "scl_20m": ("http://s", None)})], "id string, assets map<string, struct<href: string, alternate: map<string, struct<href: string>>>>")
    scenes = spark.createDataFrame([("s1",), ("s1",), ("s2",)], "scene_id string")
    made = manifest.manifest(scenes, known, "cache")
    assert sorted((r.scene_id, r.href_b04, r.href_b08, r.href_scl) for r in made.filter("scene_id = 's1'").collect()) == [("s1", "http://4", "http://8", "http://s")] * 2
    assert made.filter("scene_id = 's2'").first().local_b08 == "cache/raw/s2/s2/B08.tif"
    assert manifest.missing_links(made).first().missing == 1


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="a, b"):
        require_columns(spark.range(1), ["b", "a", "id"])


def test_projection_round_trip_and_a_known_point():
    lon, lat = np.array([21.0, 22.9, 24.0, 18.5]), np.array([0.0, 40.6, 59.9, -33.0])
    for epsg in (32634, 32734):
        back = geometry.from_utm(*geometry.to_utm(lon, lat, epsg), epsg)
        assert np.allclose(back, (lon, lat), atol=1e-9)
    x, y = geometry.to_utm(np.array([21.0]), np.array([40.0]), 32634)
    assert abs(x[0] - 500000) < 1e-6 and abs(y[0] - 4427757.219) < 0.01
    assert geometry.utm_epsg(22.9, 40.6) == 32634 and geometry.utm_epsg(22.9, -1) == 32734


def test_clip_and_union_area():
    notch = np.array([[0, 0], [4, 0], [4, 4], [2, 2], [0, 4]], float)
    box = np.array([[0, 1], [4, 1], [4, 4], [0, 4]], float)
    assert geometry.area(notch) == 12
    assert abs(geometry.area(geometry.clip(notch, box)) - 8) < 1e-9
    assert abs(geometry.union_area([box, box + 1, box + 10]) - (12 + 12 - 6 + 12)) < 1e-9
    disc = geometry.union_area(geometry.buffer(box, 1.0, 64))
    assert abs(disc - (12 + 14 + np.pi)) < 0.01


@pytest.mark.parametrize("dtype", ["uint8", "uint16", "float32"])
@pytest.mark.parametrize("shape", [(1, 3, 5), (2, 300, 270), (7, 16, 16)])
def test_geotiff_round_trip(dtype, shape):
    bands = np.random.default_rng(0).integers(0, 200, shape).astype(dtype)
    back = geotiff.decode(geotiff.encode(geotiff.Raster(bands, 100.0, 200.0, 10.0, 10.0, 32634, -9999.0 if dtype == "float32" else 0.0)))
    assert np.array_equal(back.bands, bands) and back.bands.dtype == bands.dtype
    assert (back.x0, back.y0, back.dx, back.dy, back.epsg) == (100.0, 200.0, 10.0, 10.0, 32634)


def test_geotiff_tables(spark, tmp_path):
    plane = np.array([[[1.0, -9999.0, 3.0], [np.nan, 5.0, 6.0]]], np.float32)
    (tmp_path / "a.tif").write_bytes(geotiff.encode(geotiff.Raster(plane, nodata=-9999.0, epsg=32634)))
    got = {(r.row, r.col): r.value for r in geotiff.read_pixels(spark, str(tmp_path)).collect()}
    assert got == {(0, 0): 1.0, (0, 2): 3.0, (1, 1): 5.0, (1, 2): 6.0}
    assert {(r.row, r.col) for r in geotiff.read_pixels(spark, str(tmp_path), (1, 1, 1, 1)).collect()} == {(1, 1)}
    layer = geotiff.read_layers(spark, str(tmp_path)).first()
    assert (layer.width, layer.height, layer.bands, layer.epsg, layer.nodata) == (3, 2, 1, 32634, -9999.0)
    made = geotiff.encoded(spark.createDataFrame([("x", 0, 1, 2, 7.0)], "name string, band int, row int, col int, value double"), 2, 3, geotiff.Raster(plane, nodata=-9999.0)).first()
    assert geotiff.decode(bytes(made.content)).bands[0].tolist() == [[-9999, -9999, -9999], [-9999, -9999, 7]]


def test_areas_items_and_regions(spark, tmp_path):
    ring = '[[[0,0],[1,0],[1,1],[0,0]]]'
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"NUTS_ID":"EL522","NAME_LATN":"X","LEVL_CODE":3,"CNTR_CODE":"EL"},"geometry":{"type":"Polygon","coordinates":' + ring + "}}]}")
    (tmp_path / "b.geojson").write_text('{"type":"MultiPolygon","coordinates":[' + ring + "]}")
    (tmp_path / "c.geojson").write_text('{"type":"FeatureCollection","features":[]}')
    for name in ("a", "b"):
        assert geojson.read_area(spark, str(tmp_path / f"{name}.geojson")).first().rings[0][1] == (1.0, 0.0)
    with pytest.raises(Exception, match="no polygon"):
        geojson.read_area(spark, str(tmp_path / "c.geojson")).collect()
    region = geojson.read_regions(spark, str(tmp_path / "a.geojson")).first()
    assert (region.NUTS_ID, region.LEVL_CODE) == ("EL522", 3)
    (tmp_path / "i.json").write_text('{"id":"i","geometry":{"type":"Polygon","coordinates":' + ring + '},"properties":{"datetime":"2021-01-05T09:13:51Z","eo:cloud_cover":7.5}}\n')
    item = items.footprints(items.read_items(spark, str(tmp_path / "i.json"))).first()
    assert item.cloud == 7.5 and item.acq_ts == datetime(2021, 1, 5, 9, 13, 51) and len(item.rings) == 1


def test_discovery(spark):
    paths = spark.createDataFrame([("/x/2021-05-03T09_13_51",), ("/x/readme",)], "path string")
    assert [(r.month, r.quarter) for r in tables.scene_folders(paths).collect()] == [("2021-05", "2021-Q2")]
    files = spark.createDataFrame([("/o/ndvi_2021-05_el522.tif",), ("/o/ndvi_2020-Q1_EL522.tif",), ("/o/ndvi_2021-05-03_el522.tif",), ("/o/ndvi_anomaly_2021-05_el522.tif",), ("/o/ndvi_climatology_median_05_el522.tif",)], "path string")
    assert [r.period for r in tables.composite_files(files, "el522", first_year=2021).collect()] == ["2021-05"]
    assert {r.period for r in tables.anomaly_files(files.filter("path LIKE '%anomaly%'")).collect()} == {"2021-05"}


def test_polygon_coverage_of_a_notched_area(spark):
    notch = np.array([[23.0, 40.0], [23.2, 40.0], [23.2, 40.2], [23.1, 40.1], [23.0, 40.2]])
    box = lambda x0, y0, x1, y1: [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]
    rows = [("whole", 1, 5.0, box(22.9, 39.9, 23.3, 40.3)), ("west", 2, 7.0, box(22.9, 39.9, 23.1, 40.3)), ("east", 2, 9.0, box(23.1, 39.9, 23.3, 40.3)), ("far", 3, 1.0, box(10.0, 10.0, 11.0, 11.0))]
    tiles = spark.createDataFrame(rows, "id string, acq_ts int, cloud double, rings array<array<struct<x:double,y:double>>>")
    found = footprints.overlaps(tiles, notch, 32634)
    frac = {r.id: r.coverage_frac for r in found.collect()}
    assert set(frac) == {"whole", "west", "east"} and abs(frac["whole"] - 1) < 1e-9 and abs(frac["west"] - 0.5) < 2e-3
    cover = {r.acq_ts: (r.has_full_cover, r.max_cloud) for r in footprints.union_coverage(found, notch, 0.999, 32634).collect()}
    assert cover == {1: (True, 5.0), 2: (True, 9.0)}


def test_modes_clamp_only_in_dev():
    given = RunSettings(max_items=5000, max_cloud=15.0)
    assert effective(given, "deep") == given
    held = effective(given, "dev")
    assert (held.max_items, held.max_cloud, held.downloads, held.resolution) == (400, 15.0, 300, 20)


def test_mosaic_output_types():
    nan = float("nan")
    assert mosaic.output_type("uint16", 0.0, None) == ("uint16", 0.0)
    assert mosaic.output_type("uint16", 0.0, 5.0) == ("uint16", 5.0)
    assert mosaic.output_type("uint16", 0.0, nan)[0] == "float32"
    assert mosaic.output_type("uint16", 7.0, nan, promote=False) == ("uint16", 7.0)
    with pytest.raises(ValueError, match="NaN"):
        mosaic.output_type("uint16", None, nan, promote=False)
