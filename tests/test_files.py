"""Tables on disk, the item cache, named regions and grids that must agree."""

import json
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.operators import catalog, downsample, manifest, mosaic
from gridloom.session import checkpoint_dir
from gridloom.sources import geojson, geotiff, items, tables


def test_csv_round_trip(spark, tmp_path):
    schema = "acq date, tile string, n int"
    rows = [(date(2024, 1, 1), "a,b", 1), (None, 'q"x', None)]
    for parts in (1, None):
        tables.write_csv(spark.createDataFrame(rows, schema).repartition(2), str(tmp_path / "t"), parts)
        assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "t"), schema).collect()), key=str) == sorted(rows, key=str)
    tables.write_csv(spark.createDataFrame([], schema), str(tmp_path / "e"))
    assert tables.read_csv(spark, str(tmp_path / "e"), schema).count() == 0 and any("acq" in f.read_text() for f in (tmp_path / "e").glob("part-*"))


def test_items_come_from_the_cache_first(spark):
    made = lambda *rows: spark.createDataFrame(list(rows), "id string, body string")
    got = items.cached_items(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"), made(("a", "old")), made(("a", "new"), ("b", "new")))
    assert sorted(map(tuple, got.collect())) == [("a", "old"), ("b", "new")]


def test_geojson_text(spark):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    row = spark.createDataFrame([("n", [[tuple(p) for p in ring]])], "name string, rings array<array<struct<x:double,y:double>>>")
    made = json.loads(row.select(geojson.as_geojson(row["rings"], row["name"]).alias("j")).first().j)
    assert made["type"] == "Feature" and made["geometry"] == {"type": "Polygon", "coordinates": [ring]}


def test_grids_that_differ_are_an_error(spark):
    schema = "scene_id string, epsg int, x0 double, y0 double, dx double, dy double, width int, height int"
    a = spark.createDataFrame([("s", 32634, 0.0, 0.0, 10.0, 10.0, 5, 5)], schema)
    assert mosaic.aligned(a, a).collect()[0].aligned
    with pytest.raises(Exception, match="grids differ"):
        mosaic.aligned(a, a.withColumn("width", a["width"] + 1)).collect()


def test_tiles_of_two_types_are_an_error(spark):
    layers = spark.createDataFrame([("m", 0, "uint8", 1), ("m", 1, "float32", 1)], "mosaic_id string, tile_ord int, dtype string, epsg int")
    with pytest.raises(Exception, match="inconsistent tiles"):
        mosaic.consistent(layers).collect()


def test_missing_regions_are_an_error(spark):
    regions = spark.createDataFrame([("EL52", "Kentriki")], "NUTS_ID string, NAME_LATN string")
    assert manifest.regions_named(regions, "KENTRIKI").count() == manifest.region_coded(regions, "EL52").count() == 1
    for find, what in ((manifest.regions_named, "nowhere"), (manifest.region_coded, "XX")):
        with pytest.raises(ValueError, match="no region"):
            find(regions, what)


def test_downloads_and_long_links(spark):
    scenes = spark.range(5).orderBy("id")
    assert [manifest.to_download(scenes, n).count() for n in (None, 3, 0, -1, 9)] == [5, 3, 0, 0, 5]
    long = text.BUCKET + "x" * (1 << 21)
    assert spark.createDataFrame([(long,)], "h string").select(text.served(F.col("h")).alias("h")).first().h == text.HOST + "x" * (1 << 21)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        class _jsc:
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))

    session = type("Session", (), {"conf": type("C", (), {"get": staticmethod(lambda k, d: d)}), "sparkContext": Context})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


@pytest.mark.parametrize("shape", [(2, 600, 530), (1, 90, 40)])
@pytest.mark.parametrize("window", [(250, 500, 20, 100), (-3, -2, 30, 9), (0, 0, 600, 530), (700, 0, 5, 5), (256, 256, 256, 256)])
def test_a_window_is_a_part_of_the_raster(shape, window):
    whole = geotiff.Raster(np.random.default_rng(1).random(shape).astype("float32"), 500.0, 900.0, 10.0, 20.0, 32634, -1.0)
    part = geotiff.decode(geotiff.encode(whole), window)
    row, col, rows, cols = window
    row0, col0 = max(row, 0), max(col, 0)
    assert np.array_equal(part.bands, whole.bands[:, row0 : row + rows, col0 : col + cols])
    assert (part.x0, part.y0) == (500 + 10 * col0, 900 - 20 * row0)


def test_a_window_reads_its_blocks_only(spark, tmp_path):
    whole = geotiff.Raster(np.arange(1, 600 * 600 + 1, dtype="float32").reshape(1, 600, 600), nodata=0.0)
    data = geotiff.encode(whole)
    spoiled = bytearray(data)
    spoiled[8:40] = bytes(32)  # the first block cannot be read any more
    (tmp_path / "a.tif").write_bytes(bytes(spoiled))
    got = {(r.row, r.col): r.value for r in geotiff.read_pixels(spark, str(tmp_path), (300, 300, 2, 3)).collect()}
    assert got == {(r, c): float(r * 600 + c + 1) for r in (300, 301) for c in (300, 301, 302)}
    layer = geotiff.read_layers(spark, str(tmp_path)).first()
    assert (layer.width, layer.height, layer.bands, layer.dtype) == (600, 600, 1, "float32")


def test_cells_as_bits():
    assert catalog.cell_bits([np.array([7, 10**12]), np.array([9, 7]), np.array([], np.int64)]) == [0b101, 0b011, 0]
    assert catalog.cell_bits([]) == []


def test_overviews_are_the_nearest_cells(spark):
    plane = np.arange(1, 2 * 530 * 300 + 1, dtype="float32").reshape(2, 530, 300)
    data = geotiff.encode(geotiff.Raster(plane, 5.0, 6.0, 10.0, 10.0, 32634, 0.0), levels=(2, 4, 512))
    assert np.array_equal(geotiff.decode(data).bands, plane) and geotiff.decode(data).epsg == 32634
    assert [geotiff.decode(data, image=i).bands.shape for i in (1, 2)] == [(2, 265, 150), (2, 132, 75)]
    with pytest.raises(ValueError, match="fewer images"):
        geotiff.decode(data, image=3)
    small = np.arange(1, 36, dtype="float32").reshape(1, 5, 7)
    cells = spark.createDataFrame([("f", 0, r, c, float(small[0, r, c])) for r in range(5) for c in range(7)], "name string, band int, row int, col int, value double")
    made = geotiff.encoded(cells, 5, 7, geotiff.Raster(small, nodata=0.0), levels=(2,)).first()
    got = geotiff.decode(bytes(made.content), image=1).bands[0]
    want = {(r.row, r.col): r.value for r in downsample.block_nearest(cells.select("row", "col", "value"), 2, 5, 7).collect()}
    assert {(r, c): float(got[r, c]) for r in range(got.shape[0]) for c in range(got.shape[1])} == want
