"""Queries read their whole table: tables larger than the smallest given ones, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import composite, manifest
from gridloom.plans import registry


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """2400 parts, a raster of 60 x 40."""
    d = str(tmp_path_factory.mktemp("parts"))
    key = F.col("id")
    spark.range(2400).select(key.alias("p_partkey"), (key * 7 % 1000 / 8).alias("p_retailprice"), (key * 13 % 50).cast("int").alias("p_size")).write.parquet(f"{d}/part.parquet")
    at = np.arange(2400)
    return d, (at * 7 % 1000 / 8).reshape(60, 40), (at * 13 % 50 % 6).reshape(60, 40)


def raster(spark, name, d):
    return {(r["row"], r["col"]): r["value"] for r in registry.queries()[name](spark, d).collect()}


def test_downsampling_reads_every_part(spark, parts):
    d, price, kind = parts
    blocks = lambda a: a[:, :39].reshape(20, 3, 13, 3).swapaxes(1, 2).reshape(20, 13, 9)
    mode = [[max(set(b[b != 0]), key=lambda k: ((b == k).sum(), -k), default=0) for b in row] for row in blocks(kind)]
    want = {"down_mean": blocks(price).mean(axis=2), "down_median": np.median(blocks(price), axis=2), "down_mode": np.array(mode), "down_nearest": price[::3, :39:3]}
    for name, array in want.items():
        got = raster(spark, name, d)
        assert sorted(got) == [(r, c) for r in range(20) for c in range(13)], name
        assert all(abs(got[at] - v) < 1e-6 for at, v in np.ndenumerate(array)), name


def test_overviews_read_every_part(spark, parts):
    d, price, _ = parts
    got = {(r["level"], r["row"], r["col"]): r["value"] for r in registry.queries()["overview"](spark, d).collect()}
    want = {(n, r, c): v for n in (2, 4, 8, 16) for (r, c), v in np.ndenumerate(price[: 60 // n * n : n, : 40 // n * n : n])}
    assert got == want


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """1500 lines of 250 suppliers, a raster of 25 x 10; 7 bands."""
    d = str(tmp_path_factory.mktemp("lines"))
    n = F.col("id")
    columns = {"l_orderkey": F.floor(n / 7), "l_linenumber": (n % 7 + 1).cast("int"), "l_suppkey": n % 250, "l_shipdate": F.lit("2021-01-01"), "l_discount": n % 11 / 100, "l_tax": n % 9 / 100, "l_quantity": n % 50}
    spark.range(1500).select(*(v.alias(k) for k, v in columns.items())).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_reprojection_reads_every_cell(spark, lines):
    at = np.arange(1500)
    source = np.zeros(250)
    np.maximum.at(source, at % 250, at % 11 / 100)
    want = dict(np.ndenumerate(source.reshape(25, 10).repeat(2, axis=0).repeat(2, axis=1)))
    assert raster(spark, "reproject_nearest", lines) == want


def test_the_pivot_meets_every_line(spark, lines, monkeypatch):
    met, pivot = [], composite.pivot_bands
    monkeypatch.setattr(composite, "pivot_bands", lambda pixels, bands: met.append(pixels) or pivot(pixels, bands))
    rows = registry.queries()["band_pivot"](spark, lines).collect()
    assert {r["band"] for r in met[0].select("band").distinct().collect()} == {"B04", "B08", "SCL", *(f"L{n}" for n in range(3, 8))}
    n = [7 * i for i in range(215)]
    assert sorted((r.scene, r.red, r.nir, r.scl) for r in rows) == [(i // 7, i % 11 / 100, i % 9 / 100, (i + 1) % 50 if i + 1 < 1500 else None) for i in n]


def test_operators_choose_the_required_bands(spark):
    required = spark.createDataFrame([("a", 1), ("a", 4), ("b", 1)], "acq_ts string, band int")
    existing = spark.createDataFrame([("a", 1)], "acq_ts string, band int")
    rows = lambda f, *bands: sorted(tuple(r) for r in f(required, existing, ["acq_ts", "band"], *bands).collect())
    assert rows(manifest.missing_files, (1, 2, 3)) == [("b", 1)] and rows(manifest.complete_timestamps, (1, 2, 3)) == [("a", 1)]
    assert rows(manifest.missing_files) == [("a", 4), ("b", 1)] and rows(manifest.complete_timestamps) == []
