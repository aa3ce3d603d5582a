"""Grids: snapping, cells, nearest keys and windows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.geometry import contains, from_utm, to_utm


@dataclass(frozen=True)
class Grid:
    """North-up grid: x0, y0 is the outer corner of the top left cell."""

    x0: float
    y0: float
    cell: float
    width: int
    height: int
    epsg: int = 32634

    @staticmethod
    def around(ring: np.ndarray, cell: float, epsg: int = 32634) -> Grid:
        """Bounds snapped outwards to multiples of the cell."""
        low, high = ring.min(axis=0), ring.max(axis=0)
        left, bottom = (math.floor(v / cell) * cell for v in low)
        right, top = (math.ceil(v / cell) * cell for v in high)
        return Grid(left, top, cell, round((right - left) / cell), round((top - bottom) / cell), epsg)

    def window(self, ring: np.ndarray) -> tuple[int, int, int, int]:
        """first row, first column, rows and columns that the ring's bounds cover, clipped to the grid."""
        low, high = ring.min(axis=0), ring.max(axis=0)
        row0, row1 = (round((self.y0 - v) / self.cell) for v in (high[1], low[1]))
        col0, col1 = (round((v - self.x0) / self.cell) for v in (low[0], high[0]))
        row0, row1, col0, col1 = max(0, row0), min(self.height, row1), max(0, col0), min(self.width, col1)
        if row1 <= row0 or col1 <= col0:
            raise ValueError("the area does not meet the raster")
        return row0, col0, row1 - row0, col1 - col0


def in_window(window: tuple[int, int, int, int]) -> Column:
    """A range predicate on row and col; it reaches the Parquet scan."""
    row, col, rows, cols = window
    return F.col("row").between(row, row + rows - 1) & F.col("col").between(col, col + cols - 1)


def cells_inside(spark: SparkSession, grid: Grid, ring: np.ndarray, parts: int = 8) -> DataFrame:
    """row and col of cells whose centres are inside the ring (even-odd, edges by ray casting), in SQL expressions."""
    x = F.lit(grid.x0) + (F.col("col") + 0.5) * grid.cell
    y = F.lit(grid.y0) - (F.col("row") + 0.5) * grid.cell
    crossing = F.lit(False)
    for (xa, ya), (xb, yb) in zip(ring.tolist(), np.roll(ring, -1, axis=0).tolist(), strict=True):
        if ya != yb:
            crossing = crossing != (((F.lit(ya) > y) != (F.lit(yb) > y)) & (x < F.lit((xb - xa) / (yb - ya)) * (y - ya) + xa))
    rows = spark.range(0, grid.height, 1, parts).select(F.col("id").cast("int").alias("row"))
    return rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1)))).filter(crossing)


def cells_inside_many(areas: DataFrame, grid: Grid) -> DataFrame:
    """areas (aoi_id, rings: array of rings of struct x, y; many corners): cells of each, in numpy batches."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for aoi, rings in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in range(grid.height):
                    x = grid.x0 + (np.arange(grid.width) + 0.5) * grid.cell
                    y = np.full(grid.width, grid.y0 - (row + 0.5) * grid.cell)
                    hit = np.zeros(grid.width, bool)
                    for ring in rings:
                        hit ^= contains(np.array([[p["x"], p["y"]] for p in ring]), x, y)
                    col = np.flatnonzero(hit).astype(np.int32)
                    if len(col):
                        yield pa.RecordBatch.from_arrays([pa.array([aoi] * len(col)), pa.array(np.full(len(col), row, np.int32)), pa.array(col)], names=["aoi_id", "row", "col"])

    return areas.select("aoi_id", "rings").mapInArrow(cells, "aoi_id string, row int, col int")


def nearest_keys(target: Grid, x0: Column, y0: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    """The source row and col that hold the centre of the target's row and col; source grids of the same projection."""
    x = F.lit(target.x0) + (F.col("col") + 0.5) * target.cell
    y = F.lit(target.y0) - (F.col("row") + 0.5) * target.cell
    return F.floor((y0 - y) / dy).cast("int"), F.floor((x - x0) / dx).cast("int")


def reproject_nearest(cells: DataFrame, layers: DataFrame, pixels: DataFrame, target: Grid) -> DataFrame:
    """cells (row, col) of the target, layers (layer_id, x0, y0, dx, dy), pixels (layer_id, row, col, value).

    An equi-join on the source cell; the nearest value per layer and target cell, where the source has one.
    """
    row, col = nearest_keys(target, F.col("x0"), F.col("y0"), F.col("dx"), F.col("dy"))
    keyed = cells.select("row", "col").join(F.broadcast(layers.select("layer_id", "x0", "y0", "dx", "dy"))) if layers.count() <= 10_000 else cells.select("row", "col").join(layers.select("layer_id", "x0", "y0", "dx", "dy"))
    keyed = keyed.select("layer_id", "row", "col", row.alias("src_row"), col.alias("src_col"))
    source = pixels.select("layer_id", F.col("row").alias("src_row"), F.col("col").alias("src_col"), "value")
    return keyed.join(source, ["layer_id", "src_row", "src_col"]).select("layer_id", "row", "col", "value")


def source_keys(cells: DataFrame, target: Grid, source: Grid) -> DataFrame:
    """As nearest_keys between two zones: target centres to degrees and on to the source's zone, in numpy batches."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, col = (batch.column(i).to_numpy() for i in range(2))
            lon, lat = from_utm(target.x0 + (col + 0.5) * target.cell, target.y0 - (row + 0.5) * target.cell, target.epsg)
            x, y = to_utm(lon, lat, source.epsg)
            src = [np.floor((source.y0 - y) / source.cell).astype(np.int32), np.floor((x - source.x0) / source.cell).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, src)], names=["row", "col", "src_row", "src_col"])

    return cells.select(F.col("row").cast("int"), F.col("col").cast("int")).mapInArrow(keys, "row int, col int, src_row int, src_col int")


def box_in(source: Grid, target: Grid) -> tuple[int, int, int, int]:
    """First row, first column, rows and columns of the target's cells, also beyond its edges, that a source can reach."""
    across, down = np.linspace(0, source.width * source.cell, 65), np.linspace(0, source.height * source.cell, 65)
    x = source.x0 + np.concatenate([across, across, np.zeros(65), np.full(65, across[-1])])
    y = source.y0 - np.concatenate([np.zeros(65), np.full(65, down[-1]), down, down])
    if source.epsg != target.epsg:
        x, y = to_utm(*from_utm(x, y, source.epsg), target.epsg)
    spare = 0 if source.epsg == target.epsg else 2  # an edge bulges a little between its points
    row, col = math.floor((target.y0 - y.max()) / target.cell) - spare, math.floor((x.min() - target.x0) / target.cell) - spare
    return row, col, math.ceil((target.y0 - y.min()) / target.cell) + spare - row, math.ceil((x.max() - target.x0) / target.cell) + spare - col


def onto(spark: SparkSession, source: Grid, target: Grid) -> DataFrame:
    """row, col, src_row, src_col: the target's cells, also beyond its edges, whose centres a source of any zone holds."""
    row, col, rows, cols = box_in(source, target)
    cells = spark.range(rows).select((F.col("id") + row).cast("int").alias("row")).withColumn("col", F.explode(F.sequence(F.lit(col), F.lit(col + cols - 1))))
    if source.epsg == target.epsg:
        keys = nearest_keys(target, *(F.lit(float(v)) for v in (source.x0, source.y0, source.cell, source.cell)))
        keyed = cells.select("row", "col", keys[0].alias("src_row"), keys[1].alias("src_col"))
    else:
        keyed = source_keys(cells, target, source)
    return keyed.filter(F.col("src_row").between(0, source.height - 1) & F.col("src_col").between(0, source.width - 1))
