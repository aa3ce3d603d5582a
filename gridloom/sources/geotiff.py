"""GeoTIFF reading and writing: bands of uint8, uint16 or float32 in strips or tiles, plain or deflated.

Files are read through Spark's binary source, so any file system works; the codec is numpy and zlib.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tags used here, and sizes of the format's types.
_SUBFILE, _WIDTH, _HEIGHT, _BITS, _COMPRESSION, _PHOTOMETRIC, _STRIPS, _BANDS, _ROWS, _COUNTS = 254, 256, 257, 258, 259, 262, 273, 277, 278, 279
_PLANAR, _PREDICTOR, _TILE_W, _TILE_H, _TILES, _TILE_COUNTS, _FORMAT = 284, 317, 322, 323, 324, 325, 339
_SCALE, _TIE, _KEYS, _NODATA = 33550, 33922, 34735, 42113
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 11: "f", 12: "d", 16: "Q"}
_KINDS = {("uint", 8): np.uint8, ("uint", 16): np.uint16, ("float", 32): np.float32}


@dataclass
class Raster:
    """bands: (band, row, col). x0, y0: the outer corner of the top left cell."""

    bands: np.ndarray
    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0
    epsg: int | None = None
    nodata: float | None = None


def _tags(data: bytes, image: int = 0) -> tuple[str, dict[int, tuple]]:
    """Byte order and tags of the file's first image, or of a later one: its overviews."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a classic TIFF file")
    at = struct.unpack(order + "I", data[4:8])[0]
    for _ in range(image):
        at += 2 + 12 * struct.unpack(order + "H", data[at : at + 2])[0]
        at = struct.unpack(order + "I", data[at : at + 4])[0]
        if not at:
            raise ValueError("the file has fewer images")
    tags = {}
    for i in range(struct.unpack(order + "H", data[at : at + 2])[0]):
        tag, kind, n = struct.unpack(order + "HHI", data[at + 2 + 12 * i : at + 10 + 12 * i])
        if kind not in _TYPES:
            continue
        size = struct.calcsize(order + _TYPES[kind]) * n
        place = at + 10 + 12 * i
        if size > 4:
            place = struct.unpack(order + "I", data[place : place + 4])[0]
        raw = data[place : place + size]
        tags[tag] = (raw.rstrip(b"\0").decode("ascii", "replace"),) if kind == 2 else struct.unpack(order + _TYPES[kind] * n, raw)
    return order, tags


def decode(data: bytes, window: tuple[int, int, int, int] | None = None, image: int = 0) -> Raster:
    """The raster, or the part of it in a window (row, col, rows, cols); blocks outside it are not decompressed.

    image: 0, or the number of an overview, which has no grid of its own.
    """
    order, tags = _tags(data, image)
    one = lambda tag, default: tags.get(tag, (default,))[0]
    width, height, bands = one(_WIDTH, 0), one(_HEIGHT, 0), one(_BANDS, 1)
    row0, col0, rows, cols = window or (0, 0, height, width)
    row0, col0, row1, col1 = max(row0, 0), max(col0, 0), max(min(row0 + rows, height), 0), max(min(col0 + cols, width), 0)
    kind = _KINDS.get(({1: "uint", 3: "float"}.get(one(_FORMAT, 1), "?"), one(_BITS, 1)))
    compression, planar = one(_COMPRESSION, 1), one(_PLANAR, 1)
    if kind is None or compression not in (1, 8, 32946) or one(_PREDICTOR, 1) != 1 or (planar == 1 and bands > 1 and _TILES in tags):
        raise ValueError("unsupported TIFF: only uint8, uint16 and float32, plain or deflated")
    tiled = _TILES in tags
    tile_w, tile_h = (one(_TILE_W, 0), one(_TILE_H, 0)) if tiled else (width, min(one(_ROWS, height), height))
    offsets, counts = tags[_TILES if tiled else _STRIPS], tags[_TILE_COUNTS if tiled else _COUNTS]
    across, down = -(-width // tile_w), -(-height // tile_h)
    deep = bands if planar == 1 else 1
    out = np.zeros((bands, max(row1 - row0, 0), max(col1 - col0, 0)), kind)
    for i, (at, n) in enumerate(zip(offsets, counts, strict=True)):
        band, place = divmod(i, across * down)
        row, col = place // across * tile_h, place % across * tile_w
        if row >= row1 or col >= col1 or row + tile_h <= row0 or col + tile_w <= col0:
            continue
        raw = data[at : at + n] if compression == 1 else zlib.decompress(data[at : at + n])
        rows = tile_h if tiled else min(tile_h, height - row)
        block = np.frombuffer(raw, np.dtype(kind).newbyteorder(order), rows * tile_w * deep).reshape(rows, tile_w, deep)
        top, left = max(row, row0), max(col, col0)
        part = block[top - row : min(rows, row1 - row), left - col : min(tile_w, col1 - col)].transpose(2, 0, 1)
        target = slice(0, bands) if planar == 1 else slice(band, band + 1)
        out[target, top - row0 : top - row0 + part.shape[1], left - col0 : left - col0 + part.shape[2]] = part
    scale, tie, keys = tags.get(_SCALE, (1.0, 1.0, 0.0)), tags.get(_TIE, (0.0,) * 6), tags.get(_KEYS, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (2048, 3072)), None)
    nodata = tags.get(_NODATA)
    return Raster(out, tie[3] + (col0 - tie[0]) * scale[0], tie[4] + (tie[1] - row0) * scale[1], scale[0], scale[1], epsg, float(nodata[0]) if nodata and nodata[0].strip() else None)


def encode(raster: Raster, tile: int = 256, levels: tuple[int, ...] = ()) -> bytes:
    """Deflated; in tiles only if both sides are at least one tile long, else in one strip a band.

    levels: factors of overviews, each block's top left cell, written after the raster as far as it is large enough.
    """
    height, width = raster.bands.shape[1:]
    planes = [raster.bands]
    for level in levels:
        if min(height, width) // level >= 1:
            planes.append(raster.bands[:, : height // level * level : level, : width // level * level : level])
    out = bytearray(struct.pack("<2sHI", b"II", 42, 0))
    link = 4  # where the place of the next image goes
    for number, plane in enumerate(planes):
        entries = _image(out, plane, raster, tile, number > 0)
        out += b"\0" * (len(out) & 1)
        struct.pack_into("<I", out, link, len(out))
        link = len(out) + 2 + 12 * len(entries)
        out += _directory(entries, len(out))
    return bytes(out)


def _image(out: bytearray, plane: np.ndarray, raster: Raster, tile: int, overview: bool) -> list[tuple[int, int, list]]:
    """Adds the plane's blocks to the file, and gives its tags (number, type, values)."""
    bands, height, width = plane.shape
    kind = plane.dtype
    name = next((k for k, v in _KINDS.items() if v == kind.type), None)
    if name is None:
        raise ValueError(f"unsupported type: {kind}")
    tiled = min(height, width) >= tile
    tile_h, tile_w = (tile, tile) if tiled else (height, width)
    offsets, counts = [], []
    for band in range(bands):
        for row in range(0, height, tile_h):
            for col in range(0, width, tile_w):
                block = np.zeros((tile_h, tile_w), kind.newbyteorder("<"))
                part = plane[band, row : row + tile_h, col : col + tile_w]
                block[: part.shape[0], : part.shape[1]] = part
                raw = zlib.compress(block.tobytes(), 6)
                offsets.append(len(out))
                counts.append(len(raw))
                out += raw
    keys = [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, raster.epsg] if raster.epsg else []
    grid = [(_SCALE, 12, [raster.dx, raster.dy, 0.0]), (_TIE, 12, [0.0, 0.0, 0.0, raster.x0, raster.y0, 0.0]), *([(_KEYS, 3, keys)] if keys else [])]
    return [
        *([(_SUBFILE, 4, [1])] if overview else []),
        (_WIDTH, 4, [width]),
        (_HEIGHT, 4, [height]),
        (_BITS, 3, [name[1]] * bands),
        (_COMPRESSION, 3, [8]),
        (_PHOTOMETRIC, 3, [1]),
        *([] if tiled else [(_STRIPS, 4, offsets)]),
        (_BANDS, 3, [bands]),
        *([] if tiled else [(_ROWS, 4, [height]), (_COUNTS, 4, counts)]),
        (_PLANAR, 3, [2 if bands > 1 else 1]),
        *([(_TILE_W, 4, [tile]), (_TILE_H, 4, [tile]), (_TILES, 4, offsets), (_TILE_COUNTS, 4, counts)] if tiled else []),
        (_FORMAT, 3, [{"uint": 1, "float": 3}[name[0]]] * bands),
        *([] if overview else grid),
        *([(_NODATA, 2, [f"{raster.nodata:g}\0".encode()])] if raster.nodata is not None else []),
    ]


def _directory(entries: list[tuple[int, int, list]], at: int) -> bytes:
    """The tags as they stand in the file from `at` on, with no next image."""
    table, extra, rest = b"", b"", at + 2 + 12 * len(entries) + 4
    for tag, code, values in entries:
        raw = values[0] if code == 2 else struct.pack("<" + _TYPES[code] * len(values), *values)
        n = len(raw) if code == 2 else len(values)
        if len(raw) > 4:
            place, extra = struct.pack("<I", rest + len(extra)), extra + raw + b"\0" * (len(raw) & 1)
        else:
            place = raw.ljust(4, b"\0")
        table += struct.pack("<HHI", tag, code, n) + place
    return struct.pack("<H", len(entries)) + table + struct.pack("<I", 0) + extra


_PIXELS = "path string, band int, row int, col int, value double"


def read_pixels(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """path, band, row, col, value of all rasters below a path; nodata and NaN are left out. window: row, col, rows, cols."""

    def pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raster = decode(data, window)
                row0, col0 = (max(window[0], 0), max(window[1], 0)) if window else (0, 0)
                for band, plane in enumerate(raster.bands):
                    for row in range(row0, row0 + plane.shape[0], 256):
                        part = plane[row - row0 : row - row0 + 256].astype(np.float64)
                        good = ~np.isnan(part) if raster.nodata is None else ~np.isnan(part) & (part != raster.nodata)
                        r, c = np.nonzero(good)
                        if len(r):
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(r)), pa.array(np.full(len(r), band, np.int32)), pa.array((r + row).astype(np.int32)), pa.array((c + col0).astype(np.int32)), pa.array(part[good])], names=["path", "band", "row", "col", "value"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(pixels, _PIXELS)


def read_layers(spark: SparkSession, path: str) -> DataFrame:
    """path, epsg, x0, y0, dx, dy, width, height, bands, nodata, dtype of all rasters below a path."""

    def layers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(1).to_pylist()
            found, tags = [decode(d, (0, 0, 0, 0)) for d in files], [_tags(d)[1] for d in files]
            columns = [batch.column(0), pa.array([r.epsg for r in found], pa.int32())]
            columns += [pa.array([getattr(r, k) for r in found], pa.float64()) for k in ("x0", "y0", "dx", "dy")]
            columns += [pa.array([t.get(tag, (default,))[0] for t in tags], pa.int32()) for tag, default in ((_WIDTH, 0), (_HEIGHT, 0), (_BANDS, 1))]
            columns += [pa.array([r.nodata for r in found], pa.float64()), pa.array([str(r.bands.dtype) for r in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "epsg", "x0", "y0", "dx", "dy", "width", "height", "bands", "nodata", "dtype"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(layers, "path string, epsg int, x0 double, y0 double, dx double, dy double, width int, height int, bands int, nodata double, dtype string")


def encoded(pixels: DataFrame, height: int, width: int, like: Raster, dtype: str = "float32", bands: int = 1, levels: tuple[int, ...] = ()) -> DataFrame:
    """pixels (name, band, row, col, value): name and content, the bytes of one GeoTIFF each; missing cells are nodata.

    levels: factors of overviews.
    """
    cells = pixels.groupBy("name").agg(F.collect_list(F.struct("band", "row", "col", "value")).alias("cells"))
    grid = (like.x0, like.y0, like.dx, like.dy, like.epsg, like.nodata)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cells in batch.column(1):
                flat = cells.values
                plane = np.full((bands, height, width), grid[-1] if grid[-1] is not None else 0, dtype)
                at = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
                plane[at[0], at[1], at[2]] = at[3]
                out.append(encode(Raster(plane, *grid), levels=levels))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["name", "content"])

    return cells.mapInArrow(files, "name string, content binary")
