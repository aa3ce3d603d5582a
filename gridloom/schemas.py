"""The engine's relations, and the check that a table has what an operator reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

RING = "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
FOOTPRINTS = f"id STRING, acq_ts TIMESTAMP, cloud DOUBLE, platform STRING, constellation STRING, collection STRING, rings ARRAY<{RING}>"
LAYERS = "layer_id STRING, kind STRING, scene_id STRING, acq_ts TIMESTAMP, period STRING, band STRING, epsg INT, x0 DOUBLE, y0 DOUBLE, dx DOUBLE, dy DOUBLE, width INT, height INT, nodata DOUBLE, dtype STRING"
PIXELS = "layer_id STRING, row INT, col INT, value FLOAT"
CELLS = "aoi_id STRING, row INT, col INT"


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
