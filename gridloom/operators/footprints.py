"""Exact polygon coverage: footprints against one area, and unions of footprints per timestamp.

The area is a constant of the query. Footprints are convex, so clipping the area by each is exact; unions are measured
by trapezoids. With an EPSG code, degrees are projected to that UTM zone first; without one, areas are planar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.geometry import area, clip, to_utm, union_area

_POINTS = "array<struct<x:double,y:double>>"
_ARROW = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def _projected(ring: np.ndarray, epsg: int | None) -> np.ndarray:
    return ring if epsg is None else np.stack(to_utm(ring[:, 0], ring[:, 1], epsg), axis=1)


def _ring(points: list[dict]) -> np.ndarray:
    return np.array([[p["x"], p["y"]] for p in points], float).reshape(-1, 2)


def overlaps(footprints: DataFrame, aoi: np.ndarray, epsg: int | None = None, least: float = 1e-6) -> DataFrame:
    """footprints (id, acq_ts, cloud, rings): those that cover at least so much of the area: coverage_frac, covered."""
    target = _projected(np.asarray(aoi, float), epsg)
    whole = area(target)
    low, high = aoi.min(axis=0), aoi.max(axis=0)
    outer = F.get("rings", F.lit(0))
    bound = lambda f, k: f(F.transform(outer, lambda p: p[k]))
    near = (bound(F.array_min, "x") <= float(high[0])) & (bound(F.array_max, "x") >= float(low[0])) & (bound(F.array_min, "y") <= float(high[1])) & (bound(F.array_max, "y") >= float(low[1]))

    def clipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [clip(target, _projected(_ring(r), epsg)) for r in batch.column(3).to_pylist()]
            frac = [area(p) / whole if whole and len(p) else 0.0 for p in parts]
            points = [[{"x": float(x), "y": float(y)} for x, y in p] for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(frac, pa.float64()), pa.array(points, _ARROW)], names=["id", "acq_ts", "cloud", "coverage_frac", "covered"])

    slim = footprints.filter(near).select("id", "acq_ts", "cloud", outer.alias("ring"))
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[:3])
    found = slim.mapInArrow(clipped, f"{head}, coverage_frac double, covered {_POINTS}")
    return found.filter(F.col("coverage_frac") >= least)


def union_coverage(found: DataFrame, aoi: np.ndarray, threshold: float, epsg: int | None = None) -> DataFrame:
    """found (acq_ts, cloud, covered): the share of the area that each timestamp's footprints cover together."""
    whole = area(_projected(np.asarray(aoi, float), epsg))

    def measured(pdf: pd.DataFrame) -> pd.DataFrame:
        rings = [_ring(points) for points in pdf.covered]
        frac = union_area(rings) / whole if whole else 0.0
        return pd.DataFrame({"acq_ts": [pdf.acq_ts.iloc[0]], "coverage_frac": [frac], "tiles_count": [len(rings)], "min_cloud": [pdf.cloud.min()], "max_cloud": [pdf.cloud.max()], "has_full_cover": [bool(frac >= threshold)]})

    kind = found.schema["acq_ts"].dataType.simpleString()
    return found.select("acq_ts", "cloud", "covered").groupBy("acq_ts").applyInPandas(measured, f"acq_ts {kind}, coverage_frac double, tiles_count int, min_cloud double, max_cloud double, has_full_cover boolean")
