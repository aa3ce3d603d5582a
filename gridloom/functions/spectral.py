"""Spectral index and masks as column expressions. Missing is NULL; NaN and nodata never enter an aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nodata on disk, and the scene classes that hide the ground.
NODATA = -9999.0
CLOUD_CLASSES = (3, 8, 9, 10)


def index(nir: Column, red: Column) -> Column:
    """(nir - red) / (nir + red), clipped to [-1, 1]; NULL where the sum is 0 or either is missing."""
    total = nir + red
    return F.when(total != 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (nir - red) / total)))


def hidden(scene_class: Column, nodata: int | None = 0) -> Column:
    """Whether a cell is cloud, shadow or missing; a missing class is not a mask."""
    masked = scene_class.isin(*CLOUD_CLASSES)
    if nodata is not None:
        masked = masked | (scene_class == nodata)
    return F.coalesce(masked, F.lit(False))


def mask(value: Column, masked: Column) -> Column:
    return F.when(~masked, value)


def from_nodata(value: Column, nodata: float = NODATA) -> Column:
    """Nodata and NaN to NULL: at every scan."""
    return F.when((value != nodata) & ~F.isnan(value.cast("double")), value)


def to_nodata(value: Column, nodata: float = NODATA) -> Column:
    """NULL and NaN to nodata: at every sink."""
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(nodata)).otherwise(value)


def anomaly(value: Column, climatology: Column) -> Column:
    return value - climatology
