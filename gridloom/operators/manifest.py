"""Asset manifests, missing files and status logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import asset_keys, first_link, local_path, split_ids

#: The bands, their native resolutions and the preferred one.
BANDS = {"b04": ("B04", (10, 20, 60)), "b08": ("B08", (10, 20, 60)), "scl": ("SCL", (20, 60))}


def from_date(scenes: DataFrame, start: date, time: str = "datetime") -> DataFrame:
    """Scenes with a time at or after the date; none left is an error."""
    kept = scenes.withColumn(time, F.try_to_timestamp(F.col(time).cast("string"))).filter(F.col(time) >= F.lit(start))
    if kept.isEmpty():
        raise ValueError("no scenes on or after the start date")
    return kept


def ordered(scenes: DataFrame, mode: str, cloud: str = "cloud_cover", time: str = "datetime", most: int | None = None) -> DataFrame:
    keys = {"cloud_then_time": [cloud, time], "time": [time], "as_is": []}
    if mode not in keys:
        raise ValueError(f"unknown sort mode: {mode}")
    out = scenes.orderBy(*(F.asc_nulls_last(k) for k in keys[mode])) if keys[mode] else scenes
    return out if most is None else out.limit(most)


def manifest(scenes: DataFrame, items: DataFrame, root: str, resolution: int = 10) -> DataFrame:
    """scenes (scene_id, …) with each band's link and local path; scenes that anchors share stay as often as they are."""
    joined = scenes.join(items.select(F.col("id").alias("scene_id"), "assets"), "scene_id", "left")
    links, paths = {}, {}
    for column, (band, resolutions) in BANDS.items():
        at = [k for key in asset_keys(band, resolutions, resolution if resolution in resolutions else min(resolutions)) for k in (key, key.lower())]
        links[f"href_{column}"] = first_link(F.col("assets"), [*at, band, band.lower()])
        paths[f"local_{column}"] = local_path(root, F.col("scene_id"), band)
    return joined.withColumns({**links, **paths}).drop("assets")


def to_download(ordered_scenes: DataFrame, first: int | None) -> DataFrame:
    """The first scenes of an ordered manifest; none if the number is not above zero, all if there is none."""
    return ordered_scenes if first is None else ordered_scenes.limit(max(0, first))


def missing_links(rows: DataFrame) -> DataFrame:
    absent = F.col("href_b04").isNull() | F.col("href_b08").isNull() | F.col("href_scl").isNull()
    return rows.agg(F.count_if(absent).alias("missing"))


def download_status(has_links: Column, complete: Column, is_local: Column, valid: Column, error: Column) -> Column:
    return (
        F.when(error.isNotNull(), "exception")
        .when(~has_links, "skipped_missing_href")
        .when(~complete, "download_incomplete")
        .when(~is_local, "skipped_no_local_for_validation")
        .when(~valid, "validation_failed")
        .otherwise("success")
    )


def exploded_tiles(series: DataFrame) -> DataFrame:
    """series (acq_ts, tile_ids): a row per tile, in the union's order."""
    return series.select("acq_ts", F.posexplode(split_ids(F.col("tile_ids"))).alias("tile_ord", "tile"))


def tile_files(series: DataFrame, files: DataFrame) -> DataFrame:
    """Each timestamp's tiles, in the union's order, with their files (acq_ts, tile, path); NULL where there is none."""
    return exploded_tiles(series).join(files, ["acq_ts", "tile"], "left")


def of_bands(files: DataFrame, bands: tuple | None) -> DataFrame:
    return files if bands is None else files.filter(F.col("band").isin(*bands))


def missing_files(required: DataFrame, existing: DataFrame, keys: list[str], bands: tuple | None = None) -> DataFrame:
    """The required files that do not exist; with bands, no others are required."""
    return of_bands(required, bands).join(existing.select(*keys).distinct(), keys, "left_anti")


def complete_timestamps(required: DataFrame, existing: DataFrame, keys: list[str], bands: tuple | None = None) -> DataFrame:
    """The required files of those timestamps that miss none; with bands, no others are required."""
    short = missing_files(required, existing, keys, bands).select("acq_ts").distinct()
    return of_bands(required, bands).join(short, "acq_ts", "left_anti")


def first_files(files: DataFrame) -> DataFrame:
    """files (folder, band, path): each band's first file in a folder, at 10 m if there is one."""
    fine = F.col("path").contains("10m")
    best = files.groupBy("folder", "band").agg(F.min_by("path", F.struct((~fine).alias("coarse"), "path")).alias("path"))
    return best


def status_counts(log: DataFrame, status: str = "status") -> DataFrame:
    return log.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def merged_log(*logs: DataFrame) -> DataFrame:
    """Rows of logs with different columns."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out


def regions_named(regions: DataFrame, name: str, column: str = "NAME_LATN") -> DataFrame:
    """The first region of that name, in any case; none is an error."""
    found = regions.filter(F.lower(column) == name.lower()).orderBy(column).limit(1)
    if found.isEmpty():
        raise ValueError(f"no region of that name: {name}")
    return found


def region_coded(regions: DataFrame, code: str, key: str = "NUTS_ID") -> DataFrame:
    """The regions of one code; none is an error."""
    found = regions.filter(F.col(key) == code)
    if found.isEmpty():
        raise ValueError(f"no region of that code: {code}")
    return found


def regions_like(regions: DataFrame, pattern: str, most: int, column: str = "NAME_LATN", key: str = "NUTS_ID") -> DataFrame:
    return regions.filter(F.col(column).rlike(pattern)).orderBy(key).limit(most)


def regions_where(regions: DataFrame, level: int | None = None, country: str | None = None, ids: list[str] | None = None) -> DataFrame:
    if level is not None:
        regions = regions.filter(F.col("LEVL_CODE") == level)
    if country is not None:
        regions = regions.filter(F.col("CNTR_CODE") == country.upper())
    return regions if ids is None else regions.filter(F.col("NUTS_ID").isin(ids))
