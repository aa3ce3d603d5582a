"""Names, lists and links as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The archive's bucket and the host that serves the same objects.
BUCKET, HOST = "s3://eodata/", "https://eodata.dataspace.copernicus.eu/"


def split_ids(value: Column) -> Column:
    """Ids between `|`, `,` or `;`, trimmed, without empty ones; no ids for null. First occurrences, in order."""
    parts = F.filter(F.transform(F.split(value, "[;,|]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def join_ids(ids: Column) -> Column:
    return F.array_join(ids, "|")


def folder_name(value: Column) -> Column:
    return F.translate(value, ":/", "__")


def slug(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(value), r"\s+", "_"), r"[^A-Za-z0-9_\-]", "")


def asset_keys(band: str, resolutions: Sequence[int], preferred: int) -> list[str]:
    """The band at its preferred resolution first, then at the others from fine to coarse."""
    rest = sorted(r for r in resolutions if r != preferred)
    return [f"{band}_{r}m" for r in ([preferred] if preferred in resolutions else []) + rest]


def link(asset: Column) -> Column:
    """An asset's usable link: its own if http(s), else the first alternate's, else the bucket's served by the host."""
    web = lambda href: href.rlike("^https?://")
    own = asset["href"]
    other = F.filter(F.map_values(asset["alternate"]), lambda a: web(a["href"]))
    return F.coalesce(F.when(web(own), own), F.get(F.transform(other, lambda a: a["href"]), F.lit(0)), served(own))


def served(href: Column) -> Column:
    """A link into the bucket as a link to the host; else NULL."""
    return F.when(href.startswith(BUCKET), F.concat(F.lit(HOST), href.substr(F.lit(len(BUCKET) + 1), F.length(href))))


def first_link(assets: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(*(link(F.try_element_at(assets, F.lit(k))) for k in keys))


def local_path(root: str, scene: Column, band: str) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit("raw/s2"), scene, F.lit(f"{band}.tif"))


def object_name(url: Column) -> Column:
    """What follows the bucket in gs://bucket/name."""
    return F.regexp_extract(url, r"^gs://[^/]+/(.+)$", 1)


def raster_period(path: Column, aoi: str | None = None) -> Column:
    """The period in a composite's file name, `ndvi_<period>_<aoi>.tif`; empty if it is not one."""
    tail = r"ndvi_(\d{4}-(?:\d{2}|Q[1-4]))_([^/]+)\.tif$"
    found = F.regexp_extract(path, tail, 1)
    return found if aoi is None else F.when(F.lower(F.regexp_extract(path, tail, 2)) == aoi.lower(), found).otherwise("")


def raster_group(path: Column) -> Column:
    """What a raster shows, by its file name."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return (
        F.when(name.startswith("ndvi_anomaly_"), "anomaly")
        .when(name.startswith("ndvi_climatology_"), "climatology")
        .when(name.startswith("pixel_features_"), "features")
        .when(name.startswith("ndvi_"), "composite")
        .otherwise("other")
    )
