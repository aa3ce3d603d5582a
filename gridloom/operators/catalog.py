"""Scene catalog: footprints to coverage, best timestamps per anchor, and best unions of tiles."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_CLOUD = float("inf")


def number(value: Column) -> Column:
    return value.try_cast("double")


def catalog_rows(items: DataFrame, default_collection: str, collection: str | None = None) -> DataFrame:
    """items (id, properties map of strings): the catalog's rows, oldest and clearest first; without a time they go."""
    prop = lambda key: F.try_element_at("properties", F.lit(key))
    rows = items.select(
        "id",
        F.try_to_timestamp(prop("datetime")).alias("datetime"),
        F.coalesce(number(prop("eo:cloud_cover")), number(prop("cloud_cover"))).alias("cloud_cover"),
        prop("platform").alias("platform"),
        prop("constellation").alias("constellation"),
        F.coalesce(F.lit(collection), prop("collection"), F.lit(default_collection)).alias("collection"),
    )
    return rows.filter("datetime IS NOT NULL").orderBy(F.asc("datetime"), F.asc_nulls_last("cloud_cover"))


def search(items: DataFrame, start: date, end: date, max_cloud: float | None = None, max_items: int | None = None) -> DataFrame:
    """items (acq_ts, cloud): a catalog search's predicates: dates inclusive, cloud strictly below."""
    found = items.filter(F.to_date("acq_ts").between(F.lit(start), F.lit(end)))
    if max_cloud is not None:
        found = found.filter(F.col("cloud") < max_cloud)
    return found if max_items is None else found.orderBy(F.asc("acq_ts"), F.asc_nulls_last("cloud")).limit(max_items)


def selector_cloud(properties: Column) -> Column:
    """Cloud as the selection takes it: the other key first, and infinite if neither holds a number."""
    prop = lambda key: F.try_element_at(properties, F.lit(key))
    return F.coalesce(number(prop("cloud_cover")), number(prop("eo:cloud_cover")), F.lit(NO_CLOUD))


def overlapping(tiles: DataFrame, least: float = 1e-6) -> DataFrame:
    return tiles.filter(F.col("coverage_frac") >= least)


def timestamp_coverage(tile_cells: DataFrame, total_cells: int, threshold: float) -> DataFrame:
    """tile_cells (acq_ts, tile, cloud, cell): the share of the area's cells that a timestamp's tiles cover together."""
    grouped = tile_cells.groupBy("acq_ts").agg(F.countDistinct("cell").alias("covered"), F.countDistinct("tile").alias("tiles_count"), F.min("cloud").alias("min_cloud"), F.max("cloud").alias("max_cloud"))
    frac = F.col("covered") / F.lit(total_cells)
    return grouped.select("acq_ts", frac.alias("coverage_frac"), "tiles_count", "min_cloud", "max_cloud", (frac >= threshold).alias("has_full_cover"))


def fully_covered(items: DataFrame, coverage: DataFrame) -> DataFrame:
    return items.join(coverage.filter("has_full_cover").select("acq_ts"), "acq_ts", "left_semi")


def candidates(anchors: DataFrame, timestamps: DataFrame, window_days: int) -> DataFrame:
    """Each anchor with the timestamps whose date is at most half a window away.

    The anchors' windows are taken apart into days, so that the range join is an equi-join of any size.
    """
    if window_days <= 0:
        raise ValueError("window_days must be positive")
    half = window_days // 2
    days = anchors.select("anchor", F.explode(F.sequence(F.date_sub("anchor", half), F.date_add("anchor", half))).alias("day"))
    return timestamps.withColumn("day", F.to_date("acq_ts")).join(days, "day").withColumn("dist_days", F.abs(F.date_diff("day", "anchor"))).drop("day")


def best_per_anchor(found: DataFrame, digits: int | None = 12) -> DataFrame:
    """The clearest timestamp per anchor; then by coverage, distance, tiles and age. Cloud and coverage tie within digits."""
    near = lambda c: F.round(c, digits) if digits is not None else F.col(c)
    order = [near("cloud_score").asc(), near("coverage_frac").desc(), F.asc("dist_days"), F.asc("tiles_count"), F.asc("acq_ts")]
    return found.withColumn("nth", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter("nth = 1").drop("nth")


def top_candidates(found: DataFrame, k: int) -> DataFrame:
    """The k best per anchor by the same keys, exactly compared, with their rank."""
    order = [F.asc("cloud_score"), F.desc("coverage_frac"), F.asc("dist_days"), F.asc("tiles_count"), F.asc("acq_ts")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("rank") <= max(k, 0))


def best_union(tiles: list[tuple[str, float, int]], total: int, threshold: float, most: int) -> tuple[list[str], float, float] | None:
    """tiles (id, cloud, cells as bits): the union that reaches the threshold with the least greatest cloud, then the
    most cells, then the fewest tiles, then the first in order; None if there is none.

    When all tiles may be taken, the least cloud is that of the shortest clear-to-cloudy prefix that reaches the
    threshold, and only subsets of that prefix are left to look at.
    """
    pool = list(enumerate(tiles))
    if most >= len(pool):
        reached, last = 0, None
        for _, (_, cloud, cells) in sorted(pool, key=lambda x: x[1][1]):
            if last is not None and cloud > last:
                break
            reached |= cells
            if last is None and reached.bit_count() >= threshold * total:
                last = cloud
        if last is None:
            return None
        pool = [x for x in pool if x[1][1] <= last]
    best = None
    for k in range(1, min(most, len(pool)) + 1):
        for combo in combinations(pool, k):
            cells, cloud = 0, 0.0
            for _, (_, c, bits) in combo:
                cells |= bits
                cloud = max(cloud, c)
            n = cells.bit_count()
            if n >= threshold * total and (best is None or (cloud, -n, k) < best[0]):
                best = ((cloud, -n, k), [name for _, (name, _, _) in combo], n)
        if best is not None and most >= len(tiles):
            full = 0
            for _, (_, _, bits) in pool:
                full |= bits
            if best[2] == full.bit_count():
                break
    return None if best is None else (best[1], best[0][0], best[2] / total)


def cell_bits(groups: list[np.ndarray]) -> list[int]:
    """Each group of cells as the bits of one integer, by the cells' ranks among all groups' cells."""
    known = np.unique(np.concatenate(groups)) if groups else np.zeros(0)
    out = []
    for cells in groups:
        held = np.zeros(len(known), bool)
        held[np.searchsorted(known, cells)] = True
        out.append(int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little"))
    return out


def unions(tile_cells: DataFrame, total_cells: int, threshold: float, most: int, on_partial: str = "skip") -> DataFrame:
    """tile_cells (acq_ts, tile, cloud, cell): the best union of each timestamp, found once, not once per anchor.

    A timestamp whose tiles overlap the area but reach the threshold in no union is left out, or raises.
    """
    tiles = tile_cells.groupBy("acq_ts", "tile").agg(F.max("cloud").alias("cloud"), F.collect_set("cell").alias("cells"))

    def choose(groups: Iterator[pd.DataFrame]) -> pd.DataFrame:
        pdf = groups.sort_values("tile")
        bits = cell_bits([np.asarray(cells) for cells in pdf.cells])
        found = best_union(list(zip(pdf.tile, pdf.cloud, bits, strict=True)), total_cells, threshold, most)
        if found is None:
            if on_partial == "raise":
                raise ValueError(f"only partial unions at {pdf.acq_ts.iloc[0]}")
            found = ([], 0.0, 0.0)
        made = pd.DataFrame({"acq_ts": [pdf.acq_ts.iloc[0]], "tile_ids": ["|".join(found[0])], "tiles_count": [len(found[0])], "cloud_score": [found[1]], "coverage_frac": [found[2]]})
        return made[made.tiles_count > 0]

    kind = tiles.schema["acq_ts"].dataType.simpleString()
    return tiles.groupBy("acq_ts").applyInPandas(choose, f"acq_ts {kind}, tile_ids string, tiles_count int, cloud_score double, coverage_frac double")


def regular_series(anchors: DataFrame, best: DataFrame, window_days: int, area: float) -> DataFrame:
    """One row per anchor that has any candidate."""
    chosen = best_per_anchor(candidates(anchors, best, window_days))
    return chosen.withColumn("coverage_area", F.col("coverage_frac") * area)


def series_summary(series: DataFrame, column: str) -> DataFrame:
    return series.agg(F.min(column).alias("low"), F.median(column).alias("middle"), F.max(column).alias("high"))
