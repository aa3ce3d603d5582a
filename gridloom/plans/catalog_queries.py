"""Queries of catalogs, manifests, names and regions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import periods, text
from gridloom.operators import catalog, manifest
from gridloom.plans.inputs import ANCHOR_VALUES, ANCHORS, EVT, REG, THRESHOLD, WINDOW_DAYS, r6, regions, table, tile_cells, total_cells
from gridloom.plans.registry import query


def _items(spark, d) -> DataFrame:
    """events as catalog items with properties."""
    events = table(spark, d, "events")
    clouds = {"eo:cloud_cover": F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string")), "cloud_cover": F.when(F.col("event_id") % 4 != 0, (F.col("value") + 1).cast("string")), "datetime": F.when(F.col("event_id") % 11 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), "platform": F.col("event_type")}
    pairs = [x for k, v in clouds.items() for x in (F.lit(k), v)]
    return events.select(F.col("event_id").cast("string").alias("id"), F.create_map(*pairs).alias("properties"))


@query(
    "catalog_rows",
    """SELECT event_id::VARCHAR AS id, date_trunc('second', ts) AS datetime, CASE WHEN event_id % 3 = 0 THEN value WHEN event_id % 4 <> 0 THEN value + 1 END AS cloud_cover, event_type AS platform, NULL::VARCHAR AS constellation, 'optical' AS collection FROM events WHERE event_id % 11 <> 0""",
)
def catalog_rows(spark, d):
    return catalog.catalog_rows(_items(spark, d), "optical").withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query("selector_cloud", "SELECT event_id::VARCHAR AS id, CASE WHEN event_id % 4 <> 0 THEN value + 1 WHEN event_id % 3 = 0 THEN value ELSE -1 END AS cloud FROM events")
def selector_cloud(spark, d):
    cloud = catalog.selector_cloud(F.col("properties"))
    return _items(spark, d).select("id", F.when(cloud == catalog.NO_CLOUD, -1.0).otherwise(cloud).alias("cloud"))


@query("cloud_lt", "SELECT event_id, value AS cloud FROM events WHERE value < 20 AND ts >= DATE '2024-01-05' AND ts < DATE '2024-01-21' ORDER BY ts, value, event_id LIMIT 100")
def cloud_lt(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("ts").alias("acq_ts"), F.col("value").alias("cloud"))
    found = catalog.search(events, date(2024, 1, 5), date(2024, 1, 20), max_cloud=20)
    return found.orderBy("acq_ts", "cloud", "event_id").limit(100).select("event_id", "cloud")


@query("max_items", "SELECT value AS cloud FROM events WHERE value < 20 AND ts >= DATE '2024-01-05' AND ts < DATE '2024-01-21' ORDER BY ts, value LIMIT 100")
def max_items(spark, d):
    events = table(spark, d, "events").select(F.col("ts").alias("acq_ts"), F.col("value").alias("cloud"))
    return catalog.search(events, date(2024, 1, 5), date(2024, 1, 20), max_cloud=20, max_items=100).select("cloud")


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("anchor_dates", "SELECT (DATE '2023-01-01' + floor((i + 0.5) * (DATE '2026-03-23' - DATE '2023-01-01') / 18)::INTEGER)::DATE::VARCHAR AS anchor FROM range(18) t(i)")
def anchor_dates(spark, d):
    return spark.createDataFrame([(a,) for a in periods.midpoint_anchors(date(2023, 1, 1), date(2026, 3, 23), 18)], "anchor date")


def _coverage(spark, d) -> DataFrame:
    return catalog.timestamp_coverage(tile_cells(spark, d), total_cells(spark, d), THRESHOLD)


@query("timestamp_coverage", EVT + f" SELECT acq::VARCHAR AS acq, round(coverage_frac, 6) + 0.0 AS coverage_frac, tiles_count, min_cloud, max_cloud, coverage_frac >= {THRESHOLD} AS has_full_cover FROM cov")
def timestamp_coverage(spark, d):
    return _coverage(spark, d).withColumn("coverage_frac", r6(F.col("coverage_frac"))).withColumn("acq", F.to_date("acq_ts")).drop("acq_ts")


@query("full_cover_semi", EVT + f" SELECT acq::VARCHAR AS acq, tile, cloud FROM clouds WHERE acq IN (SELECT acq FROM cov WHERE coverage_frac >= {THRESHOLD})")
def full_cover_semi(spark, d):
    items = tile_cells(spark, d).select("acq_ts", "tile", "cloud").distinct()
    return catalog.fully_covered(items, _coverage(spark, d)).select(F.to_date("acq_ts").alias("acq"), "tile", "cloud")


CAND = EVT + f""", anchors(anchor) AS (VALUES {ANCHOR_VALUES}),
cand AS (SELECT anchor, acq, max_cloud AS cloud_score, coverage_frac, tiles_count, abs(acq - anchor) AS dist_days FROM anchors JOIN cov ON acq BETWEEN anchor - {WINDOW_DAYS // 2} AND anchor + {WINDOW_DAYS // 2})"""


def _candidates(spark, d) -> DataFrame:
    timestamps = _coverage(spark, d).select("acq_ts", F.col("max_cloud").alias("cloud_score"), "coverage_frac", "tiles_count")
    anchors = spark.createDataFrame([(a,) for a in ANCHORS], "anchor date")
    return catalog.candidates(anchors, timestamps, WINDOW_DAYS)


def _dated(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({"acq": F.to_date("acq_ts"), "coverage_frac": r6(F.col("coverage_frac"))}).select("anchor", "acq", *columns)


@query("anchor_candidates", CAND + " SELECT anchor::VARCHAR AS anchor, acq::VARCHAR AS acq, dist_days::BIGINT AS dist_days FROM cand")
def anchor_candidates(spark, d):
    return _dated(_candidates(spark, d), F.col("dist_days").cast("long").alias("dist_days"))


@query("anchor_best", CAND + " SELECT anchor::VARCHAR AS anchor, acq::VARCHAR AS acq, cloud_score, round(coverage_frac, 6) + 0.0 AS coverage_frac FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY round(cloud_score, 12), -round(coverage_frac, 12), dist_days, tiles_count, acq) AS nth FROM cand) WHERE nth = 1")
def anchor_best(spark, d):
    return _dated(catalog.best_per_anchor(_candidates(spark, d)), "cloud_score", "coverage_frac")


@query("anchor_topk", CAND + " SELECT anchor::VARCHAR AS anchor, acq::VARCHAR AS acq, nth AS rank FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY cloud_score, coverage_frac DESC, dist_days, tiles_count, acq) AS nth FROM cand) WHERE nth <= 3")
def anchor_topk(spark, d):
    return _dated(catalog.top_candidates(_candidates(spark, d), 3), F.col("rank").cast("long").alias("rank"))


@query("regular_series", CAND + " SELECT anchor::VARCHAR AS anchor, acq::VARCHAR AS acq, round(coverage_frac * 1000, 6) + 0.0 AS coverage_area FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY round(cloud_score, 12), -round(coverage_frac, 12), dist_days, tiles_count, acq) AS nth FROM cand) WHERE nth = 1")
def regular_series(spark, d):
    timestamps = _coverage(spark, d).select("acq_ts", F.col("max_cloud").alias("cloud_score"), "coverage_frac", "tiles_count")
    anchors = spark.createDataFrame([(a,) for a in ANCHORS], "anchor date")
    made = catalog.regular_series(anchors, timestamps, WINDOW_DAYS, 1000.0)
    return made.select("anchor", F.to_date("acq_ts").alias("acq"), r6(F.col("coverage_area")).alias("coverage_area"))


@query("series_summary", CAND + " SELECT min(cloud_score) AS low, round(median(cloud_score), 6) + 0.0 AS middle, max(cloud_score) AS high FROM cand")
def series_summary(spark, d):
    return catalog.series_summary(_candidates(spark, d), "cloud_score").withColumn("middle", r6(F.col("middle")))


UNION = EVT + """, one AS (SELECT acq, tile AS ids, 1 AS k, cloud, count(*) AS n FROM tc GROUP BY acq, tile, cloud),
two AS (SELECT a.acq, a.tile || '|' || b.tile AS ids, 2 AS k, greatest(any_value(a.cloud), any_value(b.cloud)) AS cloud, NULL AS n FROM clouds a JOIN clouds b ON a.acq = b.acq AND a.tile < b.tile GROUP BY a.acq, a.tile, b.tile),
twon AS (SELECT two.acq, ids, k, two.cloud, count(DISTINCT cell) AS n FROM two JOIN tc ON tc.acq = two.acq AND (tc.tile = split_part(ids, '|', 1) OR tc.tile = split_part(ids, '|', 2)) GROUP BY ALL),
every AS (SELECT * FROM one UNION ALL SELECT * FROM twon WHERE {two}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY acq ORDER BY cloud, n DESC, k, ids) AS nth FROM every WHERE n >= {least} * (SELECT n FROM total))
SELECT acq::VARCHAR AS acq, ids AS tile_ids, k::INTEGER AS tiles_count, cloud AS cloud_score, round(n / (SELECT n FROM total), 6) + 0.0 AS coverage_frac FROM ranked WHERE nth = 1"""


def _unions(spark, d, least: float, most: int) -> DataFrame:
    made = catalog.unions(tile_cells(spark, d), total_cells(spark, d), least, most)
    return made.withColumns({"acq": F.to_date("acq_ts"), "coverage_frac": r6(F.col("coverage_frac"))}).drop("acq_ts")


@query("union_k1", UNION.format(two="false", least=0.35))
def union_k1(spark, d):
    return _unions(spark, d, 0.35, 1)


@query("union_k2", UNION.format(two="true", least=0.6))
def union_k2(spark, d):
    return _unions(spark, d, 0.6, 2)


IDS = "WITH l AS (SELECT l_orderkey, string_agg(' ' || l_suppkey, ', ' ORDER BY l_linenumber, l_suppkey) AS ids FROM lineitem GROUP BY l_orderkey)"


def _id_lists(spark, d) -> DataFrame:
    own = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("x"))
    mark = F.when(F.col("l_orderkey") % 3 == 0, "|").when(F.col("l_orderkey") % 3 == 1, ", ").otherwise(";;")
    joined = F.aggregate("x", F.lit(None).cast("string"), lambda a, v: F.when(a.isNull(), F.concat(F.lit(" "), v["l_suppkey"].cast("string"))).otherwise(F.concat(a, F.col("mark"), F.lit(" "), v["l_suppkey"].cast("string"))))
    return own.withColumn("mark", mark).select("l_orderkey", joined.alias("ids"))


@query("tile_ids_split", IDS + ", s AS (SELECT l_orderkey, trim(x) AS tile, pos FROM (SELECT l_orderkey, unnest(p) AS x, unnest(range(len(p))) AS pos FROM (SELECT l_orderkey, regexp_split_to_array(ids, '[;,|]') AS p FROM l))) SELECT l_orderkey, tile, count(*)::BIGINT AS n FROM (SELECT DISTINCT l_orderkey, tile FROM s WHERE tile <> '') GROUP BY ALL")
def tile_ids_split(spark, d):
    return _id_lists(spark, d).select("l_orderkey", F.explode(text.split_ids(F.col("ids"))).alias("tile")).groupBy("l_orderkey", "tile").agg(F.count(F.lit(1)).alias("n"))


@query("tile_ids_join", "WITH f AS (SELECT l_orderkey, l_suppkey, min(l_linenumber) AS pos FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, '|' ORDER BY pos, l_suppkey) AS tile_ids FROM f GROUP BY l_orderkey")
def tile_ids_join(spark, d):
    return _id_lists(spark, d).select("l_orderkey", text.join_ids(text.split_ids(F.col("ids"))).alias("tile_ids"))


@query("manifest_sort_cap", "SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS cloud, o_orderdate FROM orders WHERE o_orderdate >= DATE '1996-01-01') ORDER BY cloud NULLS LAST, o_orderdate NULLS LAST, o_orderkey LIMIT 50")
def manifest_sort_cap(spark, d):
    scenes = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("datetime"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("cloud_cover"))
    return manifest.ordered(manifest.from_date(scenes, date(1996, 1, 1)), "cloud_then_time", most=50).select("o_orderkey")


REQ = "WITH req AS (SELECT DISTINCT o_orderdate::DATE AS acq, l_linenumber AS band FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber <= 3), have AS (SELECT DISTINCT l_shipdate::DATE AS acq, l_linenumber AS band FROM lineitem WHERE l_quantity > 10)"


#: The bands, by line number, that a timestamp must have.
REQUIRED = (1, 2, 3)


def _files(spark, d) -> tuple[DataFrame, DataFrame]:
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    required = orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(F.to_date("o_orderdate").alias("acq_ts"), F.col("l_linenumber").alias("band")).distinct()
    return required, lines.filter("l_quantity > 10").select(F.to_date("l_shipdate").alias("acq_ts"), F.col("l_linenumber").alias("band"))


@query("download_first", "SELECT o_orderkey, o_totalprice AS cloud FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def download_first(spark, d):
    scenes = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("cloud"))
    return manifest.to_download(manifest.ordered(scenes, "cloud_then_time", time="o_orderkey", cloud="cloud"), 20)


@query(
    "tile_files",
    """WITH seen AS (SELECT date_trunc('day', ts)::DATE AS acq, event_type AS tile, min(event_id) AS first FROM events GROUP BY ALL)
SELECT acq::VARCHAR AS acq, (row_number() OVER (PARTITION BY acq ORDER BY tile) - 1)::INTEGER AS tile_ord, tile, CASE WHEN first % 3 <> 0 THEN '/' || tile || '_' || first || '.tif' END AS path FROM seen""",
)
def tile_files(spark, d):
    seen = table(spark, d, "events").groupBy(F.to_date("ts").alias("acq_ts"), F.col("event_type").alias("tile")).agg(F.min("event_id").alias("first"))
    series = seen.groupBy("acq_ts").agg(F.array_join(F.sort_array(F.collect_set("tile")), "|").alias("tile_ids"))
    files = seen.filter("first % 3 <> 0").select("acq_ts", "tile", F.concat(F.lit("/"), F.col("tile"), F.lit("_"), F.col("first").cast("string"), F.lit(".tif")).alias("path"))
    return manifest.tile_files(series, files).select(F.col("acq_ts").alias("acq"), "tile_ord", "tile", "path")


@query("nuts_code", REG + ' SELECT nuts_id AS "NUTS_ID", name AS "NAME_LATN", level AS "LEVL_CODE", country AS "CNTR_CODE" FROM reg WHERE nuts_id = \'N07\'')
def nuts_code(spark, d):
    return manifest.region_coded(regions(spark, d), "N07")


@query("missing_anti", REQ + " SELECT acq::VARCHAR AS acq, band FROM req WHERE (acq, band) NOT IN (SELECT acq, band FROM have)")
def missing_anti(spark, d):
    return manifest.missing_files(*_files(spark, d), ["acq_ts", "band"], REQUIRED).withColumnRenamed("acq_ts", "acq")


@query("complete_timestamps", REQ + " SELECT acq::VARCHAR AS acq, band FROM req WHERE acq NOT IN (SELECT acq FROM req WHERE (acq, band) NOT IN (SELECT acq, band FROM have))")
def complete_timestamps(spark, d):
    return manifest.complete_timestamps(*_files(spark, d), ["acq_ts", "band"], REQUIRED).withColumnRenamed("acq_ts", "acq")


@query(
    "status_counts",
    """SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 31 = 0 THEN 'exception' WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'skipped_missing_href' WHEN o_orderkey % 5 = 0 THEN 'download_incomplete'
WHEN o_orderkey % 7 = 0 THEN 'skipped_no_local_for_validation' WHEN o_orderkey % 11 = 0 THEN 'validation_failed' ELSE 'success' END AS status FROM orders) GROUP BY status""",
)
def status_counts(spark, d):
    k = F.col("o_orderkey")
    status = manifest.download_status(~((k % 2 == 0) & (k % 3 == 0)), k % 5 != 0, k % 7 != 0, k % 11 != 0, F.when(k % 31 == 0, "error"))
    return manifest.status_counts(table(spark, d, "orders").select(status.alias("status")))


@query("missing_href_count", "SELECT count(*) FILTER (WHERE page_id % 5 = 0 OR page_id % 7 = 0) AS missing FROM pages")
def missing_href_count(spark, d):
    rows = table(spark, d, "pages").select(F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("href_b04"), F.col("url").alias("href_b08"), F.when(F.col("page_id") % 7 != 0, F.col("url")).alias("href_scl"))
    return manifest.missing_links(rows)


@query("first_band_file", "SELECT source AS folder, lang AS band, min('/' || n_chars || '.tif') AS path FROM documents GROUP BY ALL")
def first_band_file(spark, d):
    files = table(spark, d, "documents").select(F.col("source").alias("folder"), F.col("lang").alias("band"), F.concat(F.lit("/"), F.col("n_chars").cast("string"), F.lit(".tif")).alias("path"))
    return manifest.first_files(files)


@query(
    "href_pick",
    f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://mirror.example/' || page_id ELSE '{text.HOST}' || 'S2/' || page_id END AS href FROM pages""",
)
def href_pick(spark, d):
    pages = table(spark, d, "pages")
    bucket = F.concat(F.lit(text.BUCKET), F.lit("S2/"), F.col("page_id").cast("string"))
    mirror = F.create_map(F.lit("https"), F.struct(F.concat(F.lit("https://mirror.example/"), F.col("page_id").cast("string")).alias("href")))
    asset = F.struct(F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(bucket).alias("href"), F.when(F.col("page_id") % 3 == 1, mirror).alias("alternate"))
    assets = F.create_map(F.when(F.col("page_id") % 2 == 0, "B04_20m").otherwise("B04_60m"), asset)
    return pages.withColumn("assets", assets).select("page_id", text.first_link(F.col("assets"), text.asset_keys("B04", (10, 20, 60), 10)).alias("href"))


@query("path_build", "SELECT page_id, 'cache/raw/s2/' || page_id || '/B04.tif' AS path, regexp_extract('gs://bucket/a/' || page_id, '^gs://[^/]+/(.+)$', 1) AS name FROM pages")
def path_build(spark, d):
    scene = F.col("page_id").cast("string")
    return table(spark, d, "pages").select("page_id", text.local_path("cache", scene, "B04").alias("path"), text.object_name(F.concat(F.lit("gs://bucket/a/"), scene)).alias("name"))


@query("slug", "SELECT page_id, regexp_replace(regexp_replace(trim(url || ' é x'), '\\s+', '_', 'g'), '[^A-Za-z0-9_\\-]', '', 'g') AS slug, translate(url, ':/', '__') AS folder FROM pages")
def slug(spark, d):
    return table(spark, d, "pages").select("page_id", text.slug(F.concat(F.col("url"), F.lit(" é x"))).alias("slug"), text.folder_name(F.col("url")).alias("folder"))


@query(
    "period_names",
    """WITH n AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders) SELECT day::VARCHAR AS day, strftime(day, '%Y-%m') AS month, year(day) || '-Q' || quarter(day) AS quarter, date_trunc('quarter', day)::DATE::VARCHAR AS quarter_start,
make_date(year(day), month(day), 15)::VARCHAR AS month_mid, make_date(year(day), 3 * quarter(day) - 1, 15)::VARCHAR AS quarter_mid, strftime(day, '%b') AS name FROM n""",
)
def period_names(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    month = periods.month_label(F.col("day"))
    quarter = periods.month_to_quarter(month)
    return days.select("day", month.alias("month"), quarter.alias("quarter"), periods.quarter_start(quarter).alias("quarter_start"), periods.period_mid(month).alias("month_mid"), periods.period_mid(quarter).alias("quarter_mid"), periods.month_name(F.month("day")).alias("name"))


@query(
    "raster_files",
    """WITH f AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/o/ndvi_2021-0' || (page_id % 9 + 1) || '_el522.tif' WHEN 1 THEN '/o/ndvi_anomaly_2021-Q2_el522.tif' WHEN 2 THEN '/o/ndvi_climatology_median_05_el522.tif' WHEN 3 THEN '/o/pixel_features_7d_el522.tif' ELSE '/o/b04.tif' END AS path FROM pages)
SELECT page_id, regexp_extract(path, 'ndvi_(\\d{4}-(?:\\d{2}|Q[1-4]))_([^/]+)\\.tif$', 1) AS period, CASE page_id % 5 WHEN 0 THEN 'composite' WHEN 1 THEN 'anomaly' WHEN 2 THEN 'climatology' WHEN 3 THEN 'features' ELSE 'other' END AS kind FROM f""",
)
def raster_files(spark, d):
    k = F.col("page_id") % 5
    path = F.when(k == 0, F.concat(F.lit("/o/ndvi_2021-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("_el522.tif"))).when(k == 1, "/o/ndvi_anomaly_2021-Q2_el522.tif").when(k == 2, "/o/ndvi_climatology_median_05_el522.tif").when(k == 3, "/o/pixel_features_7d_el522.tif").otherwise("/o/b04.tif")
    return table(spark, d, "pages").select("page_id", text.raster_period(path).alias("period"), text.raster_group(path).alias("kind"))


_REG_OUT = ' SELECT nuts_id AS "NUTS_ID", name AS "NAME_LATN", level AS "LEVL_CODE", country AS "CNTR_CODE" FROM reg '


@query("nuts_exact", REG + _REG_OUT + "WHERE lower(name) = 'nation_7' OR lower(name) = lower('France') ORDER BY name LIMIT 1")
def nuts_exact(spark, d):
    names = {r.NAME_LATN.lower() for r in regions(spark, d).select("NAME_LATN").collect()}
    return manifest.regions_named(regions(spark, d), "FRANCE" if "france" in names else "NATION_7")


@query("nuts_contains", REG + _REG_OUT + "WHERE regexp_matches(name, 'A|_1') ORDER BY nuts_id LIMIT 5")
def nuts_contains(spark, d):
    return manifest.regions_like(regions(spark, d), "A|_1", 5)


@query("nuts_filter", REG + _REG_OUT + "WHERE level = 1 AND country = 'EU' AND nuts_id IN ('N01', 'N05', 'N09', 'N13', 'N17', 'N21')")
def nuts_filter(spark, d):
    return manifest.regions_where(regions(spark, d), 1, "eu", ["N01", "N05", "N09", "N13", "N17", "N21"])


@query("merged_log", "SELECT 'a' AS step, o_orderstatus AS status, count(*) AS n, NULL::VARCHAR AS note FROM orders GROUP BY ALL UNION ALL SELECT 'b', 'done', 0, 'ok'")
def merged_log(spark, d):
    counts = manifest.status_counts(table(spark, d, "orders"), "o_orderstatus").select(F.lit("a").alias("step"), F.col("o_orderstatus").alias("status"), "n")
    return manifest.merged_log(counts, spark.createDataFrame([("b", "done", "ok", 0)], "step string, status string, note string, n long"))
