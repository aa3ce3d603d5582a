"""Benchmark decontamination by winnowing, with DataFrame functions only.

Every window of 13 consecutive words has a fingerprint, the least hash of its nine 5-word grams. Neighbouring windows
mostly share theirs, so a document keeps a fingerprint where it changes, and again every nine windows. Each benchmark
window has its own fingerprint; the two sides are joined on it, and each hit is extended: the whole window is compared
word by word at the nine places where it can stand. A shared span of 13 words or more therefore cannot be missed, and
equal hashes of different words do no harm. A benchmark item of fewer than 13 words is one window; for each such length
that occurs, every gram of that length is a fingerprint, and where these items are few, only the grams that have one of
their fingerprints leave the scan. All lengths' fingerprints are made in one pass over the documents.

Arrays are taken apart by the outer forms of explode and inline: for the plain ones the optimizer infers a filter on the
array's size and pushes it, with all that made the array written out inside the lambdas, below the projections.

The benchmark's windows are broadcast only if their bytes, counted, are few; otherwise the join shuffles fingerprints.

Defined results: null texts have no words; items without words have no windows; repeated items count once by item_id;
several rows with one doc_id are judged each by its own text; items with a null item_id are one item, which counts but has
no name in the list; a null doc_id is kept; an empty benchmark contaminates
nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import boxed, pick, stored, table

WINDOW, GRAM = 13, 5
#: Benchmark windows are broadcast up to this size; fingerprints of short items are looked up in place up to this many.
BROADCAST_BYTES, SHORT_PRINTS = 32 << 20, 2000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _SEPARATORS), "")


def _least_of(values: str, step: int) -> Column:
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + step)))


def _grams(size: int) -> Column:
    return F.transform("_h", lambda x, i: F.xxhash64(x, *(F.get("_h", i + k) for k in range(1, size))))


def _reach(width: int) -> int:
    """How many neighbouring windows of so many words one fingerprint can stand for."""
    return WINDOW - GRAM + 1 if width == WINDOW else 1


def _windows(df: DataFrame, widths: list[int]) -> DataFrame:
    """df has words: adds p<width>, the fingerprint of each window of so many words (empty below that many)."""
    df = df.withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    for width in widths:
        gram, name = (GRAM, f"_g{width}") if width == WINDOW else (width, f"_g{width}")
        df = df.withColumn(name, _grams(gram))
        done, least = 1, name
        while done < width - gram + 1:
            step = min(done, width - gram + 1 - done)
            df = df.withColumn(f"_m{done + step}", _least_of(least, step))
            done, least = done + step, f"_m{done + step}"
        whole = F.size("words") - width + 1
        df = df.withColumn(f"p{width}", F.when(whole > 0, F.slice(F.col(least), F.lit(1), whole)).otherwise(F.array().cast("array<bigint>")))
    return df.drop(*(c for c in df.columns if c.startswith("_")))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """benchmark (item_id, text): width, print, item_id, win (words) of each distinct window."""
    items = stored(pick(benchmark, "item_id", "text").select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0), "items")
    short = sorted(r[0] for r in items.filter(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())  # 12 values at most
    sides = []
    for window in [*short, WINDOW]:
        own = items.filter(F.size("words") >= WINDOW if window == WINDOW else F.size("words") == window)
        at = _windows(own, [window]).select("item_id", "words", F.posexplode_outer(f"p{window}").alias("at", "print")).filter("print IS NOT NULL")
        sides.append(at.select(F.lit(window).alias("width"), "print", "item_id", F.slice("words", F.col("at") + 1, F.lit(window)).alias("win")))
    return reduce(DataFrame.unionByName, sides).distinct()


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents (doc_id, text): doc_id, text, rest, n_words, n_hit, items (ids as strings, sorted), spans (hit windows).

    rest: a struct of the document's other columns.
    """
    docs = boxed(documents).withColumn("row_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    windows = stored(benchmark_windows(benchmark), "benchmark-windows")
    size = F.sum(F.aggregate("win", F.lit(64).cast("long"), lambda a, w: a + 16 + F.octet_length(w)))
    counts = {r["width"]: r for r in windows.groupBy("width").agg(F.count_distinct("print").alias("prints"), size.alias("bytes")).collect()}  # 13 rows at most
    if sum(r["bytes"] for r in counts.values()) <= BROADCAST_BYTES:
        windows = F.broadcast(windows)
    short = windows.filter(F.col("width") < WINDOW).select("width", "print").distinct()
    few = sum(r["prints"] for w, r in counts.items() if w < WINDOW) <= SHORT_PRINTS
    wanted: dict[int, list[int]] = {}
    for width, mark in short.collect() if few else []:  # SHORT_PRINTS at most, as counted
        wanted.setdefault(width, []).append(mark)
    widths = sorted({*counts, WINDOW})

    def kept(width: int) -> Column:
        """The fingerprints of one width that go to the join, where they change and at least every reach-th."""
        own = F.transform(f"p{width}", lambda x, i: F.when((x != F.get(f"p{width}", i - 1)) | (i % _reach(width) == 0), F.struct(F.lit(width).alias("width"), F.lit(_reach(width)).alias("reach"), x.alias("print"), i.alias("at"))))
        if width in wanted:
            own = F.transform(f"p{width}", lambda x, i: F.when(x.isin(wanted[width]), F.struct(F.lit(width).alias("width"), F.lit(1).alias("reach"), x.alias("print"), i.alias("at"))))
        return F.array_compact(own)

    prints = _windows(docs.select("doc_id", "row_key", words_of(F.col("text")).alias("words")), widths).select("doc_id", "row_key", *(f"p{w}" for w in widths))
    hits = prints.select("doc_id", "row_key", F.inline_outer(F.concat(*map(kept, widths)))).join(windows, ["width", "print"])
    hits = hits.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("at", "reach", "width", F.col("item_id").cast("string").alias("item"), "win")).alias("hits"))
    judged = docs.join(hits.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("row_key", "hit_key"), F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row_key") == F.col("hit_key")), "left")
    # a row for the one array: no later filter or lambda gets the splitting of the text written into it
    judged = judged.select("doc_id", "text", "rest", "hits", F.explode_outer(F.array(words_of(F.col("text")))).alias("words"))

    def places(hit: Column) -> Column:
        last = F.least(hit["at"] + hit["reach"] - 1, F.size("words") - hit["width"])
        found = F.filter(F.sequence(hit["at"], F.greatest(hit["at"], last)), lambda d: F.slice("words", d + 1, hit["width"]) == hit["win"])
        return F.transform(found, lambda d: F.struct(d.alias("start"), (d + hit["width"]).alias("end"), hit["item"].alias("item")))

    judged = judged.select("doc_id", "text", "rest", F.size("words").cast("long").alias("n_words"), F.sort_array(F.flatten(F.transform("hits", places))).alias("spans"))
    zero = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).alias("upto"))
    add = lambda a, x: F.struct((a["covered"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["upto"], x["start"]))).alias("covered"), F.greatest(a["upto"], x["end"]).alias("upto"))
    n_hit = F.coalesce(F.aggregate("spans", zero, add, lambda a: a["covered"]), F.lit(0).cast("long"))
    items = F.coalesce(F.sort_array(F.array_distinct(F.transform("spans", lambda x: x["item"]))), F.array().cast("array<string>"))
    return judged.select("doc_id", "text", "rest", "n_words", n_hit.alias("n_hit"), items.alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:int,end:int,item:string>>")).alias("spans"))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


SQL = r"""
WITH split AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
  SELECT side, id, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM split
), items AS (
  SELECT id, w, least(13, len(w)) AS k FROM words WHERE side = 'b' AND len(w) > 0
), windows AS (
  SELECT DISTINCT id AS item, k, array_to_string(w[p:p + k - 1], ' ') AS body FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM items)
), docs AS (
  SELECT id, w FROM words WHERE side = 'd'
), places AS (
  SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM docs CROSS JOIN (SELECT DISTINCT k FROM items) WHERE len(w) >= k
), hits AS (
  SELECT places.id, places.k, p, item FROM places JOIN windows ON windows.k = places.k AND windows.body = array_to_string(w[p:p + places.k - 1], ' ')
), covered AS (
  SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY id
), found AS (
  SELECT id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT id, item::VARCHAR AS s FROM hits) GROUP BY id
)
SELECT docs.id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered ON covered.id = docs.id LEFT JOIN found ON found.id = docs.id
"""
