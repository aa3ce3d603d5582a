"""Substring dedup by seed and extend.

A window is `length` consecutive words. In each window the least hash of its `seed`-word grams is its anchor (the
leftmost, if several are least), so equal windows have equal anchors at equal places wherever they stand, and every
repeat of `length` words or more shares an anchor. The windows around one anchor occurrence form a run of overlapping
windows, the whole stretch by which a match can extend to both sides of that anchor.

1. All runs are grouped by (anchor, content of the run), with map-side minima. Where a smaller document holds the same
   run, the match extends over all of it, and all its words go.
2. Of each such group one document is left. Where its anchor also stands in other runs, those matches extend only part
   of the way: for these runs alone the single windows are compared, again by grouped minima.
3. Matches that overlap or touch join to maximal stretches as the words they cover are marked and removed.

No pair of documents is ever built: a passage in a million documents costs a million rows, which are combined before
the shuffle; back to them, what is known of such hot runs and windows is broadcast, so that no task holds all their rows. Anchors, runs and windows are told apart by 64-bit hashes, and always by two of them at once.

Defined results: null and empty texts have no words; documents shorter than a window keep all words; of equal texts the
one with the smallest doc_id keeps its words; rows that agree in doc_id are no sources for each other; a null doc_id
counts as larger than all others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from gridloom.llm.common import arrow_bytes, bounded_batches, boxed, discard, gram_hashes, join_counted, mix, slices, span_sums, stored, table, word_hashes, word_spans

_MAX = (1 << 63) - 1
_A, _B, _C = (np.uint64(x) for x in (0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
LENGTH, SEED = 50, 8


def _leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, where the least of the next `width` values is (the leftmost of several)."""
    at, size = np.arange(len(values), dtype=np.int32), 1
    least = values
    while size < width:
        step = min(size, width - size)
        left = least[:-step] <= least[step:]
        at = np.where(left, at[:-step], at[step:])
        least = np.where(left, least[:-step], least[step:])
        size += step
    return at


class Runs:
    """The runs of some texts: first window, last window, anchor and content, by the word numbers of all texts."""

    def __init__(self, texts: pa.Array, length: int, seed: int):
        data, starts = arrow_bytes(texts)
        begin, end, self.first = word_spans(data, starts)
        self.length = length
        self.words = words = word_hashes(data, begin, end)
        n = len(words)
        none = np.zeros(0, np.int64)
        self.text_of = self.start = self.stop = none
        self.anchor = self.content = none.astype(np.uint64)
        if n < length:
            return
        text_of = np.repeat(np.arange(len(starts) - 1), np.diff(self.first))
        grams = gram_hashes(words, seed)
        anchor_at = _leftmost_minimum(grams, length - seed + 1)  # one for each window
        windows = n - length + 1
        whole = text_of[:windows] == text_of[length - 1 :]
        change = np.ones(windows, bool)
        change[1:] = (anchor_at[1:] != anchor_at[:-1]) | (whole[1:] != whole[:-1]) | (text_of[1:windows] != text_of[: windows - 1])
        start = np.flatnonzero(change)
        stop = np.append(start[1:], windows)
        good = whole[start]
        self.start, self.stop = start[good], stop[good]  # windows start .. stop-1
        self.text_of = text_of[self.start]
        at = anchor_at[self.start]
        self.anchor = grams[at]
        with np.errstate(over="ignore"):
            span = span_sums(words, self.start, self.stop + length - 1)
            self.content = mix(mix(span) + (self.stop - self.start).astype(np.uint64) * _A + (at - self.start).astype(np.uint64) * _B)

    def keys(self) -> np.ndarray:
        """One number for (anchor, content), to find runs again within one text."""
        with np.errstate(over="ignore"):
            return mix(self.anchor * _A + self.content)

    def windows(self) -> np.ndarray:
        return gram_hashes(self.words, self.length)


def _mine(text_of: np.ndarray, values: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which values are in the list of their text."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    owner = np.repeat(np.arange(len(lists)), sizes).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.isin(values + mix(text_of.astype(np.uint64) + _C), flat + mix(owner + _C))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def remove_repeats(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """documents (doc_id, text): doc_id, text, rest, kept (words kept, joined by one space), n_words, n_removed.

    rest: a struct of the document's other columns.
    """
    bounded_batches(documents.sparkSession)
    docs = boxed(documents).select(
        "doc_id",
        "rest",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        "text",
    )
    kinds = StructType([*docs.select("doc_id", "text", "rest").schema, StructField("kept", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())])

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                runs = Runs(part.column(2), length, seed)
                _, once = np.unique(np.stack([runs.anchor, runs.content, runs.text_of.astype(np.uint64)]), axis=1, return_index=True) if len(runs.start) else (0, np.zeros(0, np.int64))
                at = pa.array(runs.text_of[once])
                yield pa.RecordBatch.from_arrays([_signed(runs.anchor[once]), _signed(runs.content[once]), _signed(runs.keys()[once]), part.column(0).take(at), part.column(1).take(at)], names=["anchor", "content", "run", "id", "key"])

    all_runs = stored(docs.select("id", "key", "text").mapInArrow(seeds, "anchor long, content long, run long, id long, key long"), "runs")
    groups = all_runs.groupBy("anchor", "content").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"))
    anchors = groups.groupBy("anchor").agg(F.min("least").alias("low"), F.max("least").alias("high"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND low < high").select("anchor", F.lit(True).alias("parts"))
    known = stored(groups.join(anchors, "anchor", "left").filter("least < most OR parts"), "known-runs")
    judged = join_counted(all_runs, known, ["anchor", "content"], all_runs.count()).select("id", "key", "run", (F.col("id") > F.col("least")).alias("gone"), "parts")
    judged = stored(judged.filter("gone OR parts"), "judged-runs")
    discard(known)
    discard(all_runs)

    # single windows, where a run is matched in part
    partly = judged.filter("NOT gone").groupBy("id", "key").agg(F.collect_set("run").alias("wanted"))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                runs = Runs(part.column(2), length, seed)
                mine = _mine(runs.text_of, runs.keys(), part.column(3))
                start, stop = runs.start[mine], runs.stop[mine]
                sizes = stop - start
                at = np.repeat(start - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum()) if len(sizes) else start
                anchor, text_of, window = np.repeat(runs.anchor[mine], sizes), np.repeat(runs.text_of[mine], sizes), runs.windows()[at]
                _, once = np.unique(np.stack([window, text_of.astype(np.uint64)]), axis=1, return_index=True) if len(at) else (0, at)
                at = pa.array(text_of[once])
                yield pa.RecordBatch.from_arrays([_signed(anchor[once]), _signed(window[once]), part.column(0).take(at), part.column(1).take(at)], names=["anchor", "window", "id", "key"])

    windows = stored(docs.select("id", "key", "text").join(partly, ["id", "key"]).mapInArrow(single, "anchor long, window long, id long, key long"), "windows")
    sources = stored(windows.groupBy("anchor", "window").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n")).filter("least < most"), "sources")
    gone_windows = join_counted(windows, sources, ["anchor", "window"], windows.count()).filter("id > least").select("id", "key", F.lit(None).cast("long").alias("run"), "window")
    gone = judged.filter("gone").select("id", "key", "run", F.lit(None).cast("long").alias("window")).unionByName(gone_windows)
    gone = gone.groupBy("id", "key").agg(F.collect_set("run").alias("runs"), F.collect_set("window").alias("windows"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [(t or "").encode().split() for t in part.column(2).to_pylist()]  # splits at ASCII white space
                n_words = np.array([len(t) for t in texts], np.int64)
                n_removed = np.zeros(len(texts), np.int64)
                hit = np.flatnonzero(np.array([bool(r) or bool(w) for r, w in zip(part.column(3).is_valid().to_pylist(), part.column(4).is_valid().to_pylist(), strict=True)], bool))
                if len(hit):
                    some = part.take(pa.array(hit))
                    runs = Runs(some.column(2), length, seed)
                    edge = np.zeros(len(runs.words) + 1, np.int64)
                    whole = _mine(runs.text_of, runs.keys(), some.column(3))
                    np.add.at(edge, runs.start[whole], 1)
                    np.add.at(edge, runs.stop[whole] + length - 1, -1)
                    text_of = np.repeat(np.arange(len(hit)), np.diff(runs.first))
                    every = runs.windows()
                    inside = text_of[: len(every)] == text_of[length - 1 :] if len(every) else np.zeros(0, bool)
                    at = np.flatnonzero(_mine(text_of[: len(every)], every, some.column(4)) & inside)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
                    kept = np.cumsum(edge)[:-1] == 0
                    for i, doc in enumerate(hit):
                        own = kept[runs.first[i] : runs.first[i + 1]]
                        texts[doc] = list(compress(texts[doc], own.tolist()))
                        n_removed[doc] = n_words[doc] - len(texts[doc])
                kept_text = pa.array([b" ".join(t).decode() for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(1), kept_text, pa.array(n_words), pa.array(n_removed)], names=kinds.names)

    whole = docs.join(gone, ["id", "key"], "left").select("doc_id", "rest", "text", "runs", "windows")
    return whole.mapInArrow(keep, kinds)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos0 FROM words WHERE len(w) >= 50
), windows AS (
  SELECT doc_id, pos0, md5(array_to_string(w[pos0:pos0 + 49], ' ')) AS body FROM starts
), judged AS (
  SELECT doc_id, pos0, min(doc_id) OVER (PARTITION BY body) AS least FROM windows
), removed AS (
  SELECT doc_id, list(DISTINCT pos) AS gone FROM (SELECT doc_id, unnest(range(pos0, pos0 + 50)) AS pos FROM judged WHERE least < doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS k
  FROM words LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""
