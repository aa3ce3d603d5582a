"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by (first 60 bits of the text's md5, doc_id). Splitters between shards are found without sorting:
each round counts, across all partitions, the exact bytes below candidate boundaries (the next 12 or 16 bits of the
key), keeps the one interval in which each wanted boundary lies, and probes inside it, until the interval holds no more
than the tolerance or a single key: at most 2**16 counts a boundary between shards and round come to the driver, whatever
the number of rows or tasks. Then all rows, texts included, are exchanged once, into runs: hash ranges of a shard, whose
number follows the bytes and which the plan does not list. A run is sorted by key, and a slot is a row's place in its run
after all earlier runs of its shard, as counted.

Copies of one text have one hash, so a group of copies that holds much of the table lies in one hash range; such hashes are
found by count, and ranges of the doc_id divide them into more runs. The doc_id is also the part of the key that lets a
boundary between shards pass through such a group.

Law `bytes`: with tolerance 0 a row is in shard floor(n * bytes before it / all bytes). Defined results: a null text has
size 1 (as the empty text) and the empty text's hash; a null doc_id sorts first; rows that agree in doc_id and text get
distinct slots; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import FEW_VALUES, pick, stored, table

HASH_BITS = 60
#: Widths of the key's digits: five of the hash, four of the doc_id.
DIGITS = [12] * 5 + [16] * 4
_MIN, _MAX = -(1 << 63), (1 << 63) - 1
#: Bytes of a sorted run at which more tasks are asked for than there are shuffle partitions.
PART_BYTES = 64 << 20
_RUN = ["shard", "bucket", "segment", "sub"]
#: Ranges, by quantiles of its doc_ids, of a text that has too many copies for one run; each is divided evenly if need be.
MARKS = 64


@dataclass
class Splitter:
    """A boundary that is wanted after so many bytes; the key interval in which it lies."""

    target: int
    tolerance: int
    level: int = 0
    prefix: tuple[int, int] = (0, 0)
    below: int = 0
    done: bool = False

    @property
    def last_key(self) -> tuple[int, int]:
        """The largest key of the interval: rows above it are above the boundary."""
        used = sum(DIGITS[: self.level])
        if used <= HASH_BITS:
            return ((self.prefix[0] + 1) << (HASH_BITS - used)) - 1, _MAX
        left = 64 - (used - HASH_BITS)
        return self.prefix[0], ((self.prefix[1] + 1) << left) - 1


def _prefix(level: int) -> tuple[Column, Column]:
    """The first digits of the key: of the hash, and of the doc_id, whose first digit has the sign."""
    used = sum(DIGITS[:level])
    of_hash = F.shiftright("hash", max(0, HASH_BITS - used))
    left = 64 - max(0, used - HASH_BITS)
    if left == 64:
        return of_hash, F.lit(0).cast("long")
    return of_hash, F.shiftright("id", left)


def find_splitters(keys: DataFrame, splitters: list[Splitter]) -> None:
    """keys: hash, id, size. Refines all splitters at once, a round for each digit of the key."""
    while active := [s for s in splitters if not s.done]:
        level = active[0].level
        mine = sorted({s.prefix for s in active})
        old, new = _prefix(level), _prefix(level + 1)
        rows = keys
        if level:
            rows = rows.filter(old[0].isin([p[0] for p in mine]) & old[1].isin([p[1] for p in mine]))
        counted = rows.groupBy(old[0].alias("p0"), old[1].alias("p1"), new[0].alias("q0"), new[1].alias("q1")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        found: dict[tuple[int, int], list] = {}
        for p0, p1, q0, q1, size, n in sorted(map(tuple, counted.collect())):  # at most 2**16 a splitter
            found.setdefault((p0, p1), []).append(((q0, q1), size, n))
        for s in active:
            below, buckets = s.below, found[s.prefix]
            for q, size, n in buckets:
                if below + size >= s.target:
                    break
                below += size
            s.prefix, s.below, s.level = q, below, level + 1
            s.done = n == 1 or size <= s.tolerance or s.level == len(DIGITS)


def _part(bounds: list[tuple[int, int]], low: int = 0) -> Column:
    """How many of the ascending bounds lie below the row's key, by a decision tree."""
    if not bounds:
        return F.lit(low)
    at = len(bounds) // 2
    hash_, id_ = bounds[at]
    above = (F.col("hash") > F.lit(hash_)) | ((F.col("hash") == F.lit(hash_)) & (F.col("id") > F.lit(id_)))
    return F.when(above, _part(bounds[at + 1 :], low + at + 1)).otherwise(_part(bounds[:at], low))


def histogram_shards(documents: DataFrame, shards: int = 8, parts: int | None = None, tolerance: int = 0, part_bytes: int = PART_BYTES) -> DataFrame:
    """documents (doc_id, text): doc_id, text, size, shard, slot.

    parts: about how many sorted runs the exchange makes; by default as many as there are shuffle partitions, and so many
    that a run has about part_bytes. tolerance: bytes by which a boundary between shards may be off.
    """
    spark = documents.sparkSession
    docs = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long")
    hash_ = F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    keyed = docs.select("doc_id", "text", size.alias("size"), hash_.alias("hash"), F.coalesce("doc_id", F.lit(_MIN)).alias("id"))
    keys = stored(keyed.select("hash", "id", "size"), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // part_bytes)
    bits = max(1, 4 * (parts or tasks) - 1).bit_length()  # several buckets a task: hashes fill them evenly
    splitters = [Splitter(-(-k * total // shards), tolerance) for k in range(1, shards)] if total else []
    find_splitters(keys, splitters)
    cuts = [s.last_key for s in sorted(splitters, key=lambda s: s.target)]

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("shard", _part(cuts)).withColumn("bucket", F.shiftright("hash", HASH_BITS - bits))

    # copies of one text have one hash: those over so many times the even share are divided by ranges of doc_ids
    even = max(1, total >> bits) * max(2, (1 << bits) // FEW_VALUES)
    loads = stored(keys.groupBy("hash").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > even), "heavy-texts")  # FEW_VALUES at most
    marks = F.percentile_approx("id", F.array(*(F.lit(i / MARKS) for i in range(MARKS + 1))), F.lit(10_000))
    heavy = keys.join(F.broadcast(loads), "hash").groupBy("hash").agg(F.ceil(F.first("bytes") / (even * MARKS)).alias("times"), marks.alias("marks"))
    heavy = stored(placed(heavy.withColumn("id", F.lit(0).cast("long"))).groupBy("bucket").agg(F.collect_list(F.struct("hash", "times", "marks")).alias("heavy")), "heavy-buckets")

    def divided(rows: DataFrame) -> DataFrame:
        beside = placed(rows).join(F.broadcast(heavy), "bucket", "left")
        own = F.filter("heavy", lambda x: x["hash"] == F.col("hash"))
        beside = beside.withColumn("segment", F.coalesce(2 * F.size(F.filter("heavy", lambda x: x["hash"] < F.col("hash"))) + F.size(own), F.lit(0)))
        beside = beside.withColumn("own", F.get(own, 0)).withColumn("mark", F.size(F.filter("own.marks", lambda m: m < F.col("id"))))
        low, high = (F.get("own.marks", F.col("mark") - k).cast("double") for k in (1, 0))
        inner = F.least(F.floor((F.col("id").cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * F.col("own.times")), F.col("own.times"))
        sub = F.when(F.col("own").isNotNull(), F.col("mark") * (F.col("own.times") + 1) + F.coalesce(inner, F.lit(0)))
        return beside.withColumn("sub", F.coalesce(sub, F.lit(0)).cast("long")).drop("heavy", "own", "mark")

    runs = divided(keys).groupBy(*_RUN).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket", "segment", "sub")
    offsets = stored(runs.select(*_RUN, (F.sum("n").over(before) - F.col("n")).alias("offset")), "offsets")
    if offsets.count() <= FEW_VALUES:
        offsets = F.broadcast(offsets)
    dealt = divided(keyed)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(tasks, *_RUN)
    sorted_ = dealt.withColumn("nth", F.row_number().over(Window.partitionBy(*_RUN).orderBy("hash", "id")).cast("long"))
    return sorted_.join(offsets, _RUN).select("doc_id", "text", "size", F.col("shard").cast("int").alias("shard"), (F.col("nth") - 1 + F.col("offset")).alias("slot"))


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = histogram_shards(table(spark, sf_dir, "documents"), shards=8)
    return done.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

