"""N-gram Jaccard join with Bayesian candidate pruning.

1. Every whole text becomes its set of five-word shingles (64-bit hashes) and 128 one-byte MinHash values. Documents
   with one and the same set form a class, and from here on a class counts once, with its size.
2. Candidates share one of 32 bands of four values: a pair at similarity 0.8 is missed with probability 5e-8. Within a
   bucket values are compared sixteen at a time, and a pair is dropped as soon as the posterior probability that it
   reaches the threshold (uniform prior) is below the tolerance. What is left of a bucket is only needed as a graph, so
   a bucket yields a spanning forest of it, never its pairs; a large bucket is cut into blocks that meet two by two.
3. In each component of that graph all pairs are pruned the same way and the rest is verified exactly, in bounded blocks
   of texts (intersections by a matrix product where many pairs are left). A block yields, for each class, how many
   documents it is linked to, and a spanning forest of the verified links; their components are the groups.

Result: doc_id, class_id (the least doc_id of the group), n_links (how many other documents are at the threshold or
above, copies included). Words are runs of anything but ASCII white space, unchanged.

Defined results: a text of one to four words is one shingle; null texts and texts without words have no links and are
their own class; rows that agree in doc_id and text are one document, and rows of one doc_id with different texts are
documents of their own, each judged by its own text; a null doc_id has no class and no links; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import arrow_bytes, bounded_batches, boxed, gram_hashes, mix, pick, slices, stored, table, unboxed, word_hashes, word_spans
from gridloom.llm.components import components

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
VALUES, BAND, STEP = 128, 4, 16
#: Most classes of a block of step 2 and of step 3, and most shingles of a block of step 3.
BUCKET_BLOCK, VERIFY_BLOCK, VERIFY_SHINGLES = 4096, 1000, 1_000_000
_LONGS = [f"s{i}" for i in range(VALUES // 8)]
_draw = np.random.default_rng(20)
_FACTOR = (_draw.integers(0, 1 << 32, VALUES, np.uint64) | np.uint64(1)).astype(np.uint32)
_TERM = _draw.integers(0, 1 << 32, VALUES, np.uint64).astype(np.uint32)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending."""
    data, starts = arrow_bytes(texts)
    begin, end, first = word_spans(data, starts)
    words = word_hashes(data, begin, end)
    grams = gram_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = np.sort(grams[a : b - k + 1]) if b - a >= k else gram_hashes(words[a:b], b - a) if b > a else grams[:0]
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def signature(own: np.ndarray) -> np.ndarray:
    """One-byte MinHash values of a set that is not empty."""
    x = (own >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (x[at : at + 1024, None] * _FACTOR + _TERM).min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


@lru_cache
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values, the fewest matches at which a pair stays."""
    grid = (np.arange(4000) + 0.5) / 4000
    match = grid + (1 - grid) / 256
    out = np.zeros(VALUES + 1, np.int64)
    for n in range(STEP, VALUES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(match) + (n - m) * np.log1p(-match)
            weight = np.exp(log - log.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out[n] = m
                break
    return out


def prune(left: np.ndarray, right: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which pairs of rows of two tables of signatures stay."""
    stay, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for at in range(0, VALUES, STEP):
        matches = matches + (left[stay, at : at + STEP] == right[stay, at : at + STEP]).sum(axis=1)
        good = matches >= bounds[at + STEP]
        stay, matches = stay[good], matches[good]
    return stay


def prune_one(one: np.ndarray, rest: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return prune(np.broadcast_to(one, rest.shape), rest, bounds)


def spanning(sigs: np.ndarray, side: np.ndarray | None, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what pruning leaves connected. side: if given, only rows of different sides are compared."""
    left, edges = np.arange(len(sigs)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            now = queue.pop()
            among = np.arange(len(left)) if side is None else np.flatnonzero(side[left] != side[now])
            hit = among[prune_one(sigs[now], sigs[left[among]], bounds)]
            found = left[hit]
            edges += [(now, int(x)) for x in found]
            queue += found.tolist()
            left = np.delete(left, hit)
    return edges


def linked(sets: list[np.ndarray], side: np.ndarray | None, threshold: float, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of sets whose exact similarity reaches the threshold."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    i, j = np.triu_indices(m, 1)
    if side is not None:
        across = side[i] != side[j]
        i, j = i[across], j[across]
    sigs = np.array([signature(s) for s in sets])
    parts = [at + prune(sigs[i[at : at + 65536]], sigs[j[at : at + 65536]], bounds) for at in range(0, len(i), 65536)]
    stay = np.concatenate(parts) if parts else i[:0]
    i, j = i[stay], j[stay]
    if len(i) <= 8 * m:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    else:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
        _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
        number = np.cumsum(times > 1) - 1
        shared = times[place] > 1
        place, owner = number[place[shared]], owner[shared]
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        product = np.zeros((m, m), np.float32)
        for at in range(0, int(number[-1]) + 1, 4096):
            lo, hi = np.searchsorted(place, [at, at + 4096])
            block = np.zeros((m, 4096), np.float32)
            block[owner[lo:hi], place[lo:hi] - at] = 1
            product += block @ block.T
        common = product[i, j].astype(np.int64)
    union = sizes[i] + sizes[j] - common
    good = common >= np.ceil(threshold * union - 1e-9)
    return i[good], j[good]


def forest(m: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs."""
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    order = np.argsort(i, kind="stable")
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
            if len(out) == m - 1:
                break
    return out


def _blocks(rows: DataFrame, key: str, node: str, blocks: str) -> DataFrame:
    """Rows dealt to all pairs of blocks of their group that hold them: key, b0, b1 and side."""
    own = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return dealt.withColumn("b0", F.least("own", "other")).withColumn("b1", F.greatest("own", "other")).withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("own", "other")


def _by_group(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key, "b0", "b1").sortWithinPartitions(key, "b0", "b1")


def _groups(batches: Iterator[pa.RecordBatch], prepare) -> Iterator[tuple[tuple, list]]:
    """(key, b0, b1) and what prepare() makes of the rows of each group; a group lies in one partition, sorted."""
    key, rows = None, []
    for batch in batches:
        for part in slices(batch) if "text" in batch.schema.names else [batch]:
            made = prepare(part)
            for k, row in zip(zip(*(part.column(n).to_pylist() for n in range(3)), strict=True), made, strict=True):
                if k != key:
                    if rows:
                        yield key, rows
                    key, rows = k, []
                rows.append(row)
    if rows:
        yield key, rows


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """documents (doc_id, text): doc_id, class_id, n_links."""
    return judged_texts(documents, threshold, tolerance).select("doc_id", "class_id", "n_links")


def judged_texts(documents: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """jaccard_join() with each text's key, and whether it is the one of its group that stays."""
    bounded_batches(documents.sparkSession)
    ids = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = ids.filter("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    bounds = least_matches(threshold, tolerance)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1))
                some = [i for i, s in enumerate(sets) if len(s)]
                with np.errstate(over="ignore"):
                    h1 = [int(mix(sets[i]).sum().view(np.int64)) for i in some]
                    h2 = [int((mix(sets[i] ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(sets[i]))).view(np.int64)) for i in some]
                values = np.array([signature(sets[i]) for i in some], np.uint8).reshape(len(some), VALUES).view(np.int64)
                own = part.take(pa.array(some, pa.int64()))
                columns = [own.column(0), own.column(2), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array([len(sets[i]) for i in some], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(values[:, i])) for i in range(len(_LONGS)))], names=["id", "key", "h1", "h2", "n", *_LONGS])

    kinds = ", ".join(f"{c} long" for c in ["id", "key", "h1", "h2", "n", *_LONGS])
    signed = stored(docs.select(F.col("doc_id"), "text", "key").mapInArrow(sign, kinds), "signatures")
    one = signed.groupBy("id", "key").agg(*(F.first(c).alias(c) for c in ("h1", "h2", "n", *_LONGS)))
    first = [F.first(c).alias(c) for c in ("n", *_LONGS)]
    classes = one.groupBy("h1", "h2").agg(F.min(F.struct("id", "key")).alias("r"), F.count(F.lit(1)).alias("size"), *first)
    # a class is named by its least doc_id; where a doc_id has several texts, all but one are named by a hash of id and text
    several = signed.groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low < high").select("id", "low")
    classes = classes.select("h1", "h2", "r.id", "r.key", "size", "n", *_LONGS).join(several, "id", "left")
    name = F.when(F.coalesce(F.col("key") == F.col("low"), F.lit(True)), F.col("id")).otherwise(F.xxhash64("id", "key", F.lit("of several")))
    classes = stored(classes.select("h1", "h2", name.alias("rep"), "id", "key", "size", "n", *_LONGS), "classes")

    # buckets of candidates
    halves = [x for i, c in enumerate(_LONGS) for x in (F.lit(2 * i << 32) + F.col(c).bitwiseAND(0xFFFFFFFF), F.lit(2 * i + 1 << 32) + F.shiftrightunsigned(c, 32))]
    bands = classes.select("rep", F.explode(F.array(*halves)).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket", F.ceil(F.col("n") / BUCKET_BLOCK).alias("blocks"))
    members = bands.join(shared, "bucket").join(classes.select("rep", *_LONGS), "rep")
    dealt = _by_group(_blocks(members, "bucket", "rep", "blocks").select("bucket", "b0", "b1", "side", "rep", *_LONGS), "bucket")

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def prepare(part: pa.RecordBatch) -> list:
            values = np.stack([part.column(5 + i).to_numpy() for i in range(len(_LONGS))], axis=1) if part.num_rows else np.zeros((0, len(_LONGS)), np.int64)
            return list(zip(part.column(4).to_pylist(), part.column(3).to_pylist(), values.view(np.uint8), strict=True))

        edges: set[tuple[int, int]] = set()
        twos: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if twos:
                stay = prune(np.array([x[0][2] for x in twos]), np.array([x[1][2] for x in twos]), bounds)
                edges.update((twos[i][0][0], twos[i][1][0]) for i in stay.tolist())
                twos.clear()
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[n] for e in edges], pa.int64()) for n in (0, 1)], names=["a", "b"])
                edges.clear()

        for (_, b0, b1), rows in _groups(batches, prepare):
            if len(rows) == 2 and b0 == b1:
                twos.append((rows[0], rows[1]))
            elif len(rows) > 1:
                side = np.array([x[1] for x in rows]) if b0 != b1 else None
                edges.update((rows[a][0], rows[b][0]) for a, b in spanning(np.array([x[2] for x in rows]), side, bounds))
            if len(twos) + len(edges) > 20_000:
                yield from flush()
        yield from flush()

    near = components(dealt.mapInArrow(connect, "a long, b long").distinct())

    # exact verification within the components
    nodes = stored(near.join(classes.select(F.col("rep").alias("node"), "id", "key", "size", "n"), "node"), "nodes")
    spread = nodes.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / VERIFY_BLOCK), F.ceil(F.sum("n") / VERIFY_SHINGLES)).alias("blocks"))
    # a sort-merge join at every size: the texts' one shuffle is then in proportion to the input
    texts = docs.select(F.col("doc_id").alias("id"), "key", "text").join(nodes.join(spread, "root").hint("merge"), ["id", "key"]).dropDuplicates(["id", "key"])
    dealt = _by_group(_blocks(texts, "root", "node", "blocks").select("root", "b0", "b1", "side", "node", "size", "text"), "root")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def prepare(part: pa.RecordBatch) -> list:
            return list(zip(part.column(4).to_pylist(), part.column(5).to_pylist(), part.column(3).to_pylist(), shingle_sets(part.column(6)), strict=True))

        out: list[tuple[int, int | None, int]] = []
        for (_, b0, b1), rows in _groups(batches, prepare):
            side = np.array([x[2] for x in rows]) if b0 != b1 else None
            i, j = linked([x[3] for x in rows], side, threshold, bounds)
            size, links = np.array([x[1] for x in rows]), np.zeros(len(rows), np.int64)
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            out += [(rows[x][0], None, int(links[x])) for x in np.flatnonzero(links).tolist()]
            out += [(rows[a][0], rows[b][0], 0) for a, b in forest(len(rows), i, j)]
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], pa.int64()) for n in range(3)], names=["node", "other", "links"])
                out = []
        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], pa.int64()) for n in range(3)], names=["node", "other", "links"])

    verified = stored(dealt.mapInArrow(verify, "node long, other long, links long"), "links")
    groups = components(verified.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    judged = classes.select("h1", "h2", F.col("rep").alias("node"), "id", "key", "size").join(groups, "node", "left").join(links, "node", "left")
    judged = stored(judged.withColumn("root", F.coalesce("root", "node")).withColumn("links", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).cast("long")), "judged")
    least = judged.groupBy("root").agg(F.min(F.struct("id", "key")).alias("least"))
    judged = judged.select("root", "h1", "h2", "links").join(least, "root").select("h1", "h2", "least", "links")
    of_text = one.select("id", "key", "h1", "h2").join(judged, ["h1", "h2"]).select(F.col("id").alias("doc_id"), "key", F.col("least.id").alias("class_id"), F.col("links").alias("n_links"), (F.struct("id", "key") == F.col("least")).alias("stays"))
    keyed = ids.select("doc_id", F.xxhash64("text").alias("key"))
    done = keyed.join(of_text, ["doc_id", "key"], "left")
    return done.select("doc_id", "key", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("stays", F.lit(True)).alias("stays"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each group with all its columns: the least doc_id, and of its texts the one with the least hash.

    Rows that agree in doc_id and text are one document, of which one row stays; without a doc_id, all rows stay.
    """
    stay = judged_texts(documents).filter("stays AND doc_id IS NOT NULL").select("doc_id", "key").distinct()
    box = boxed(documents).withColumn("key", F.xxhash64("text"))
    named = box.filter("doc_id IS NOT NULL").join(stay.hint("merge"), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    return unboxed(named.unionByName(box.filter("doc_id IS NULL")), documents)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
