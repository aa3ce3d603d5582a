"""What the corpus operators share: column picking, work folders, and byte-level words in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import checkpoint_dir

#: ASCII white space, the separators of `[^\x20\x09-\x0D]+`.
SPACE = "[\\x20\\x09-\\x0D]+"
#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 4 << 20
#: join_values() broadcasts up to so many values, and those of keys that have more than one row in so many.
FEW_VALUES, HOT_KEYS = 50_000, 2048
#: How many powers of a hash base a worker keeps.
KEPT_POWERS = 1 << 19


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, by exact name; extra columns, even of the same name in another case, go."""
    at = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    missing = sorted(set(names) - set(at))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    numbered = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return numbered.select(*(F.col(f"_c{at[n]}").alias(n) for n in names))


def boxed(df: DataFrame) -> DataFrame:
    """doc_id, text, and rest: all columns but the text as one struct, whatever they are called."""
    at = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    if missing := sorted({"doc_id", "text"} - set(at)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    numbered = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    rest = F.struct(*(F.col(f"_c{i}") for i in range(len(df.columns)) if i != at["text"]))
    return numbered.select(F.col(f"_c{at['doc_id']}").cast("long").alias("doc_id"), F.col(f"_c{at['text']}").cast("string").alias("text"), rest.alias("rest"))


def unboxed(df: DataFrame, like: DataFrame, **new: Column) -> DataFrame:
    """The columns of `like` again; new: expressions for some of them."""
    at = {name: i for i, name in reversed(list(enumerate(like.columns)))}
    new = {"text": F.col("text"), **new}
    given = {at[name]: value for name, value in new.items() if name in at}
    return df.select(*(given.get(i, F.col(f"rest._c{i}")).alias(name) for i, name in enumerate(like.columns)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder for a table that cuts lineage."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """The table written as Parquet to the shared folder and read again; lost executors don't matter."""
    path = work_path(df.sparkSession, what)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._stored_at = path
    return read


def discard(df: DataFrame) -> None:
    """Deletes the files of a stored() table that no later plan reads."""
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def join_values(rows: DataFrame, values: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Joins at most one row of values for each key to rows, of which any key may have any share.

    Values are broadcast if their rows and keys, counted, are few. If they are not, those of hot keys are (there are
    fewer than HOT_KEYS keys that have more than that share of the rows), and only the other rows are shuffled by key.
    how: inner or left. Keys must not be null.
    """
    n, size = values.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct(*on))))).first()
    if n <= FEW_VALUES and (size or 0) <= FEW_VALUES * 64:
        return rows.join(F.broadcast(values), on, how)
    return join_hot(rows, values, on, how)


def join_hot(rows: DataFrame, values: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """join_values() for values that are many."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_times"))
    counts = counts.filter(F.col("_times") > 64)
    total = rows.count()
    hot = stored(counts.filter(F.col("_times") * HOT_KEYS > total).select(*on), "hot-keys")
    own = F.broadcast(stored(values.join(F.broadcast(hot), on, "left_semi"), "hot-values"))
    keys = F.broadcast(hot)
    return rows.join(keys, on, "left_semi").join(own, on, how).unionByName(rows.join(keys, on, "left_anti").join(values, on, how))


def join_counted(rows: DataFrame, values: DataFrame, on: list[str], total: int) -> DataFrame:
    """Inner join of rows with one row of values for each key; n in values says how many of the `total` rows have the key.

    Fewer than HOT_KEYS keys have more than total / HOT_KEYS rows. Their values are broadcast, and only the rows of the
    other keys are shuffled. values is read three times: a stored() table.
    """
    hot = values.filter((F.col("n") > 64) & (F.col("n") * HOT_KEYS > total))
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(values, on))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES, a row at least, for what follows; a smaller bound of the session stays.

    Spark's own bound is 64 MB, of which every task holds several, on both sides of the pipe to Python.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key, "64m")).lower()
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now.rstrip("b")[-1:], 1)
    if int(now.rstrip("bkmg") or 0) * unit > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def same_text() -> Column:
    """A key that tells rows of one doc_id but different texts apart."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("\u0000null")).cast("binary")))


# ---- words of many texts at once -------------------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    step, done = np.uint64(base), 1
    with np.errstate(over="ignore"):
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * step
            step = step * step
            done += m
    return out[:n]


class Power:
    """Powers of an odd base and of its inverse, grown as needed; the worker keeps up to KEPT_POWERS."""

    def __init__(self, base: int):
        self.base = np.uint64(base)
        self.inverse = np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > KEPT_POWERS:  # a very long text's powers go with it
            return powers(self.base, n), powers(self.inverse, n)
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = powers(self.base, size), powers(self.inverse, size)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Power(0xD1342543DE82EF95), Power(0xAF251AF3B0F025B5)


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of texts laid end to end, and words before each text.

    data: UTF-8 bytes. starts: where each text starts, with the end last.
    """
    space = _IS_SPACE[data]
    first = ~space
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    first[1:] &= space[:-1] | cut[1:-1]
    begin = np.flatnonzero(first)
    last = ~space
    last[:-1] &= space[1:] | cut[1:-1]
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, starts)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    with np.errstate(over="ignore"):
        up, down = _BYTES.get(len(data) + 1)
        run = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
        return mix((run[end] - run[begin]) * down[begin] + (end - begin).astype(np.uint64) * _ODD)


def span_sums(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for the words from start to end that does not depend on where they stand (to be mixed)."""
    with np.errstate(over="ignore"):
        up, down = _WORDS.get(len(words) + 1)
        run = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[:-1], out=run[1:])
        return (run[end] - run[start]) * down[start]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k consecutive words (texts are not told apart here)."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    start = np.arange(n - k + 1)
    with np.errstate(over="ignore"):
        return mix(span_sums(words, start, start + k))


def arrow_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each starts (with the end last); nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _cuts(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield at, to - at
        at = to


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 250_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text, or one row: what one numpy pass holds."""
    for at, n in _cuts(batch.column(batch.schema.get_field_index(text)), most):
        yield batch.slice(at, n)


def text_slices(texts: pa.Array, most: int = 1_000_000) -> Iterator[pa.Array]:
    for at, n in _cuts(texts, most):
        yield texts.slice(at, n)
