"""Token counts through a digest cache.

The cache is a Parquet table (content digest, n_tokens, partitioned by tokenizer digest) in a shared folder. Documents are joined to it
by the digest of their normalised content (null becomes the empty text, nothing else changes, as any other change could
alter the count) and of the tokenizer's file. Digests are compared first; only
distinct contents without an entry are encoded, each once, and appended; then the counts are joined back. A run that is cut short leaves whole files or none, and two runs that add the
same entry do no harm, as entries are read distinct.

Defined results: null and empty texts have the empty text's count; repeated rows each get a row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import FEW_VALUES, bounded_batches, discard, join_values, pick, slices, stored, table, work_path

ENTRY = "content binary, n_tokens long"
TOKENIZER = "piece_bpe_32k.model"
_loaded: dict[str, object] = {}


def _counter(path: str):
    """A function from texts to their numbers of tokens; loaded once a worker."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            words = Tokenizer.from_file(path)
            _loaded[path] = lambda texts: [len(x.ids) for x in words.encode_batch(texts, add_special_tokens=False)]
    return _loaded[path]


def tokenizer_digest(path: str) -> bytes:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).digest()


def _folder(cache: str, version: bytes) -> str:
    return f"{cache.rstrip('/')}/tokenizer={version.hex()}"


def _read(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """This tokenizer's entries, each once; none if the folder is new."""
    folder = _folder(cache, version)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        spark.createDataFrame([], ENTRY).write.mode("append").parquet(folder)
    return spark.read.schema(ENTRY).parquet(folder).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _digested(documents: DataFrame) -> DataFrame:
    docs = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("content", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def fill(documents: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """Encodes the contents that the cache lacks and appends them; returns doc_id, n_bytes, content of each document.

    Only digests are joined to the cache. Texts are read again for the misses alone, and if there is none, not at all.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    version = tokenizer_digest(tokenizer)
    digested = _digested(documents)
    keys = stored(digested.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "digests")
    misses = stored(keys.select("content").distinct().join(_read(spark, cache, version), "content", "left_anti"), "misses")
    count = misses.count()
    if not count:
        return keys

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counter(part.column(1).to_pylist()), pa.int64())], names=["content", "n_tokens"])

    wanted = F.broadcast(misses) if count <= FEW_VALUES else misses
    texts = digested.select("content", "text").join(wanted, "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
    texts.mapInArrow(encode, ENTRY).write.mode("append").parquet(_folder(cache, version))
    discard(misses)
    return keys


def token_counts(documents: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """documents (doc_id, text): doc_id, n_bytes, n_tokens. cache: the table's folder. tokenizer: its file."""
    keys = fill(documents, cache, tokenizer)
    counts = _read(documents.sparkSession, cache, tokenizer_digest(tokenizer))
    return join_values(keys, counts, ["content"]).select("doc_id", "n_bytes", "n_tokens")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice over one cache that starts empty: the first time all are misses, the second time all are hits."""
    documents, cache, tokenizer = table(spark, sf_dir, "documents"), work_path(spark, "token-cache"), public_tokenizers.path(TOKENIZER)
    discard(fill(documents, cache, tokenizer))
    return token_counts(documents, cache, tokenizer).withColumn("over_limit", F.col("n_tokens") > 4096)
