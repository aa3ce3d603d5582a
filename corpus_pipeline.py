"""The corpus pipeline: from documents to packed training sequences.

Each stage calls one operator on all that its predecessor kept, written as Parquet and read again; all but the last
return the columns of documents. Every stage takes nulls in any column, empty and very long texts, repeated rows, empty
tables and extra columns of any name, as its operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, jaccard_join, language_id, sequence_packing, substring_dedup
from gridloom.llm.common import discard, stored, table, unboxed


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, as they have no letter, go; no others do, even if no row is labelled."""
    return language_id.identified(docs, language_id.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has too go; so do documents with no word left."""
    done = substring_dedup.remove_repeats(docs).filter("n_words > n_removed OR n_words = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    new = {"n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unboxed(done, docs, text=text, **new)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return unboxed(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter(~decontaminate.contaminated()), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a sequence, with its token ids as little-endian unsigned 32-bit numbers."""
    done = sequence_packing.pack(docs, public_tokenizers.path(sequence_packing.TOKENIZER))
    return done.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("packing", pack_sequences),
]

#: No SQL expresses language ID or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
