"""The pipeline's language stage over tables that hold no row to train on."""

import zlib

import corpus_pipeline
import pytest


@pytest.mark.parametrize("lang", [None, "en"])
def test_only_texts_without_a_letter_go(spark, lang):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1][:5]
    texts = ["a clean document", "Ünder", "123 456", "", None]
    docs = spark.createDataFrame([(i, t, lang) for i, t in zip(held, texts, strict=True)], "doc_id long, text string, lang string")
    got = corpus_pipeline.identify_language(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text, r.lang) for r in got) == sorted((i, t, lang) for i, t in zip(held[:2], texts, strict=False))
