"""The corpus pipeline over odd tables, stage by stage, and as a whole."""

import struct
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from gridloom.llm.common import stored
from tests.llm.test_edges import BENCHMARK, TEXTS, documents


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([b for b in BENCHMARK if b[0] is not None], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = documents(spark)
    docs = docs.toDF(*("rest" if c == "TEXT" else c for c in docs.columns))  # Parquet takes no names that differ in case only
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, sf), name)
        assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        docs, kept[name] = after, after.collect()
    at = {n: [tuple(r) for r in rows] for n, rows in kept.items()}
    ids = {n: sorted(r[0] for r in rows if r[0] is not None) for n, rows in at.items()}
    assert set(range(len(TEXTS))) - set(ids["language_id"]) == {0, 1, 2, 18}
    assert 8 in ids["jaccard_join"] and not {9, 10} & set(ids["jaccard_join"])
    by = {r[0]: r for r in at["substring_dedup"] if r[0] is not None}
    tail = TEXTS[7].split(" ", 80)[80]
    assert by[5][1] == TEXTS[5] and 6 not in by and by[7][1] == tail and by[7][4] == len(tail)
    assert by[17][1] == TEXTS[17]
    assert 5 not in ids["decontaminate"] and 17 in ids["decontaminate"]


def test_whole_run_holds_every_token_once(spark, tmp_path):
    sf = str(tmp_path)
    rows = [(i, f"clean document number{i} " + " ".join(f"w{i}x{k}" for k in range(200)), "en", "s", 1) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([BENCHMARK[0]], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text, *_ in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        assert b"".join(x for _, x in sorted(pieces[i])) == struct.pack(f"<{len(ids)}I", *ids)


def test_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
