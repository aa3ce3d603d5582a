"""What must not grow: candidates of long hosts, plans of many tasks, work of a warm cache, and joins of hot keys."""

import tracemalloc

import public_tokenizers
from pyspark.sql import functions as F

from gridloom.llm import common, components, histogram_shards, substring_dedup, token_counts, url_filter


def test_a_long_host_makes_few_candidates(tmp_path):
    (tmp_path / "a.bin").write_bytes(url_filter.digest_array(url_filter.RULES))
    digests = url_filter.DigestArray(str(tmp_path / "a.bin"))
    long = "x." * 500_000
    tracemalloc.start()
    host, path, rule, verdict = digests.judge([f"http://{long}a.example.com/en/71", f"http://{long}example.com/en/6", f"http://{'y' * 1_000_000}/en/6", f"http://{'.' * 1_000_000}com/en/1"])
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()
    assert rule == ["example.com/en/7", "com/en/", None, "com/en/"] and verdict == ["allow", "block", None, "block"]


def test_the_plan_of_shards_does_not_grow_with_the_tasks(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    sizes, slots = [], []
    for parts in (40, 4000):
        done = histogram_shards.histogram_shards(docs, 8, parts=parts)
        sizes.append(len(done._jdf.queryExecution().optimizedPlan().toString()))
        rows = done.collect()
        slots.append(sorted((r.shard, r.slot, r.doc_id) for r in rows))
        for shard in range(8):
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert sizes[1] < 1.2 * sizes[0] and slots[0] == slots[1]


def test_a_warm_cache_encodes_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    cache, path = common.work_path(spark, "warm"), public_tokenizers.path("piece_bpe_32k.model")
    first = sorted(map(tuple, token_counts.token_counts(docs, cache, path).collect()))
    files = sorted(spark.read.parquet(cache).inputFiles())
    assert sorted(map(tuple, token_counts.token_counts(docs, cache, path).collect())) == first
    assert sorted(spark.read.parquet(cache).inputFiles()) == files


def test_hot_keys_join_as_others_do(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    values = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        want = sorted(map(str, rows.join(values, "k", how).collect()))
        assert sorted(map(str, common.join_hot(rows, values, ["k"], how).collect())) == want
        assert sorted(map(str, common.join_values(rows, values, ["k"], how).collect())) == want


def test_counted_keys_join_as_others_do(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    values = common.stored(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v")).filter("k % 2 = 0"), "values")
    want = sorted(map(str, rows.join(values, "k").collect()))
    assert sorted(map(str, common.join_counted(rows, values, ["k"], rows.count()).collect())) == want


def test_components_of_hubs_and_a_long_path(spark):
    hub = [(5, 10_000 + i) for i in range(3000)] + [(1, 20_000 + i) for i in range(500)] + [(20_007, 10_007)]
    path = [(100_000 + i, 100_001 + i) for i in range(200)]
    edges = spark.createDataFrame([*hub, *path, (7, 7), (300_002, 300_001), (300_001, 300_002)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    want = dict.fromkeys([1, 5, *range(10_000, 13_000), *range(20_000, 20_500)], 1) | dict.fromkeys(range(100_000, 100_201), 100_000) | {300_001: 300_001, 300_002: 300_001}
    assert got == want


def test_a_passage_of_most_documents_goes_from_all_but_one(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, f"{passage} " + " ".join(f"own{i}x{k}" for k in range(55)) if i % 3 else f"own{i} " + passage[:passage.rindex("p57")]) for i in range(300)]
    done = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in done.collect()}
    # document 0 holds 57 of the 60 words, document 1 all of them
    want = {i: (115, 57 if i == 1 else 60) if i % 3 else (58, 57 if i else 0) for i in range(300)}
    assert got == want
