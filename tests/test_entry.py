"""The driver's contract, with and without the corpus subpackage, and the stream."""

import subprocess
import sys
import textwrap

import __spark_entry__
from pyspark.sql import functions as F

from gridloom.plans import registry
from gridloom.streaming.coverage import recompute_touched, windowed_coverage


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(registry.queries()) >= 60


def test_imports_without_the_corpus_subpackage():
    code = """
    import sys
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name == "gridloom.llm" or name.startswith("gridloom.llm.") or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)
    sys.meta_path.insert(0, Gone())
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "anomaly_month" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["period", "row", "col", "anomaly"]


def test_stream_of_tiles(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT timestamp'2021-01-01 05:00:00' AS acq_ts, 'a' AS tile, 3.0D AS cloud UNION ALL SELECT timestamp'2021-01-01 06:00:00', 'b', 5.0D UNION ALL SELECT timestamp'2021-02-01 06:00:00', 'b', 1.0D").write.parquet(source)
    stream = spark.readStream.schema("acq_ts timestamp, tile string, cloud double").parquet(source)
    run = windowed_coverage(stream).writeStream.format("memory").queryName("coverage").outputMode("complete").start()
    run.processAllAvailable()
    run.stop()
    got = spark.table("coverage").orderBy("start").collect()
    assert [(r.tiles_count, r.min_cloud, r.max_cloud) for r in got] == [(2, 3.0, 5.0), (1, 1.0, 1.0)]


def test_touched_months_are_recomputed(spark, tmp_path):
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    for values in ([("2021-01-05", 0.1), ("2021-02-05", 0.9)], [("2021-01-09", 0.3)]):
        batch = spark.createDataFrame(values, "acq string, ndvi double").select(F.to_date("acq").alias("acq"), F.lit(0).alias("row"), F.lit(0).alias("col"), "ndvi")
        recompute_touched(batch, store, out)
    assert {r.period: round(r.ndvi, 6) for r in spark.read.parquet(out).collect()} == {"2021-01": 0.2, "2021-02": 0.9}
