"""One place that builds the session and knows the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: SQL settings that every query here assumes; cluster sizing stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(master).appName("gridloom")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "12g", **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where that is unset, a local master gets a folder of its own.

    On a cluster it must be set: a folder of one machine would hold parts that others cannot read.

    Also points the context's own checkpoint folder there, for DataFrame.checkpoint().
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not shared:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="gridloom-checkpoint-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared)
    return shared
