"""Shared folders, stored tables and connected components."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    A single-process session without the setting (tests) gets a temporary folder; a cluster must set it.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tracewell-llm-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps, so that steps don't add up on disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent().getParent()
        if path.getName().startswith("llm-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges ``(a, b)``: rows ``(node, component)``, the component being its smallest node.

    Nodes without an edge to another node don't appear. Large-star and small-star steps alternate until nothing
    changes, which takes about as many rounds as the logarithm of the longest chain. A node's neighbours are only
    ever aggregated to their minimum and joined, never gathered; the minima are stored first, so that both sides of
    the joins are plain exchanges that adaptive execution can split.
    """
    spark = edges.sparkSession
    pair = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    now = stored(edges.where("a <> b").select(*pair).distinct(), "edges")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = stored(small, "edges")
        for done in (now, least, large, low):
            forget(done)
        now = after
    release(spark)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
