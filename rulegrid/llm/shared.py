"""Intermediate tables in the cluster's shared folder, and connected components.

Lineage is cut by writing Parquet under ``spark.checkpoint.dir``, which driver and executors share, so
a lost executor costs a re-read of those files and nothing that only it held.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one in the warehouse, which is shared as well."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def ship(spark: SparkSession) -> SparkSession:
    """Send this library's code to the Python workers of the session's executors, once per session."""
    sc = spark.sparkContext
    if getattr(sc, "_rulegrid_shipped", False):
        return spark
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="rulegrid-code-"), "rulegrid.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._rulegrid_shipped = True
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = ship(df.sparkSession)
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []  # tables that this driver wrote, oldest first


def tables_written() -> int:
    return len(_WRITTEN)


def delete_tables(spark: SparkSession, since: int, until: int) -> None:
    """Delete tables ``since`` to ``until`` (numbers by ``tables_written``), which nothing reads any more, and let
    Spark clean up after the plans that read them (it drops their shuffle files once they are collected)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for i in range(since, until):
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN[i])
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Whatever runs inside drops its shuffle files as soon as it ends, not when the driver next collects its garbage; what is
    read twice there is better ``stored`` first, as its shuffles would run twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "2m"


def small_batches(spark: SparkSession) -> None:
    """From now on this session's Python tasks get their rows in Arrow batches of about ``BATCH_BYTES``, unless it has a bound of its
    own.  The default is 10,000 rows: of texts some 35 MB, held several times by executor and Python worker, and a worker that waits for
    its next task gives little of that back.  It stays set, as results are read after the function that made them returned."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, after as many underscores as no column of ``df`` has it by then, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a clash-free ``name`` column that tells equal rows apart (fixed once the result is stored)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of an edge list ``(a, b)``: the smallest node that links reach.

    Alternating large-star and small-star steps: each is a minimum per node (partially aggregated
    before its shuffle) joined back to the edges, so a node with very many links is never gathered in
    one task; the number of rounds grows with the logarithm of the longest path.  Every round is
    written to the shared folder.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    last = None
    for _ in range(max_rounds):
        # Large star: of u and its neighbours, every larger one links to the smallest.
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")).toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: u and its smaller neighbours link to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = stored(small.where("u > v").distinct(), "edges")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    # Settled: every node links to the smallest of its component only.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
