"""Session settings for running the library at scale.

Nothing here is required: every operator works on whatever session the caller
hands over.  ``build_session`` is what ``bench.py`` and the tests use, and
``checkpoint_dir`` is how operators find the shared folder for lineage cuts.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Settings a scale run wants.  AQE re-plans from measured shuffle sizes: it
# coalesces small partitions, splits skewed join partitions and turns a shuffle
# join into a broadcast only once the small side has been measured.
SCALE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # From static estimates only very small sides are broadcast, so that a tiny
    # dimension does not make a fact table shuffle; larger ones only once AQE has
    # measured their shuffle output below the second threshold.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    # Lineage cuts written by checkpoint() are removed when their RDD goes away.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Added when the session does not run in local mode.  Coalesce shuffle
# partitions to the advisory size rather than to the core count (many small
# tasks waste a busy cluster), aim for 256 MB per partition, and read 512 MB
# input splits: 100 TB in 128 MB splits is ~800k scan tasks for one driver to
# schedule; every operator here streams its split, so larger splits cost no memory.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "512MB",
}

# HotSpot does not JIT-compile methods over 8,000 bytes of bytecode.  The
# whole-stage-codegen method of a projection with many rules is such a method
# and would run interpreted: measured 2.2x slower for the 11 example rules.
JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"


def build_session(
    master: str | None = None,
    app_name: str = "rulegrid",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`SCALE_CONF` applied.

    JVM options (:data:`JIT_HUGE_METHODS`) take effect only when this call
    starts the JVM; on a cluster they reach the executors at launch.

    ``shuffle_partitions`` is the *initial* partition count of a shuffle; AQE
    coalesces it down at run time, so on a cluster set it high (about input
    bytes / 128 MB) and let AQE shrink it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SCALE_CONF)
    if not (master or "").startswith("local"):
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    defaults = _default_conf()
    for key in ("spark.driver.extraJavaOptions", "spark.executor.extraJavaOptions"):
        given = settings.get(key, defaults.get(key, ""))
        if JIT_HUGE_METHODS not in given.split():
            given = f"{given} {JIT_HUGE_METHODS}".strip()
        settings[key] = given
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _default_conf() -> dict[str, str]:
    """Options given from outside: of the running JVM (spark-submit), else of ``spark-defaults.conf``."""
    from pyspark import SparkConf, SparkContext

    if SparkContext._jvm is not None:
        return dict(SparkConf(loadDefaults=True).getAll())
    folder = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    try:
        with open(os.path.join(folder, "spark-defaults.conf")) as f:
            lines = [line.split("#")[0].strip() for line in f]
    except OSError:
        return {}
    pairs = [re.split(r"[\s=:]+", line, maxsplit=1) for line in lines if line]
    return {pair[0]: pair[1] for pair in pairs if len(pair) == 2}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder ``DataFrame.checkpoint()`` writes to.

    It is the shared folder named by ``spark.checkpoint.dir``, read from the
    session and never overridden; where that is unset, a folder in the
    warehouse, which executors share as well.  Called only where a checkpoint
    is taken.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(configured_checkpoint_dir(spark) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` itself: the same in every application, unlike the folder that Spark makes in it."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
