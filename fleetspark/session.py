"""SparkSession helpers.

Every time-relative operator takes an explicit ``as_of``; timestamps stay
``timestamp_ntz`` as the driver's Parquet files store them (X-15), and the
session zone is pinned to UTC so that any conversion to epoch seconds (and the
instant a watermark needs) is zone-free.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "fleetspark",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster pass master=None."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    # Local runs size shuffles to the local cores; on a cluster the configured
    # value stays and AQE coalesces small partitions to the advisory size.
    if shuffle_partitions or (master or "").startswith("local"):
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings every operator relies on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    The session's setting is used when present; a fallback is only applied when
    the session has none, as in local tests. The SparkContext checkpoint folder
    is aligned with it so that ``DataFrame.checkpoint()`` writes there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set")
        d = fallback
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
