"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "claimsight") -> SparkSession:
    """Build (or reuse) a session with the settings every job here assumes.

    Each setting below is a default: it is applied only when neither
    spark-submit, spark-defaults nor an explicit argument already set it, so
    a cluster's own sizing (shuffle partitions, broadcast threshold, memory)
    always wins.  ``master`` is only used when none is configured.
    """
    from pyspark import SparkConf
    given = SparkConf()          # spark-submit / spark-defaults values
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # no broadcast from plan-time size *estimates*; AQE may still turn a
        # join into a broadcast from the *measured* size of a finished shuffle
        # stage, and code broadcasts explicitly only tables with a proven bound
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("CLAIMSIGHT_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:          # only on request: a cluster's own number, or Spark's, stays
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master and not given.contains("spark.master"):
        builder = builder.master(master)
    for k, v in defaults.items():
        if not given.contains(k) or (k == "spark.sql.shuffle.partitions" and shuffle_partitions):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` when the cluster names one; only when it is
    unset (local tests) a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = tempfile.mkdtemp(prefix="claimsight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d
