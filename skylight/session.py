"""Spark session defaults and the shared checkpoint folder.

Every job in this package is a lazy DataFrame plan; the session only fixes
what must hold everywhere: UTC time, ANSI semantics, AQE (coalescing and
skew-join splitting), LAST_WIN map-key dedup for label upserts, no UI.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A broadcast is only planned for sides whose size Spark can prove
    # below this; our explicit hints are limited to fixed-size dimensions.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # many small log folders: list them in a bounded number of parallel tasks
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "skylight") -> SparkSession:
    """Return the active session or build a local one with our defaults.

    On a cluster the session already exists (spark-submit); the defaults
    are then applied only where the operator has not set them.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        apply_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("SKYLIGHT_MASTER", "local[8]"))
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("SKYLIGHT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the SQL defaults that are runtime-settable and not yet set."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.ui") or key.startswith("spark.driver"):
            continue
        try:
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        except Exception:  # static conf on a running cluster session
            pass
    # Correctness-relevant settings are always enforced.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Unset, a local session gets a scratch folder; on a cluster that would be
    a folder of one machine, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and sc is not None and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="skylight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured
