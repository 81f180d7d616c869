"""Session construction and shared-storage helpers.

Library functions never create sessions themselves; this module is for
entry points (bench, tests, plans) that need one.  On a cluster the
session comes from the launcher and only :func:`checkpoint_root` is used.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that matter for correctness (UTC) and for scale (AQE, skew
# splitting, partition coalescing).  Shuffle partitions are sized by the
# caller: ~cores locally, ~2-3x total executor cores on a cluster.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Broadcast only on a measured size: no plan-time broadcast from estimates;
    # AQE turns a join into a broadcast when the materialised side is small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf and master.startswith("local"):
        # Local runs only: a scratch root.  Cluster launchers pass a shared one
        # (checkpoint_root refuses to run on a cluster without it).
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="riskweave-ckpt-")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def launched_session(app_name: str = "riskweave") -> SparkSession:
    """The session that ``spark-submit`` describes: master, sizing and paths are
    the launcher's; only recommended settings that it left unset are added."""
    SparkContext._ensure_initialized()
    given = SparkConf()
    builder = SparkSession.builder
    if not given.contains("spark.app.name"):
        builder = builder.appName(app_name)
    for k, v in RECOMMENDED_CONF.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint root named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.
    Where it is unset (an ad-hoc local session) a scratch directory is used.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name shared storage when running on a cluster")
    key = id(spark.sparkContext)
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="riskweave-ckpt-")
    return _LOCAL_FALLBACK[key]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write under the shared root."""
    root = checkpoint_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint root (streaming checkpoints, snapshots)."""
    return os.path.join(checkpoint_root(spark), *parts)
