"""Session helpers: shared scratch folder and the settings the jobs expect."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would be
    lost with its executor).  Only a local-mode session without the setting,
    as in tests, gets a fresh temporary folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context here; the setting is all there is
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is unset; name a shared folder for this cluster")
        return conf_dir.rstrip("/")
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not conf_dir and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is unset; name a shared folder for this cluster")
    sc.setCheckpointDir(conf_dir or tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


# Settings the jobs are designed for.  AQE coalesces the (deliberately high)
# initial shuffle partition count, splits skewed join and rebalance partitions,
# and turns joins whose measured side is small into broadcasts.  The advisory
# size is the target of that coalescing and splitting; REBALANCE before a
# partitioned write cuts files at about this much shuffle data, so 256 MB
# (Spark's default is 64 MB) keeps a 100 TB archive at a few hundred thousand
# files instead of well over a million.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Let AQE split and coalesce inside cached plans too, so merged rows can be
    # laid out (hot partition values split) once, inside their cache, for both
    # of their writes.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Local session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
