"""Session helpers: a tuned local session for tests/bench, and the
checkpoint directory used to cut lineage.

The checkpoint directory is whatever the cluster names in
``spark.checkpoint.dir`` (a shared, fault-tolerant file system); a session
without that setting gets a folder in its SQL warehouse.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "salescope",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with AQE on, UI off, UTC time zone.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces
    small shuffle partitions and splits skewed join partitions at run time.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(largest_shuffle_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the largest shuffle of a run.

    AQE can merge small shuffle partitions but cannot split them (skewed join
    partitions aside), so the initial partition count must come from the
    largest shuffle: ``largest_shuffle_bytes / partition_bytes``, at least
    2,000.  At about 100 TB of deals the fact join shuffles
    some 25 TB (line items and orders, pruned to the used columns): about
    100,000 partitions of 256 MB.  Skewed join partitions are split; broadcast
    stays behind the planner's size check.
    """
    partitions = max(2000, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


# Settings for about 100 TB of deals (see cluster_conf).
CLUSTER_CONF = cluster_conf(25 << 40)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for data that outlives a job: ``spark.checkpoint.dir``
    as the cluster names it, else a folder in the SQL warehouse (which driver
    and executors share by definition)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return configured.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only if unset.

    Order: the directory already set on the context, then
    :func:`checkpoint_root`.  Under Spark Connect there is no context on the
    client: the server's ``spark.checkpoint.dir`` applies.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpointing is configured on the server
        return checkpoint_root(spark)
    current = sc.getCheckpointDir()
    if current:
        return current
    root = checkpoint_root(spark)
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def session_key(spark: SparkSession) -> str:
    """An identifier of the session's application (a client-side id under
    Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return f"connect-{id(spark)}"
