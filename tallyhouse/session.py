"""Session construction and cluster-safe settings.

Only settings a Spark user sets: AQE (runtime re-planning, partition
coalescing, skew-join splitting), a size-checked broadcast threshold,
dynamic partition overwrite, UTC session time zone.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Broadcast only below this estimated/observed size.  Catalyst checks the
# static estimate, AQE re-checks the real shuffle size at runtime, so no
# explicit broadcast() hint is needed for tables that grow with the data.
BROADCAST_LIMIT = str(64 * 1024 * 1024)

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": BROADCAST_LIMIT,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_LIMIT,
    # sort-merge -> shuffled hash join only when every build partition is
    # measured under this size (hash maps do not spill)
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": BROADCAST_LIMIT,
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # generated classes of many different plans stay compiled
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(master: str | None = None, app: str = "tallyhouse",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster call without ``master``; the cluster manager decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared, durable folder.  Only a local
    session (tests) gets a fresh scratch folder where it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or current
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="tallyhouse-ckpt-")
    if not current:
        sc.setCheckpointDir(d)
    return d
