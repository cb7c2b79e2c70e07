"""Session construction and the shared working folder.

Every clock and every location is a parameter; the only thing read from the
environment is what the cluster already configured on the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle width is a parameter: AQE coalesces
# small partitions at run time and splits skewed ones in sort-merge joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def cluster_conf(executors: int, cores_per_executor: int,
                 advisory_partition_mb: int = 256, broadcast_mb: int = 64) -> dict:
    """Settings for a large cluster (e.g. 1000 executors reading ~100 TB).

    The initial shuffle width is a few waves of the total cores; AQE then
    coalesces partitions to ``advisory_partition_mb`` and splits skewed ones
    (joins and rebalanced writes).  Scans split files at the same size.  The
    broadcast threshold is applied by Spark to measured sizes only.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(3 * cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * advisory_partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{advisory_partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": f"{broadcast_mb}m",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(min(cores, 10000)),
    }


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "freightlake", extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the base settings applied.

    ``master=None`` leaves the master to spark-submit (cluster use).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


#: What results depend on; everything else stays as the cluster has it.
RESULT_CONF = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def apply_conf(spark: SparkSession) -> None:
    """Apply the settings that results depend on to an existing session."""
    for k in RESULT_CONF:
        if spark.conf.get(k, None) != BASE_CONF[k]:
            spark.conf.set(k, BASE_CONF[k])


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, read from the
    session.  Where none is named, only a local session (tests, one machine)
    sets one of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster session")
        current = tempfile.mkdtemp(prefix="freightlake-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


#: Of files that only merges read (snapshots, stages, key indexes): digests as keys stay
#: whole under snappy, zstd halves them.
MERGE_CODEC = "zstd"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder for one run's tables."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
