"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Days, weeks and slots are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Shuffles are sized at run time: partitions are merged up to the advisory
    # size, overfull join partitions are split, and a join side is broadcast
    # only if what it turned out to hold is below the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.files.maxPartitionBytes": "128m",
}

# Added on a cluster, where shuffles of the full event history are far larger.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A lost executor costs a retry of its tasks, not of the job.
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(
    builder: SparkSession.Builder, cluster: bool = False, initial_partitions: int = 8192
) -> SparkSession.Builder:
    """`initial_partitions`: a cluster's shuffles before merging.

    Merging can only lower it, so choose it for the largest shuffle: its bytes
    by the advisory partition size.
    """
    settings = dict(SETTINGS)
    if cluster:
        settings |= {**CLUSTER_SETTINGS, INITIAL_PARTITIONS: str(initial_partitions)}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder
