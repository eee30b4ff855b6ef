"""Session settings the plans are written for. Pass them to ``SparkSession.builder.config``."""

from __future__ import annotations

import math


PARTITION_BYTES = 128 << 20


def cluster_conf(cores: int, input_bytes: int = 0) -> dict[str, str]:
    """Settings for ``cores`` executor cores in all and tables of ``input_bytes``.

    Shuffles start fine (several partitions per core, and one for each 128 MB of input, so that
    each fits a task's memory at any table size) and are merged at run time to about 128 MB; partitions that stay too large
    because of one key are split at run time."""
    partitions = max(200, cores * 8, math.ceil(input_bytes / PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
    }
