"""Session settings the jobs rely on. A cluster sets them in its own configuration."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


#: Environment variable for the number of partitions that a shuffle starts with. Adaptive execution merges small
#: partitions but doesn't split even ones, so set it to the largest shuffle's size over about 200 MB.
INITIAL_PARTITIONS = "TILLSTAR_INITIAL_PARTITIONS"


def builder(app_name: str = "tillstar") -> SparkSession.Builder:
    """Adaptive execution sizes shuffles, splits hot join keys and merges small partitions."""
    wide = os.environ.get(INITIAL_PARTITIONS)
    made = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    return made.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wide) if wide else made


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    return (
        builder()
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
