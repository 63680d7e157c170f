"""What is in a storage location: objects, sizes and times, from a distributed listing."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_objects(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``(path, size_bytes, modified_at)`` per object with content. Contents are never read.

    Spark does not schedule empty files and hides names that start with ``_`` or ``.``.
    """
    return _objects(spark, path, pattern).select(
        "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")
    )


def _objects(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader if pattern is None else reader.option("pathGlobFilter", pattern)).load(path)


def require_objects(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The listing, after checking that something is there and nothing is empty."""
    try:
        # The index that any scan holds; only its length comes to Python.
        present = len(_objects(spark, path, pattern)._jdf.inputFiles())
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    if present == 0:
        raise FileNotFoundError(path)
    listing = list_objects(spark, path, pattern)
    empty = present - listing.count()
    if empty:
        raise ValueError(f"{empty} empty object(s) under {path}")
    return listing


def layer_metrics(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Objects and bytes per named layer."""
    tagged = [list_objects(spark, path).select(F.lit(name).alias("layer"), "size_bytes") for name, path in layers.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("layer")
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("size_bytes").alias("bytes"))
    )
