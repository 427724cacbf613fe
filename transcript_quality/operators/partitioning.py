"""Parallelism helpers for heavy per-row work on small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when ``df`` has fewer partitions than the cluster has cores.

    Used before CPU-heavy per-row work (word edit distances, tokenising long texts, tree
    fitting): a small input read from a few row groups would otherwise run on a few cores.  An
    input that already has enough partitions passes unchanged, so large inputs pay no shuffle."""
    target = partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def copartition(df: DataFrame, keys, partitions: int | None = None) -> DataFrame:
    """Hash-partition on the join keys with an explicit count: the join reuses this
    partitioning (no further exchange) and adaptive execution keeps the count, so the heavy
    per-pair work after the join stays spread over the cluster."""
    return df.repartition(partitions or target_partitions(df), *keys)
