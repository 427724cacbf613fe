from pyspark.sql import functions as F

from transcript_quality.operators.joins import join_small, measured_bytes


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_measured_before_broadcast(spark, tmp):
    left = spark.range(100).withColumnRenamed("id", "k")
    spark.createDataFrame([(i, "x" * 1000) for i in range(10)], "k long, text string") \
        .write.parquet(f"{tmp}/right")
    right = spark.read.parquet(f"{tmp}/right")   # compressed file: estimate ~ 1 kB, payload 10 kB
    assert measured_bytes(right) == 10 * (8 + 1000)
    # the estimate from the file size is far below the payload; the measured size decides
    shuffled = join_small(left, right, "k", "left", max_bytes=5_000)
    assert "BroadcastHashJoin" not in _plan(shuffled) and "SortMergeJoin" in _plan(shuffled)
    small = join_small(left, right, "k", "left", max_bytes=1_000_000)
    assert "BroadcastHashJoin" in _plan(small)
    assert shuffled.where(F.col("text").isNotNull()).count() == small.where(F.col("text").isNotNull()).count() == 10
