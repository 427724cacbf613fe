"""A stream of many small files has tasks by their bytes, not one for every few files."""

import glob

from pyspark.sql import functions as F

from transcript_quality import queries as Q
from transcript_quality.sources.audio import small_file_settings


def test_many_small_files(spark, monkeypatch, tmp):
    n, cores = 1200 * max(1, spark.sparkContext.defaultParallelism // 8), spark.sparkContext.defaultParallelism
    wave = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.sin(i * (F.col("id") + 1)).cast("float"))
    spark.range(n).select(F.col("id").alias("vec_id"), wave.alias("embedding"), F.lit(0).alias("label")).coalesce(1).write.parquet(f"{tmp}/embeddings.parquet")
    monkeypatch.setattr(Q, "_run_dir", lambda *a: f"{tmp}/run")
    before = {k: spark.conf.get(k) for k in small_file_settings(spark)}
    got = Q.stream_file_features(spark, tmp)
    want = Q.decoded_features(spark, tmp)
    assert got.count() == n and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    for k in range(2):
        assert len(glob.glob(f"{tmp}/run/out/stream=*/batch={k}/part-*.parquet")) <= cores + 1
    assert {k: spark.conf.get(k) for k in before} == before
