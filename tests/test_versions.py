"""Whole-table replacement: readers see one whole version, whatever happens to a writer."""

import os
import time

import pytest
from pyspark.sql import functions as F

from transcript_quality import versions as V
from transcript_quality.plans import jobs
from transcript_quality.sinks import writers as W
from transcript_quality.sources import tables as SRC


def manifest(spark, n, text="t"):
    return spark.range(n).select(F.concat(F.lit("a"), "id").alias("audio_id"), F.concat(F.lit("/x/"), "id").alias("audio_path"),
                                 F.lit(text).alias("reference_text"), F.lit(None).cast("string").alias("speaker_id"), F.lit("f").alias("gender"))


def test_reader_keeps_its_version(spark, tmp):
    root = f"{tmp}/manifest"
    W.write_manifest(manifest(spark, 5, 'one, "two"\n three '), root)
    before = SRC.read_manifest(spark, root)
    W.write_manifest(manifest(spark, 9), root)
    assert before.count() == 5 and SRC.read_manifest(spark, root).count() == 9
    assert before.first().reference_text == 'one, "two"\n three '
    assert V.current_number(spark, root) == 2


def test_stopped_write_leaves_the_old_version(spark, tmp):
    root = f"{tmp}/truth"
    rows = manifest(spark, 40).select("audio_id", "audio_path", "reference_text", F.lit("h").alias("hypothesis_text"),
                                      *[F.lit(0.5).alias(c) for c in ("wer", "asr_confidence", "duration", "rms_db", "snr_db")])
    W.write_ground_truth(rows, root)
    broken = rows.withColumn("wer", F.when(F.col("audio_id") == "a39", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("wer")))
    with pytest.raises(Exception, match="lost"):
        W.write_ground_truth(broken, root)
    assert SRC.read_ground_truth(spark, root).count() == 40 and V.current_number(spark, root) == 1
    # stopped between the folder and the pointer
    rows.limit(1).write.parquet(f"{root}/versions/vdeadbeef")
    assert SRC.read_ground_truth(spark, root).count() == 40
    assert V.drop_old(spark, root) == 0  # too young
    assert V.drop_old(spark, root, older_than=0) >= 1
    assert SRC.read_ground_truth(spark, root).count() == 40


def test_two_writers(spark, tmp):
    root = f"{tmp}/m"
    seen = V.current_number(spark, root)
    W.write_manifest(manifest(spark, 3), root, based_on=seen)
    with pytest.raises(V.Conflict):
        W.write_manifest(manifest(spark, 4), root, based_on=seen)
    assert SRC.read_manifest(spark, root).count() == 3
    assert [f for f in os.listdir(f"{root}/pointers") if not f.startswith(".")] == [f"{1:012d}"]
    W.write_manifest(manifest(spark, 6), root)  # the last writer wins
    assert SRC.read_manifest(spark, root).count() == 6


def test_update_in_place_from_itself(spark, tmp):
    root = f"{tmp}/m"
    for n in (4, 7, 7):
        out = jobs.merge_manifest_job(spark, root, manifest(spark, n), root)
    assert out.count() == 7 and V.current_number(spark, root) == 3
    assert V.drop_old(spark, root, keep=1, older_than=0) == 2
    assert SRC.read_manifest(spark, root).count() == 7


def test_plain_folder_is_read_as_it_is(spark, tmp):
    manifest(spark, 2).write.option("header", True).csv(f"{tmp}/plain")
    assert V.resolve(spark, f"{tmp}/plain") is None
    assert SRC.read_manifest(spark, f"{tmp}/plain").count() == 2


def test_deploy_and_roll_back(spark, tmp):
    path = f"{tmp}/registry"
    now = F.timestamp_seconds(F.lit(int(time.time())))
    rows = spark.createDataFrame([("v1", f"{tmp}/v1", 0.5), ("v2", f"{tmp}/v2", 0.6)], "version string, path string, spearman_rho double")
    W.append_registry(rows.select("version", "path", now.alias("created_at"), "spearman_rho", F.lit(None).cast("double").alias("spearman_p_value"),
                                  F.lit(0.1).alias("rmse"), F.lit(9).cast("long").alias("num_samples"), F.lit("candidate").alias("stage")), path)
    assert jobs.production_model_path(spark, path) is None
    jobs.deploy(spark, path, "v1")
    jobs.deploy(spark, path, "v2")
    assert jobs.production_model_path(spark, path) == f"{tmp}/v2"
    with pytest.raises(FileNotFoundError):
        jobs.deploy(spark, path, "v9")
    assert jobs.roll_back(spark, path) == jobs.production_model_path(spark, path) == f"{tmp}/v1"
    with pytest.raises(FileNotFoundError):
        jobs.roll_back(spark, f"{tmp}/none")
