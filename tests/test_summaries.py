"""Run summaries: what writers and streams report equals a count of what they wrote."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import write_wav
from transcript_quality.schemas import MANIFEST
from transcript_quality.sinks import writers as W
from transcript_quality.sources import tables as SRC
from transcript_quality.streaming.ingest import ingest_stream
from transcript_quality.streaming.summaries import run_summaries


def landing(folder, names):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        if n.startswith("bad"):
            open(f"{folder}/{n}", "wb").write(b"no audio at all" * 100)
        else:
            write_wav(f"{folder}/{n}", [0.1, -0.1] * 4000)


def test_stream_reports_each_run(spark, tmp):
    with run_summaries(spark) as seen:
        landing(f"{tmp}/in", ["a.wav", "b.wav", "bad1.wav"])
        first = ingest_stream(spark, f"{tmp}/in", f"{tmp}/h", f"{tmp}/ck")
        assert seen.of(first) == {"rows": 3, "failed": 1, "unlabelled": 2}  # a failed file has no wer at all
        landing(f"{tmp}/in", ["c.wav"])
        second = ingest_stream(spark, f"{tmp}/in", f"{tmp}/h", f"{tmp}/ck")  # only the new file
        assert seen.of(second) == {"rows": 1, "failed": 0, "unlabelled": 1}
        assert seen.of(first)["rows"] == 3
        third = ingest_stream(spark, f"{tmp}/in", f"{tmp}/h", f"{tmp}/ck")
        assert seen.of(third) == {}
    back = SRC.read_features(spark, f"{tmp}/h")
    assert back.count() == 4 and back.where("rms_db is null").count() == 1 and back.where("wer = -1").count() == 3


def test_batch_writers_report(spark, tmp):
    truth = spark.createDataFrame([("a", "ref", "hyp", 0.5), ("b", "ref", "", 1.0), ("c", "ref", None, 1.0)], "audio_id string, reference_text string, hypothesis_text string, wer double")
    truth = truth.select("audio_id", F.col("audio_id").alias("audio_path"), "reference_text", "hypothesis_text", "wer", F.lit(0.5).alias("asr_confidence"), F.lit(1.0).alias("duration"),
                         F.when(F.col("audio_id") != "c", 0.0).alias("rms_db"), F.lit(1.0).alias("snr_db"))
    assert W.write_ground_truth(truth, f"{tmp}/t") == {"rows": 3, "failed": 1, "skipped": 2}
    m = spark.createDataFrame([("a", "/a", "x", None, None), ("b", "/b", None, None, None), ("b", "/b", "", None, None)], MANIFEST)
    assert W.write_manifest(m, f"{tmp}/m") == {"rows": 3, "unlabelled": 2}
    assert W.write_manifest(m.limit(0), f"{tmp}/m") == {"rows": 0, "unlabelled": 0}
    assert SRC.read_manifest(spark, f"{tmp}/m").count() == 0
    scored = spark.createDataFrame([("a", 0.5, True, 200), ("b", None, False, 500)], "path string, predicted_wer double, review_recommended boolean, status int")
    scored = scored.select("path", F.current_timestamp().alias("ts"), F.lit(1.0).alias("snr_db"), "predicted_wer", "review_recommended", F.lit("").alias("transcript"), "status")
    for n in (1, 2):
        assert W.append_scores(scored, f"{tmp}/s") == {"rows": 2, "failed": 1, "flagged": 1}
        assert spark.read.parquet(f"{tmp}/s").count() == 2 * n


def test_failed_write_reports_nothing(spark, tmp):
    m = spark.range(3).select(*[F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise("x").alias(f.name) for f in MANIFEST.fields])
    with pytest.raises(Exception, match="lost"):
        W.write_manifest(m, f"{tmp}/m")
    assert not os.path.exists(f"{tmp}/m/pointers")
