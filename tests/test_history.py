"""History, manifest and lookup: what one writer leaves, the next one and the reader see."""

import pytest
from pyspark.sql import functions as F

from transcript_quality.config import GBTConfig, TrainingConfig
from transcript_quality.operators import model as ML
from transcript_quality.operators import monitoring as MON
from transcript_quality.operators.audio import decode_audio, validate_audio
from transcript_quality.operators.transcripts import transcribe
from transcript_quality.plans import jobs as J
from transcript_quality.schemas import FEATURE_HISTORY, MANIFEST, SCORED
from transcript_quality.sinks import writers as W
from transcript_quality.sources import tables as SRC
from tests.conftest import write_wav


def feature_rows(names):
    return [(n, -20.0, 10.0, 2.0, 0.9, 0.1) for n in names]


def test_batch_stream_batch(spark, tmp):
    path, landing = f"{tmp}/history", f"{tmp}/landing"

    def batch(names):
        W.append_features(spark.createDataFrame(feature_rows(names), FEATURE_HISTORY), path)

    def stream(names, checkpoint="ckpt"):
        spark.createDataFrame(feature_rows(names), FEATURE_HISTORY).coalesce(1).write.mode("append").parquet(landing)
        W.write_stream(spark.readStream.schema(FEATURE_HISTORY).parquet(landing), path, f"{tmp}/{checkpoint}")

    def seen():
        return sorted(r.path for r in SRC.read_features(spark, path).collect())

    batch(["a", "b"])
    stream(["c"])
    assert seen() == ["a", "b", "c"]
    batch(["d"])
    stream(["e", "f"])
    assert seen() == ["a", "b", "c", "d", "e", "f"]
    stream([])  # nothing new: nothing repeated
    assert seen() == ["a", "b", "c", "d", "e", "f"]


def test_retried_batch_replaces_its_rows(spark, tmp, monkeypatch):
    path, landing = f"{tmp}/history", f"{tmp}/landing"
    spark.createDataFrame(feature_rows(["a", "b"]), FEATURE_HISTORY).coalesce(1).write.parquet(landing)
    source = spark.readStream.schema(FEATURE_HISTORY).parquet(landing)
    W.write_stream(source, path, f"{tmp}/ckpt")
    import glob
    import os
    for f in glob.glob(f"{tmp}/ckpt/commits/*") + glob.glob(f"{tmp}/ckpt/commits/.*crc"):
        os.remove(f)  # as if the driver had gone after the write and before the commit
    W.write_stream(source, path, f"{tmp}/ckpt")
    assert sorted(r.path for r in SRC.read_features(spark, path).collect()) == ["a", "b"]


def test_manifest_updated_in_place(spark, tmp):
    rows = [(f"a{i}", f"/x/{i}.wav", f' text "{i}"\nnext, line ', "s", "f") for i in range(20)]
    path = f"{tmp}/manifest"
    J.merge_manifest_job(spark, None, spark.createDataFrame(rows[:12], MANIFEST), path)
    out = J.merge_manifest_job(spark, path, spark.createDataFrame(rows[5:], MANIFEST), path)
    assert sorted(tuple(r) for r in out.collect()) == sorted(rows) == sorted(tuple(r) for r in SRC.read_manifest(spark, path).collect())


def test_json_lookup_of_many_entries(spark, tmp):
    df = spark.range(200_000).select(F.concat(F.lit("f"), "id", F.lit(".wav")).alias("filename"), F.concat(F.lit('t "'), "id").alias("reference_text"))
    W.write_reference_lookup(df, f"{tmp}/lookup", as_json=True)
    back = SRC.read_reference_lookup(spark, f"{tmp}/lookup")
    assert back.count() == 200_000 and back.exceptAll(df).count() == 0


def test_scoring_answers_for_failed_files(spark):
    cfg = TrainingConfig(gbt=GBTConfig(n_estimators=2, max_depth=2))
    train = spark.range(200).select(F.col("id").cast("string").alias("path"), *[(F.col("id") % k).cast("double").alias(c) for k, c in ((7, "rms_db"), (5, "snr_db"), (3, "duration"), (2, "asr_confidence"))], (F.col("id") % 7 / 7.0).alias("wer"))
    model = ML.fit(train, cfg)
    bad = spark.createDataFrame([("null", None, 1.0, 1.0, 1.0), ("nan", float("nan"), 1.0, 1.0, 1.0), ("good", 6.0, 1.0, 1.0, 1.0)], "path string, rms_db double, snr_db double, duration double, asr_confidence double")
    out = ML.scored_rows(ML.score(model, bad, cfg))
    assert [f.name for f in out.schema] == [f.name for f in SCORED]
    got = {r.path: r for r in out.collect()}
    assert got["null"].status == got["nan"].status == 500 and got["null"].predicted_wer is None and not got["nan"].review_recommended
    assert got["good"].status == 200 and got["good"].predicted_wer is not None
    assert J.monitor(out)["summary"].first()["n_observed"] == 1


def test_one_stray_timestamp_adds_few_steps(spark):
    ev = spark.createDataFrame([("1990-01-01 00:00:00",), ("2024-01-01 00:00:00",), ("2024-01-01 00:00:50",)], "ts string").select(F.col("ts").cast("timestamp").alias("ts"))
    rows = MON.rate_series(ev, "ts", ["1 minute", "5 minutes"], "15 seconds").collect()
    assert len(rows) < 50_000  # 71,527,685 steps lie between
    at = {(r.step_end, r.window_sec): r.n_in_window for r in rows}
    last = max(e for e, _ in at)
    assert at[last, 60] == 2 and at[last, 300] == 2 and 0 in at.values()


def test_validity_reads_headers_only(spark, tmp):
    import numpy as np
    write_wav(f"{tmp}/a.wav", np.zeros(16000))
    write_wav(f"{tmp}/b.wav", np.zeros(1600))
    open(f"{tmp}/c.wav", "wb").write(b"x" * 4000)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = spark.read.format("binaryFile").load(f"{tmp}/*.wav")
    got = {r.path[-5:]: (r.reason, r.duration) for r in validate_audio(files).collect()}
    assert got == {"a.wav": (None, 1.0), "b.wav": ("too_short", 0.1), "c.wav": ("invalid_header", None)}
    decode_audio(files).count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_model_is_loaded_once_in_a_worker(spark, tmp):
    log = f"{tmp}/loads"

    def make():
        import os
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda paths: {"transcript": list(paths), "word_confidence": [[0.5]] * len(paths), "score": [0.25] * len(paths)}

    df = spark.createDataFrame([(str(i),) for i in range(64)], "path string").repartition(16)
    out = transcribe(df, make, model_id="counted")
    for _ in range(2):
        assert {r.score for r in out.collect()} == {0.25}
    loads = open(log).read().split()
    assert len(loads) == len(set(loads))


def test_lookup_missing_reference_join_has_no_shuffle(spark):
    ac = spark.createDataFrame([("a", 1.0, 2.0, 3.0)], "path string, rms_db double, snr_db double, duration double")
    plan = J.label_acoustics(ac)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.fixture(autouse=True)
def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
