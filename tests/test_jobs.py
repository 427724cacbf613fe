import json
import os

import numpy as np

from tests.conftest import write_wav
from transcript_quality.config import GBTConfig, IngestConfig, TrainingConfig
from transcript_quality.plans import jobs as J
from transcript_quality.schemas import REGISTRY, TRANSCRIPTS
from transcript_quality.sources.audio import read_audio

CFG = TrainingConfig(min_samples=50, gbt=GBTConfig(n_estimators=10, max_depth=3))


def landing_with_labels(spark, folder, n=60, seed=42):
    """Noisier files get worse hypotheses, so WER is learnable from SNR."""
    rng = np.random.default_rng(seed)
    os.makedirs(folder, exist_ok=True)
    words = [f"w{i}" for i in range(50)]
    lookup, hyps = {}, {}
    for i in range(n):
        noise = rng.uniform(0.001, 0.3)
        t = np.arange(16000) / 16000
        x = 0.3 * np.sin(2 * np.pi * 220 * t) * (t > 0.3) + rng.normal(0, noise, 16000)
        name = f"f{i:03d}.wav"
        write_wav(os.path.join(folder, name), np.clip(x, -1, 1))
        ref = [rng.choice(words) for _ in range(20)]
        hyp = [w if rng.random() > noise * 2.5 else "zz" for w in ref]
        lookup[name] = " ".join(ref)
        hyps[name] = " ".join(hyp)
    paths = [r.path for r in read_audio(spark, folder).select("path").collect()]
    tr = spark.createDataFrame([(p, hyps[os.path.basename(p)], [0.9], None, None) for p in paths], TRANSCRIPTS)
    return lookup, tr


def test_daily_cycle_end_to_end(spark, tmp):
    landing = os.path.join(tmp, "incoming")
    lookup, tr = landing_with_labels(spark, landing)
    lookup_path = os.path.join(tmp, "lookup.json")
    json.dump(lookup, open(lookup_path, "w"), indent=2)
    paths = dict(landing=landing, history_path=os.path.join(tmp, "history"), models_dir=os.path.join(tmp, "models"),
                 registry_path=os.path.join(tmp, "registry"), lookup_path=lookup_path, transcripts=tr)
    waiting = J.run_daily(spark, **{**paths, "landing": os.path.join(tmp, "empty")}, cfg=CFG)
    assert waiting == {"status": "waiting"}
    first = J.run_daily(spark, **paths, cfg=CFG, ingest=IngestConfig(min_files=50))
    assert first["status"] == "promoted" and first["gate"]["production"] == -1.0
    assert spark.read.parquet(paths["history_path"]).count() == 60
    hist = spark.read.parquet(paths["history_path"])
    assert hist.where("wer < 0").count() == 0 and hist.where("rms_db IS NULL").count() == 0
    second = J.run_daily(spark, **paths, cfg=CFG)
    assert second["status"] == "kept"          # same data, same seed: equal rho is not better
    reg = spark.read.schema(REGISTRY).parquet(paths["registry_path"])
    stages = sorted(r.stage for r in reg.collect())
    assert stages == ["candidate", "candidate", "production"]
    assert J.production_model_path(spark, paths["registry_path"]) == first["trained"]["model_path"]
    # scoring with the production model
    scored = J.score_batch(spark, hist, first["trained"]["model_path"], CFG)
    assert scored.where("review_recommended != (predicted_wer > 0.4)").count() == 0


def test_ground_truth_and_lookup_jobs(spark, tmp):
    landing = os.path.join(tmp, "audio")
    lookup, tr = landing_with_labels(spark, landing, n=8)
    files = read_audio(spark, landing)
    manifest = spark.createDataFrame(
        [(n[:-4], os.path.join(landing, n), t, "spk", "f") for n, t in lookup.items()] +
        [("ghost", os.path.join(landing, "ghost.wav"), "never there", "spk", "m")],
        "audio_id string, audio_path string, reference_text string, speaker_id string, gender string")
    hyps = tr.select(tr.path.alias("audio_path"), tr.transcript.alias("hypothesis_text"), "word_confidence",
                     "token_confidence", "score")
    rows, stats = J.generate_ground_truth(manifest, files, hyps, out_path=os.path.join(tmp, "gt"))
    assert rows.count() == 8 and stats["duration"].first().n_files == 8
    assert 0 <= stats["wer"].first().median_wer <= 1
    mpath = os.path.join(tmp, "manifest")
    from transcript_quality.sinks.writers import write_manifest
    write_manifest(manifest, mpath)
    counts = J.prepare_lookup(spark, mpath, files, os.path.join(tmp, "lk.json"), sample_size=51)
    assert counts == {"sampled": 9, "copied": 8, "skipped": 1, "entries": 8}
