import os

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import write_wav
from transcript_quality.operators.transcripts import pad_confidences, transcribe
from transcript_quality.plans.jobs import extract_features
from transcript_quality.sinks.writers import append_features
from transcript_quality.sources.audio import read_audio


def make_fake_model():
    """Stands in for a speech-to-text model: 'transcribes' the file name."""
    def predict(paths):
        names = [os.path.basename(p)[:-4] for p in paths]
        return {"transcript": [f"said {n}" for n in names],
                "word_confidence": pad_confidences([[0.5, 1.0] if i % 2 else [0.9] for i in range(len(names))])}
    return predict


def peak_extractor(dec):
    return dec.withColumn("n_blocks", F.size("block_sq"))


def test_transcribe_hook_and_extractors(spark, tmp):
    rng = np.random.default_rng(0)
    for i in range(5):
        write_wav(os.path.join(tmp, f"clip{i}.wav"), rng.normal(0, .1, 4000))
    files = read_audio(spark, tmp)
    tr = transcribe(files.select("path"), make_fake_model, batch_size=2)
    got = {os.path.basename(r.path): (r.transcript, r.word_confidence) for r in tr.collect()}
    assert got["clip3.wav"][0] == "said clip3" and len(got) == 5
    assert all(1 <= len(c) <= 2 for _, c in got.values())     # NaN padding to the batch width
    import json
    lk = os.path.join(tmp, "lk.json")
    json.dump({"clip0.wav": "said clip0", "clip1.wav": "said something"}, open(lk, "w"))
    rows = extract_features(spark, tmp, lk, tr, extractors=[peak_extractor])
    out = {os.path.basename(r.path): r for r in rows.collect()}
    assert out["clip0.wav"].wer == 0.0 and out["clip1.wav"].wer == 0.5 and out["clip2.wav"].wer == -1.0
    assert out["clip0.wav"].n_blocks == 8                       # 4000 samples / 512
    assert {round(r.asr_confidence, 4) for r in out.values()} <= {0.9, 0.75}
    summary = append_features(rows.drop("n_blocks"), os.path.join(tmp, "hist"))
    assert summary == {"rows": 5, "failed": 0, "unlabelled": 3}
