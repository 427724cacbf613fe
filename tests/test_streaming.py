import json
import os
import time

import numpy as np
import pytest

from tests.conftest import write_wav
from transcript_quality.plans.jobs import extract_features
from transcript_quality.schemas import TRANSCRIPTS
from transcript_quality.sources.audio import read_audio
from transcript_quality.sources.tables import read_features, read_reference_lookup
from transcript_quality.streaming.ingest import ingest_stream


def make_landing(folder, names, seed=0):
    rng = np.random.default_rng(seed)
    os.makedirs(folder, exist_ok=True)
    for i, n in enumerate(names):
        write_wav(os.path.join(folder, n), rng.normal(0, 0.05 * (i + 1), 8000))
    open(os.path.join(folder, "metadata.json"), "w").write("{}")


def transcripts_for(spark, folder):
    paths = [r.path for r in read_audio(spark, folder).select("path").collect()]
    rows = [(p, "hello world again" if i % 2 else "hello word", [0.9, 0.8, float("nan")], None, None)
            for i, p in enumerate(sorted(paths))]
    return spark.createDataFrame(rows, TRANSCRIPTS)


def test_stream_equals_batch_and_counts_once(spark, tmp):
    landing, hist = os.path.join(tmp, "in"), os.path.join(tmp, "history")
    make_landing(landing, ["a.wav", "b.wav", "c.wav"])
    lookup_path = os.path.join(tmp, "lookup.json")
    json.dump({"a.wav": "hello world again", "b.wav": "hello world"}, open(lookup_path, "w"))
    lookup = read_reference_lookup(spark, lookup_path)
    tr = transcripts_for(spark, landing)
    ck = os.path.join(tmp, "ck")
    ingest_stream(spark, landing, hist, ck, lookup, tr)
    streamed = sorted(map(tuple, read_features(spark, hist).collect()))
    batch = sorted(map(tuple, extract_features(spark, landing, lookup_path, tr).collect()))
    assert streamed == batch and len(streamed) == 3
    wers = {os.path.basename(r[0]): r[5] for r in streamed}
    assert wers["c.wav"] == -1.0 and wers["a.wav"] == pytest.approx(2 / 3) and wers["b.wav"] == pytest.approx(1 / 2)
    # a second run only sees new files
    make_landing(landing, ["d.wav"], seed=1)
    ingest_stream(spark, landing, hist, ck, lookup, transcripts_for(spark, landing))
    assert read_features(spark, hist).count() == 4


def test_archive_moves_only_audio(spark, tmp):
    landing, archive = os.path.join(tmp, "in"), os.path.join(tmp, "archive")
    make_landing(landing, ["x.wav", "y.wav"])
    ck, hist = os.path.join(tmp, "ck"), os.path.join(tmp, "h")
    ingest_stream(spark, landing, hist, ck, archive_dir=archive)
    make_landing(landing, ["z.wav"], seed=3)
    ingest_stream(spark, landing, hist, ck, archive_dir=archive)
    moved = [f for _, _, fs in os.walk(archive) for f in fs]
    assert {"x.wav", "y.wav"} <= set(moved)
    assert "metadata.json" in os.listdir(landing)
    assert read_features(spark, hist).count() == 3
