import os

import numpy as np
import pytest

from tests.conftest import quantize16, ref_acoustics, write_wav
from transcript_quality.config import AcousticConfig, ValidityConfig
from transcript_quality.functions.wav import WavError, decode
from transcript_quality.operators.audio import acoustic_features, decode_audio, validate_audio
from transcript_quality.sources.audio import enough_files, read_audio


def test_decode_pcm16_and_8bit(tmp):
    x = np.linspace(-0.5, 0.5, 1000)
    p = write_wav(os.path.join(tmp, "a.wav"), x)
    y, sr = decode(open(p, "rb").read())
    assert sr == 16000 and y.shape == (1000, 1)
    assert np.allclose(y[:, 0], quantize16(x))
    p8 = write_wav(os.path.join(tmp, "b.wav"), x, width=1)
    y8, _ = decode(open(p8, "rb").read())
    assert np.allclose(y8[:, 0], x, atol=1 / 128)


def test_decode_rejects_non_wav():
    with pytest.raises(WavError):
        decode(b"hello world" * 100)


def test_features_from_wav_files(spark, tmp):
    rng = np.random.default_rng(42)
    sigs = {"noise.wav": rng.normal(0, 0.1, 16000), "tone.wav": 0.5 * np.sin(np.arange(16000) * 2 * np.pi * 440 / 16000),
            "silence.wav": np.zeros(16000), "short.wav": rng.normal(0, .1, 1000)}
    for name, s in sigs.items():
        write_wav(os.path.join(tmp, name), s)
    os.makedirs(os.path.join(tmp, "nested"))
    write_wav(os.path.join(tmp, "nested", "deep.wav"), sigs["noise.wav"][:8000])
    open(os.path.join(tmp, "notes.txt"), "w").write("x" * 3000)
    files = read_audio(spark, tmp)
    rows = {os.path.basename(r.path): r for r in acoustic_features(decode_audio(files)).collect()}
    assert set(rows) == set(sigs) | {"deep.wav"}
    for name, s in sigs.items():
        exp = ref_acoustics(quantize16(s))
        r = rows[name]
        assert np.allclose([r.rms_db, r.snr_db, r.duration], exp, atol=1e-6), name
        assert r.error is None


def test_stereo_rms_over_channels_and_truncated_file(spark, tmp):
    rng = np.random.default_rng(3)
    st = rng.normal(0, 0.1, (16000, 2))
    write_wav(os.path.join(tmp, "stereo.wav"), st, channels=2)
    good = write_wav(os.path.join(tmp, "good.wav"), rng.normal(0, .1, 16000))
    data = open(good, "rb").read()
    open(os.path.join(tmp, "broken.wav"), "wb").write(data[:30])
    rows = {os.path.basename(r.path): r for r in acoustic_features(decode_audio(read_audio(spark, tmp))).collect()}
    q = quantize16(st)
    assert rows["stereo.wav"].rms_db == pytest.approx(20 * np.log10(np.sqrt(np.mean(q ** 2)) + 1e-9), abs=1e-6)
    assert rows["stereo.wav"].snr_db == pytest.approx(ref_acoustics(q.mean(axis=1))[1], abs=1e-6)
    assert rows["broken.wav"].error is not None and rows["broken.wav"].rms_db is None


def test_validate_audio_reasons(spark, tmp):
    rng = np.random.default_rng(0)
    write_wav(os.path.join(tmp, "valid.wav"), rng.uniform(-1, 1, 16000))
    write_wav(os.path.join(tmp, "short.wav"), rng.uniform(-1, 1, 1600))
    open(os.path.join(tmp, "text.wav"), "w").write("not audio " * 240)
    write_wav(os.path.join(tmp, "tiny.wav"), rng.uniform(-1, 1, 100))
    out = {os.path.basename(r.path): (r.is_valid, r.reason)
           for r in validate_audio(read_audio(spark, tmp), ValidityConfig()).collect()}
    assert out == {"valid.wav": (True, None), "short.wav": (False, "too_short"),
                   "text.wav": (False, "invalid_header"), "tiny.wav": (False, "too_small")}


def test_size_filter_is_pushed_into_the_scan(spark, tmp):
    write_wav(os.path.join(tmp, "a.wav"), np.zeros(16000))
    df = read_audio(spark, tmp, min_size_kb=1).select("path")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "length" in plan and "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_enough_files(spark, tmp):
    assert not enough_files(spark, os.path.join(tmp, "missing"), 2)
    for i in range(3):
        write_wav(os.path.join(tmp, f"{i}.wav"), np.zeros(100))
    assert enough_files(spark, tmp, 3) and not enough_files(spark, tmp, 4)
