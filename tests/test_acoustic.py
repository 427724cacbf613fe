import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import ref_acoustics
from transcript_quality.config import AcousticConfig
from transcript_quality.functions.acoustic import acoustic_struct, block_energies
from transcript_quality.operators.audio import array_acoustic_features

SR = 16000


def feats(spark, signals, cfg=AcousticConfig()):
    df = spark.createDataFrame([(i, [float(v) for v in s]) for i, s in enumerate(signals)],
                               "id int, x array<double>")
    out = array_acoustic_features(df, "x", SR, cfg, keep=("id",)).orderBy("id").collect()
    return [(r.rms_db, r.snr_db, r.duration) for r in out]


def test_silence_tone_noise_match_analytic_expectations(spark):
    rng = np.random.default_rng(42)
    t = np.arange(SR) / SR
    tone = 0.5 * np.sin(2 * np.pi * 440 * t)
    padded = np.concatenate([np.zeros(1600), 0.5 * np.sin(2 * np.pi * 440 * np.arange(12800) / SR), np.zeros(1600)])
    noise = rng.normal(0, 0.1, SR)
    silence, sine, pad, white, short, ones = feats(
        spark, [np.zeros(SR), tone, padded, noise, rng.normal(0, .1, 2000), np.ones(100)])
    assert silence[0] == pytest.approx(20 * np.log10(1e-9))   # digital silence: -180 dB
    assert silence[1] == pytest.approx(-90.0, abs=1e-6)       # and SNR -90 (not 0)
    assert -9.1 < sine[0] < -8.9
    assert pad[1] > 20
    assert -5 < white[1] < 5
    assert short[1] == 0.0                                    # shorter than one frame
    assert ones[0] == pytest.approx(0.0, abs=1e-6) and ones[2] == pytest.approx(100 / SR)


def test_empty_signal(spark):
    assert feats(spark, [[]]) == [(-100.0, 0.0, 0.0)]


@pytest.mark.parametrize("n", [2048, 2049, 2560, 5000, 16000, 32001])
def test_matches_direct_framing(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(0, 0.2, n) * np.linspace(0.1, 1, n)
    got = feats(spark, [x])[0]
    assert np.allclose(got, ref_acoustics(x), atol=1e-7)


def test_other_frame_sizes_and_rejects_unaligned(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 0.3, 64)
    cfg = AcousticConfig(frame_length=16, hop_length=4)
    got = feats(spark, [x], cfg)[0]
    assert np.allclose(got, ref_acoustics(x, sr=SR, frame=16, hop=4), atol=1e-9)
    cfg8 = AcousticConfig(frame_length=48, hop_length=8)
    assert np.allclose(feats(spark, [x], cfg8)[0], ref_acoustics(x, sr=SR, frame=48, hop=8), atol=1e-9)
    with pytest.raises(ValueError):
        AcousticConfig(frame_length=20, hop_length=8).half_frame_blocks()


def test_block_energies(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],)], "x array<double>")
    assert df.select(block_energies("x", 2).alias("b")).first().b == [5.0, 25.0, 25.0]


def test_plan_has_no_shuffle(spark):
    df = spark.createDataFrame([(1, [0.1] * 5000)], "id int, x array<double>")
    st = acoustic_struct(block_energies("x", 512), F.size("x"), F.lit(SR))
    plan = df.select(st.alias("a"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
