import os
import sys
import tempfile
import wave

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from transcript_quality.session import local_session
    s = local_session("*", shuffle_partitions=8, checkpoint_dir=tempfile.mkdtemp(prefix="tq-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def write_wav(path, samples, sr=16000, channels=1, width=2):
    """PCM WAV with the standard-library writer (samples in [-1, 1], frames x channels)."""
    x = np.asarray(samples, dtype=np.float64)
    if x.ndim == 1:
        x = x[:, None]
    if width == 2:
        data = np.clip(np.round(x * 32768.0), -32768, 32767).astype("<i2").tobytes()
    elif width == 1:
        data = np.clip(np.round(x * 128.0 + 128.0), 0, 255).astype(np.uint8).tobytes()
    else:
        raise ValueError(width)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(sr)
        w.writeframes(data)
    return str(path)


def quantize16(x):
    return np.clip(np.round(np.asarray(x) * 32768.0), -32768, 32767) / 32768.0


def ref_acoustics(x, sr=16000, frame=2048, hop=512, ratio=0.1, eps=1e-9, silence=-100.0):
    """Direct numpy framing (centred, zero padded), the brute-force twin of the Spark form."""
    x = np.asarray(x, dtype=np.float64)
    if x.size == 0:
        return silence, 0.0, 0.0
    rms = 20 * np.log10(np.sqrt(np.mean(x ** 2)) + eps)
    if len(x) < frame:
        return rms, 0.0, len(x) / sr
    y = np.pad(x, (frame // 2, frame // 2))
    nfr = 1 + (len(y) - frame) // hop
    fr = np.array([np.sqrt(np.mean(y[i * hop:i * hop + frame] ** 2)) for i in range(nfr)])
    fr = np.sort(np.maximum(fr, eps))
    k = max(1, int(len(fr) * ratio))
    noise = np.mean(fr[:k] ** 2)
    sig = np.mean(fr[k:] ** 2) if len(fr) > k else noise
    return rms, 10 * np.log10(sig / (noise + eps)), len(x) / sr


def edit_distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y))
        prev = cur
    return prev[-1]


def tokens(s):
    import re
    s = re.sub(r"\s\s+", " ", s or "").strip()
    return [w for w in s.split(" ") if w]
