"""PCM/float WAV parsing with numpy (the thin per-file helper behind the decode operator)."""

from __future__ import annotations

import struct

import numpy as np

_PCM, _FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE


class WavError(ValueError):
    pass


def parse_header(data: bytes, size: int | None = None) -> dict:
    """Walk RIFF chunks; returns format fields and the data chunk's offset and length.  ``data`` may be the
    front of a file of ``size`` bytes."""
    total = len(data) if size is None else size
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise WavError("not a RIFF/WAVE file")
    pos, fmt = 12, None
    while pos + 8 <= len(data):
        cid = data[pos:pos + 4]
        size = struct.unpack_from("<I", data, pos + 4)[0]
        body = pos + 8
        if cid == b"fmt ":
            if size < 16 or body + 16 > len(data):
                raise WavError("truncated fmt chunk")
            tag, ch, sr, _, align, bits = struct.unpack_from("<HHIIHH", data, body)
            if tag == _EXTENSIBLE and size >= 40:
                tag = struct.unpack_from("<H", data, body + 24)[0]
            fmt = {"tag": tag, "channels": ch, "sr": sr, "align": align, "bits": bits}
        elif cid == b"data":
            if fmt is None:
                raise WavError("data chunk before fmt chunk")
            length = min(size, total - body)
            return {**fmt, "offset": body, "length": length}
        pos = body + size + (size & 1)
    raise WavError("no data chunk")


ENCODINGS = {(_PCM, 8), (_PCM, 16), (_PCM, 24), (_PCM, 32), (_FLOAT, 32), (_FLOAT, 64)}


def checked_header(data: bytes, size: int | None = None) -> dict:
    """Header of a file that can be decoded, with its number of ``frames``."""
    h = parse_header(data, size)
    if h["channels"] < 1 or h["sr"] < 1:
        raise WavError("invalid channel count or sample rate")
    if (h["tag"], h["bits"]) not in ENCODINGS:
        raise WavError(f"unsupported encoding (format {h['tag']}, {h['bits']} bits)")
    h["frame"] = h["bits"] // 8 * h["channels"]
    h["frames"] = h["length"] // h["frame"]
    return h


def header_info(data: bytes, size: int) -> tuple[int, int]:
    """(frames, sample rate) from the front of a file of ``size`` bytes."""
    h = checked_header(data, size)
    return h["frames"], h["sr"]


SLICE_FRAMES = 1 << 18


def summarize(data: bytes, hop: int) -> tuple[int, int, int, float, list[float]]:
    """(sample rate, frames, channels, sum of squares, block energies) of a file, decoded in slices of
    whole hops."""
    h = checked_header(data)
    step = max(1, SLICE_FRAMES // hop) * hop
    total, blocks = 0.0, []
    for a in range(0, h["frames"], step):
        part, more = block_summary(_samples(data, h, a, min(a + step, h["frames"])), hop)
        total += part
        blocks += more.tolist()
    return h["sr"], h["frames"], h["channels"], total, blocks


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples as float64 (frames x channels), scaled to [-1, 1) for integer PCM."""
    h = checked_header(data)
    return _samples(data, h, 0, h["frames"]), h["sr"]


def _samples(data: bytes, h: dict, first: int, last: int) -> np.ndarray:
    bits, tag = h["bits"], h["tag"]
    raw = data[h["offset"] + first * h["frame"]:h["offset"] + last * h["frame"]]
    if tag == _PCM and bits == 8:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128.0) / 128.0
    elif tag == _PCM and bits == 16:
        x = np.frombuffer(raw, "<i2").astype(np.float64) / 32768.0
    elif tag == _PCM and bits == 24:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        v = b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16)
        x = np.where(v >= 1 << 23, v - (1 << 24), v).astype(np.float64) / float(1 << 23)
    elif tag == _PCM and bits == 32:
        x = np.frombuffer(raw, "<i4").astype(np.float64) / float(1 << 31)
    elif tag == _FLOAT and bits == 32:
        x = np.frombuffer(raw, "<f4").astype(np.float64)
    else:
        x = np.frombuffer(raw, "<f8").astype(np.float64)
    return x.reshape(-1, h["channels"])


def block_summary(samples: np.ndarray, hop: int) -> tuple[float, np.ndarray]:
    """(sum of squares over all channels, per-hop-block sums of squares of the channel mean)."""
    total = float(np.square(samples).sum())
    mono = samples.mean(axis=1) if samples.shape[1] > 1 else samples[:, 0]
    n = mono.shape[0]
    if n == 0:
        return total, np.zeros(0)
    pad = (-n) % hop
    sq = np.square(mono)
    if pad:
        sq = np.concatenate([sq, np.zeros(pad)])
    return total, sq.reshape(-1, hop).sum(axis=1)
