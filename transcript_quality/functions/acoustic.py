"""Loudness, signal-to-noise ratio and duration as native array expressions.

The signal is reduced once to per-hop block energies (sum of squares of ``hop`` consecutive
samples).  Centred frames of ``frame = 2*h*hop`` samples (zero padded by frame/2 on both sides)
then cover exactly blocks k-h .. k+h-1, so frame energies are sums of at most 2h block values and
the whole SNR estimate is a handful of higher-order array functions per row: no explode, no
window, no shuffle.  ``block_energies`` turns a sample array into blocks; the WAV decoder emits
blocks directly so long recordings never travel as sample arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transcript_quality.config import AcousticConfig
from transcript_quality.functions.core import col_of as _c, let, sum_of, sum_sq_of


def block_energies(samples, hop: int) -> Column:
    """ARRAY<DOUBLE> of per-block sums of squares, blocks of ``hop`` samples (last may be short)."""
    def blocks(x):
        n = F.size(x)
        nb = F.floor((n + hop - 1) / hop).cast("int")
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(0), nb - 1),
            lambda b: sum_sq_of(F.slice(x, b * hop + 1, F.lit(hop))),
        )).otherwise(F.array().cast("array<double>"))
    return let(_c(samples).cast("array<double>"), blocks)


def _frame_rms(blocks: Column, n: Column, cfg: AcousticConfig) -> Column:
    h = cfg.half_frame_blocks()
    nb = F.size(blocks)

    def frame(k):
        lo = F.greatest(k - h, F.lit(0))
        hi = F.least(k + h - 1, nb - 1)
        energy = sum_of(F.slice(blocks, lo + 1, F.greatest(hi - lo + 1, F.lit(0))))
        return F.greatest(F.sqrt(energy / F.lit(float(cfg.frame_length))), F.lit(cfg.epsilon))

    return F.transform(F.sequence(F.lit(0), F.floor(n / cfg.hop_length).cast("int")), frame)


def _snr_from_sorted(srt: Column, cfg: AcousticConfig) -> Column:
    nf = F.size(srt)
    k = F.greatest(F.lit(1), F.floor(nf * F.lit(cfg.noise_ratio)).cast("int"))
    noise = sum_sq_of(F.slice(srt, 1, k)) / k
    signal = F.when(nf > k, sum_sq_of(F.slice(srt, k + 1, F.greatest(nf - k, F.lit(1)))) / (nf - k)) \
        .otherwise(noise)
    return F.lit(10.0) * F.log10(signal / (noise + F.lit(cfg.epsilon)))


def frame_rms(block_sq, n_samples, cfg: AcousticConfig = AcousticConfig()) -> Column:
    """ARRAY<DOUBLE> of centred-frame RMS values floored at epsilon (1 + n div hop frames)."""
    return let(_c(block_sq), lambda b: _frame_rms(b, _c(n_samples), cfg))


def rms_db(total_sq, n_values, cfg: AcousticConfig = AcousticConfig()) -> Column:
    """20*log10(sqrt(mean square) + eps); no samples -> silence level."""
    n = _c(n_values)
    value = F.lit(20.0) * F.log10(F.sqrt(_c(total_sq) / n) + F.lit(cfg.epsilon))
    return F.when(n > 0, value).otherwise(F.lit(cfg.silence_db))


def acoustic_struct(block_sq, n_samples, sr, cfg: AcousticConfig = AcousticConfig(),
                    total_sq=None, n_values=None) -> Column:
    """STRUCT<rms_db, snr_db, duration> for one file, every intermediate array built once.

    ``total_sq``/``n_values`` default to the block sums and the sample count (mono); the WAV
    decoder passes all-channel values for multichannel files."""
    fields = [_c(block_sq).alias("b"), _c(n_samples).cast("long").alias("n"),
              _c(sr).cast("double").alias("sr")]
    if total_sq is not None:
        fields.append(_c(total_sq).cast("double").alias("tot"))
    if n_values is not None:
        fields.append(_c(n_values).cast("long").alias("nv"))

    def body(s):
        n = s["n"]
        tot = s["tot"] if total_sq is not None else sum_of(s["b"])
        nv = s["nv"] if n_values is not None else n
        snr = let(F.array_sort(_frame_rms(s["b"], n, cfg)), lambda srt: _snr_from_sorted(srt, cfg))
        empty = n <= 0
        return F.struct(
            F.when(empty, F.lit(cfg.silence_db)).otherwise(rms_db(tot, nv, cfg)).alias("rms_db"),
            F.when(empty | (n < cfg.frame_length), F.lit(0.0)).otherwise(snr).alias("snr_db"),
            F.when(empty, F.lit(0.0)).otherwise(n.cast("double") / s["sr"]).alias("duration"),
        )
    return let(F.struct(*fields), body)


def acoustic_columns(block_sq, n_samples, sr, cfg: AcousticConfig = AcousticConfig(),
                     total_sq=None, n_values=None) -> dict[str, Column]:
    """The three fields of :func:`acoustic_struct` as separate column expressions (convenience
    for small inputs; operators select from one struct column instead)."""
    st = acoustic_struct(block_sq, n_samples, sr, cfg, total_sq, n_values)
    return {k: st[k] for k in ("rms_db", "snr_db", "duration")}
