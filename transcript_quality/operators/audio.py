"""Audio operators: decode, validity, acoustic features."""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transcript_quality.config import AcousticConfig, ValidityConfig
from transcript_quality.functions.acoustic import acoustic_struct
from transcript_quality.functions.wav import header_info, summarize
from transcript_quality.schemas import DECODED_AUDIO

HEADER_BYTES = 65_536  # of a file, for its RIFF chunks before the samples

def decode_audio(files: DataFrame, cfg: AcousticConfig = AcousticConfig(), keep=()) -> DataFrame:
    """DEC-1: (path, content) -> one DECODED_AUDIO row per file.

    Runs as an Arrow-batched ``mapInPandas`` over the scan's own partitions (no shuffle of file
    bytes).  Each file leaves the task as ~n/hop block energies instead of n samples.  A file
    that cannot be decoded yields its path with NULL fields and an ``error`` text, so one bad
    file never fails the job.  ``keep`` names input columns passed through unchanged.

    Files are decoded in slices of whole hops, so a worker holds an Arrow batch of file bytes and one slice of samples.  Arrow
    batches are bounded by the session's ``spark.sql.execution.arrow.maxBytesPerBatch`` and ``maxRecordsPerBatch``, which
    this operator doesn't change."""
    hop = cfg.hop_length
    keep = list(keep)
    base_names = DECODED_AUDIO.fieldNames()
    schema = T.StructType(list(DECODED_AUDIO.fields) + [files.schema[k] for k in keep])
    names = schema.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    out.append((path, *summarize(bytes(content), hop), None))
                except Exception as e:  # noqa: BLE001 - fault-isolated row
                    out.append((path, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            res = pd.DataFrame(out, columns=base_names)
            for k in keep:
                res[k] = pdf[k].values
            yield res[names]

    return files.select("path", "content", *keep).mapInPandas(run, schema)


def acoustic_features(decoded: DataFrame, cfg: AcousticConfig = AcousticConfig(), keep=()) -> DataFrame:
    """MTH-1/2/3 on decoded rows: (path, rms_db, snr_db, duration, error, *keep); decode
    failures keep NULL features."""
    st = acoustic_struct("block_sq", "n_samples", "sr", cfg, total_sq="total_sq",
                         n_values=F.col("n_samples") * F.col("n_channels"))
    return decoded.select("path", "error", *keep, F.when(F.col("error").isNull(), st).alias("a")) \
        .select("path", "a.rms_db", "a.snr_db", "a.duration", "error", *keep)


def array_acoustic_features(df: DataFrame, samples: str, sr, cfg: AcousticConfig = AcousticConfig(),
                            keep=()) -> DataFrame:
    """ARR-3: the same features for waveforms already held as ARRAY<DOUBLE> columns."""
    from transcript_quality.functions.acoustic import block_energies
    sr_col = F.lit(sr) if isinstance(sr, (int, float)) else F.col(sr)
    st = acoustic_struct(block_energies(samples, cfg.hop_length), F.size(samples), sr_col, cfg)
    return df.select(*keep, F.size(samples).cast("long").alias("n_samples"), st.alias("a")) \
        .select(*keep, "n_samples", "a.rms_db", "a.snr_db", "a.duration")


def validity(size_bytes, duration, error=None, cfg: ValidityConfig = ValidityConfig()):
    """FLT-2 as a (is_valid, reason) pair of columns: size first, then header, then duration."""
    size_kb = F.col(size_bytes).cast("double") / 1024.0 if isinstance(size_bytes, str) else size_bytes / 1024.0
    dur = F.col(duration) if isinstance(duration, str) else duration
    reason = F.when(size_kb < F.lit(cfg.min_size_kb), "too_small")
    if error is not None:
        err = F.col(error) if isinstance(error, str) else error
        reason = reason.when(err.isNotNull(), "invalid_header")
    reason = reason.when(dur.isNull(), "invalid_header") \
        .when(dur < F.lit(cfg.min_duration_sec), "too_short")
    return reason.isNull().alias("is_valid"), reason.alias("reason")


def validate_audio(files: DataFrame, cfg: ValidityConfig = ValidityConfig()) -> DataFrame:
    """FLT-2 on a binary file scan: (path, size_kb, duration, is_valid, reason).

    Only headers are parsed: the duration is the data chunk's length over the frame size and rate, so no sample is
    decoded and no more than a file's first ``HEADER_BYTES`` reach Python; the file size comes from the scan."""
    head = files.select("path", "length", F.substring("content", 1, HEADER_BYTES).alias("head"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data, size in zip(pdf["head"], pdf["length"]):
                try:
                    rows.append((*header_info(bytes(data), int(size)), None))
                except Exception as e:  # noqa: BLE001 - fault-isolated row
                    rows.append((None, None, f"{type(e).__name__}: {e}"))
            yield pd.concat([pdf[["path", "length"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_samples", "sr", "error"])], axis=1)

    dec = head.mapInPandas(run, "path string, length long, n_samples long, sr int, error string")
    dur = F.when(F.col("sr") > 0, F.col("n_samples") / F.col("sr")).alias("duration")
    ok, reason = validity("length", dur, "error", cfg)
    return dec.select("path", (F.col("length") / 1024.0).alias("size_kb"), dur, ok, reason)
