"""Typed settings passed to operators (plain frozen dataclasses, no config framework)."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values that must equal the reference's defaults -------------------------------
# acoustic framing: frame 2048 samples, hop 512 samples, lowest 10 % of frames = noise,
# epsilon 1e-9, silence level -100 dB
# model: 100 boosted trees, depth 6, learning rate 0.1, seed 42; min 50 samples; rho bar 0.4;
# test split 20 %; features rms_db, snr_db, duration, asr_confidence; target wer
# scoring: review when predicted WER > 0.4
# SNR histogram buckets: -10, 0, 10, 20, 30, 40, 50, +Inf
# predicted-WER histogram buckets: 0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0 (+Inf implicit)
# alerts: 5xx rate over 5m > 0.05 per second held 2m (critical);
#         low-quality / requests over 10m > 0.5 held 10m (warning)
# dashboard levels: flagged in 15m green / orange >= 1 / red >= 10;
#                   p95 predicted WER green / orange >= 0.3 / red >= 0.5
# landing gate: at least 50 .wav files; audio validity: >= 1 KB and >= 0.5 s
# ------------------------------------------------------------------------------------------

SNR_BUCKETS = (-10.0, 0.0, 10.0, 20.0, 30.0, 40.0, 50.0, float("inf"))
WER_BUCKETS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0, float("inf"))
FEATURE_COLUMNS = ("rms_db", "snr_db", "duration", "asr_confidence")


@dataclass(frozen=True)
class AcousticConfig:
    frame_length: int = 2048
    hop_length: int = 512
    noise_ratio: float = 0.1
    epsilon: float = 1e-9
    silence_db: float = -100.0

    def half_frame_blocks(self) -> int:
        """Frames are centred: frame k covers blocks k-h .. k+h-1 with h = frame / (2 hop)."""
        if self.frame_length % (2 * self.hop_length):
            raise ValueError(
                f"frame_length ({self.frame_length}) must be a multiple of 2 * hop_length "
                f"({self.hop_length}) for block-based framing"
            )
        return self.frame_length // (2 * self.hop_length)


@dataclass(frozen=True)
class GBTConfig:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    seed: int = 42
    max_bins: int = 32


@dataclass(frozen=True)
class TrainingConfig:
    min_samples: int = 50
    min_spearman_rho: float = 0.4
    test_size: float = 0.2
    feature_columns: tuple[str, ...] = FEATURE_COLUMNS
    target_column: str = "wer"
    split_key: str = "path"
    seed: int = 42
    drop_unlabelled: bool = True
    gbt: GBTConfig = field(default_factory=GBTConfig)


@dataclass(frozen=True)
class ValidityConfig:
    min_size_kb: float = 1.0
    min_duration_sec: float = 0.5


@dataclass(frozen=True)
class ScoringConfig:
    review_threshold: float = 0.4


@dataclass(frozen=True)
class MonitorConfig:
    step: str = "15 seconds"
    snr_buckets: tuple[float, ...] = SNR_BUCKETS
    wer_buckets: tuple[float, ...] = WER_BUCKETS
    review_threshold: float = 0.4
    error_window: str = "5 minutes"
    error_threshold: float = 0.05
    error_hold: str = "2 minutes"
    drift_window: str = "10 minutes"
    drift_threshold: float = 0.5
    drift_hold: str = "10 minutes"
    flagged_window: str = "15 minutes"
    flagged_levels: tuple[float, float] = (1.0, 10.0)
    p95_levels: tuple[float, float] = (0.3, 0.5)
    watermark: str = "10 minutes"


@dataclass(frozen=True)
class IngestConfig:
    glob: str = "*.wav"
    min_files: int = 50
    missing_wer: float = -1.0
    failed_wer: float = -1.0
