"""Streaming ingest and scoring.

Feature extraction is stateless per file (decode -> array expressions -> joins with static
lookups), so it runs natively on a stream.  Each micro-batch overwrites a folder of its own in the history
(`sinks.writers.write_stream`), so every landed file appears exactly once, even when executors are lost mid-batch or a
batch is retried, and rows that batch jobs appended stay visible."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from transcript_quality.config import AcousticConfig, IngestConfig, ScoringConfig, TrainingConfig
from transcript_quality.operators.model import score
from transcript_quality.sinks.writers import history_metrics, write_stream
from transcript_quality.sources.audio import small_file_settings, stream_audio


def ingest_stream(spark: SparkSession, landing: str, history_path: str, checkpoint: str,
                  lookup: DataFrame | None = None, transcripts: DataFrame | None = None,
                  archive_dir: str | None = None, acoustic: AcousticConfig = AcousticConfig(),
                  ingest: IngestConfig = IngestConfig(), available_now: bool = True):
    """STM-1: landed audio -> feature rows appended to ``history_path``.  ``checkpoint`` belongs to this landing
    folder and history and must outlive the session.  The run summary is observed on the way (`summaries.run_summaries`)."""
    from transcript_quality.plans.jobs import features_from_files
    files = stream_audio(spark, landing, ingest.glob, archive_dir)
    rows = features_from_files(files, lookup, transcripts, acoustic, ingest)
    return write_stream(rows, history_path, checkpoint, available_now=available_now, metrics=history_metrics(), conf=small_file_settings(spark))


def score_stream(features: DataFrame, model: PipelineModel, cfg: TrainingConfig = TrainingConfig(),
                 scoring: ScoringConfig = ScoringConfig()) -> DataFrame:
    """STM-2: streaming scoring (the fitted pipeline transforms streaming DataFrames); every row is answered, see
    :func:`transcript_quality.operators.model.score`."""
    return score(model, features, cfg, scoring)
