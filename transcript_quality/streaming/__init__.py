from transcript_quality.streaming.monitor import (
    latest_per_key, run_to_table, windowed_histogram_stream,
)
from transcript_quality.streaming.ingest import ingest_stream, score_stream

__all__ = ["latest_per_key", "run_to_table", "windowed_histogram_stream", "ingest_stream", "score_stream"]
