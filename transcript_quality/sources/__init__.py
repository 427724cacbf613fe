from transcript_quality.sources.audio import enough_files, read_audio, small_file_settings, stream_audio
from transcript_quality.sources.tables import load_model, read_features, read_manifest, read_reference_lookup

__all__ = ["enough_files", "read_audio", "small_file_settings", "stream_audio", "load_model", "read_features",
           "read_manifest", "read_reference_lookup"]
