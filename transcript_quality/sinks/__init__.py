from transcript_quality.sinks.writers import (
    append_features, append_registry, save_model, write_ground_truth, write_manifest,
    write_reference_lookup, write_stream,
)

__all__ = ["append_features", "append_registry", "save_model", "write_ground_truth",
           "write_manifest", "write_reference_lookup", "write_stream"]
