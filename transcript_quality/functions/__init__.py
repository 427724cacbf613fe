from transcript_quality.functions.acoustic import acoustic_columns, acoustic_struct, block_energies
from transcript_quality.functions.confidence import confidence_chain, mean_confidence, valid_mean
from transcript_quality.functions.text import (
    base_filename, sanitize_filename, strip_file_scheme, tokenize_words, wer, wer_parts, wer_with_policy,
    word_edit_distance,
)

__all__ = [
    "acoustic_columns", "acoustic_struct", "block_energies", "confidence_chain", "mean_confidence", "valid_mean", "base_filename",
    "sanitize_filename", "strip_file_scheme", "tokenize_words", "wer", "wer_parts", "wer_with_policy",
    "word_edit_distance",
]
