"""Canonical schemas shared by sources, operators and sinks."""

from pyspark.sql import types as T

AUDIO_FILES = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# one row per decoded file: sample rate, sizes, per-hop-block energies of the channel mean
DECODED_AUDIO = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("sr", T.IntegerType(), True),
    T.StructField("n_samples", T.LongType(), True),
    T.StructField("n_channels", T.IntegerType(), True),
    T.StructField("total_sq", T.DoubleType(), True),
    T.StructField("block_sq", T.ArrayType(T.DoubleType(), False), True),
    T.StructField("error", T.StringType(), True),
])

TRANSCRIPTS = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("transcript", T.StringType(), True),
    T.StructField("word_confidence", T.ArrayType(T.DoubleType(), True), True),
    T.StructField("token_confidence", T.ArrayType(T.DoubleType(), True), True),
    T.StructField("score", T.DoubleType(), True),
])

REFERENCE_LOOKUP = T.StructType([
    T.StructField("filename", T.StringType(), False),
    T.StructField("reference_text", T.StringType(), True),
])

MANIFEST = T.StructType([
    T.StructField("audio_id", T.StringType(), True),
    T.StructField("audio_path", T.StringType(), True),
    T.StructField("reference_text", T.StringType(), True),
    T.StructField("speaker_id", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
])

FEATURE_HISTORY = T.StructType([
    T.StructField("path", T.StringType(), True),
    T.StructField("rms_db", T.FloatType(), True),
    T.StructField("snr_db", T.FloatType(), True),
    T.StructField("duration", T.FloatType(), True),
    T.StructField("asr_confidence", T.FloatType(), True),
    T.StructField("wer", T.FloatType(), True),
])

GROUND_TRUTH = T.StructType([
    T.StructField("audio_id", T.StringType(), True),
    T.StructField("audio_path", T.StringType(), True),
    T.StructField("reference_text", T.StringType(), True),
    T.StructField("hypothesis_text", T.StringType(), True),
    T.StructField("wer", T.DoubleType(), True),
    T.StructField("asr_confidence", T.DoubleType(), True),
    T.StructField("duration", T.DoubleType(), True),
    T.StructField("rms_db", T.DoubleType(), True),
    T.StructField("snr_db", T.DoubleType(), True),
])

SCORED = T.StructType([
    T.StructField("path", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("snr_db", T.DoubleType(), True),
    T.StructField("predicted_wer", T.DoubleType(), True),
    T.StructField("review_recommended", T.BooleanType(), True),
    T.StructField("transcript", T.StringType(), True),
    T.StructField("status", T.IntegerType(), True),
])

REGISTRY = T.StructType([
    T.StructField("version", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("spearman_rho", T.DoubleType(), True),
    T.StructField("spearman_p_value", T.DoubleType(), True),
    T.StructField("rmse", T.DoubleType(), True),
    T.StructField("num_samples", T.LongType(), True),
    T.StructField("stage", T.StringType(), False),
])
