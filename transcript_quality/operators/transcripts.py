"""Transcript operators: reference lookup join, WER with policy, confidence, feature rows."""

from __future__ import annotations

import uuid
from typing import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transcript_quality.functions.confidence import confidence_chain, mean_confidence
from transcript_quality.functions.text import (
    base_filename, strip_file_scheme, wer_parts, wer_with_policy,
)
from transcript_quality.operators.joins import join_corpus, join_small
from transcript_quality.schemas import FEATURE_HISTORY


def with_filename(df: DataFrame, path_col: str = "path", out: str = "filename") -> DataFrame:
    """STR-1/2: base filename of the scheme-stripped path."""
    return df.withColumn(out, base_filename(strip_file_scheme(F.col(path_col))))


def attach_reference(df: DataFrame, lookup: DataFrame, filename_col: str = "filename",
                     max_broadcast_bytes: int | None = None) -> DataFrame:
    """JON-1: left join of the reference text by filename; rows without a match are kept.

    The lookup has one row per landed file, so it grows with the corpus: it is broadcast only
    when its estimated size is within the limit, otherwise both sides shuffle on the filename."""
    lk = lookup.select(F.col("filename").alias(filename_col), "reference_text") \
        .dropDuplicates([filename_col])
    return join_small(df, lk, filename_col, "left", max_broadcast_bytes)


def add_wer(df: DataFrame, reference: str = "reference_text", hypothesis: str = "transcript",
            missing: float = -1.0, failed: float = -1.0, out: str = "wer") -> DataFrame:
    """STR-5/6/7: WER with policy (no reference -> ``missing``, no reference words ->
    ``failed``, missing transcript -> empty string)."""
    return df.withColumn(out, wer_with_policy(reference, hypothesis, missing, failed))


def wer_table(df: DataFrame, reference: str, hypothesis: str, keep=()) -> DataFrame:
    """Per pair: word counts, edit count and WER (NULL when the reference has no words)."""
    w = wer_parts(reference, hypothesis)
    return df.select(*keep, w.alias("w")).select(
        *keep, F.col("w.ref_words").cast("long").alias("ref_words"),
        F.col("w.hyp_words").cast("long").alias("hyp_words"),
        F.col("w.edits").cast("long").alias("edits"),
        F.try_divide(F.col("w.edits").cast("double"), F.col("w.ref_words").cast("double")).alias("wer"))


def add_confidence(df: DataFrame, chain: bool = False, out: str = "asr_confidence") -> DataFrame:
    """ARR-1 (ingest, word confidences only) or ARR-2 (offline chain word -> token -> score)."""
    if chain:
        return df.withColumn(out, confidence_chain("word_confidence", "token_confidence", "score"))
    return df.withColumn(out, mean_confidence("word_confidence"))


def combine(acoustic: DataFrame, transcripts: DataFrame, key: str = "path") -> DataFrame:
    """JON-2/3: acoustic features with the transcript of the same file (left join: a file
    without a transcript keeps its acoustics and gets an empty transcript)."""
    return join_corpus(acoustic, transcripts, key)


def to_feature_history(df: DataFrame, keep=()) -> DataFrame:
    """PRJ-1/2: canonical FEATURE_HISTORY projection (float columns); failed rows keep ``path``
    with NULL features.  In a row that did not fail a missing feature (no such column, or NULL) is 0.0; ``wer`` has its own
    value for that.  ``keep`` names extra columns carried after the canonical ones."""
    failed = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    cols = [F.col("path").cast("string").alias("path")]
    for f in FEATURE_HISTORY.fields[1:]:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name != "wer":
            value = F.coalesce(value.cast("float"), F.lit(0.0).cast("float"))
        cols.append(F.when(~failed, value).cast("float").alias(f.name))
    return df.select(*cols, *keep)


_MODELS: dict = {}  # of this Python worker, by model id


def model_of_worker(model_id: str, make_predict_fn: Callable) -> Callable:
    """The predict function of a model, made once in each Python worker."""
    if model_id not in _MODELS:
        _MODELS[model_id] = make_predict_fn()
    return _MODELS[model_id]


def transcribe(df: DataFrame, make_predict_fn: Callable, path_col: str = "path",
               batch_size: int = 16, model_id: str | None = None) -> DataFrame:
    """UDF-2: batched speech-to-text through a caller-supplied model.

    ``make_predict_fn()`` runs once per Python worker and ``model_id`` (the model stays loaded across tasks; two models
    need two ids; by default one call of ``transcribe`` is one model) and returns ``predict(paths: np.ndarray) ->
    {"transcript": [...], "word_confidence": [[...]]}``, with ``"token_confidence"`` and ``"score"`` if the model has them: the
    columns are those that the ground-truth job reads.  Files go to the model ``batch_size`` at a time, inside the scan's own
    partitions."""
    schema = T.StructType(list(df.schema.fields) + [
        T.StructField("transcript", T.StringType()),
        T.StructField("word_confidence", T.ArrayType(T.DoubleType())),
        T.StructField("token_confidence", T.ArrayType(T.DoubleType())),
        T.StructField("score", T.DoubleType()),
    ])
    key = model_id or uuid.uuid4().hex

    def run(batches):
        # the module's cache, not a copy of it that travels with this function
        from transcript_quality.operators.transcripts import model_of_worker
        predict = model_of_worker(key, make_predict_fn)
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[start:start + batch_size].copy()
                out = predict(chunk[path_col].to_numpy())
                chunk["transcript"] = [None if t is None else str(t) for t in out["transcript"]]
                none = [None] * len(chunk)
                for name in ("word_confidence", "token_confidence"):
                    chunk[name] = [None if c is None else [float(v) for v in c] for c in out.get(name, none)]
                chunk["score"] = [None if v is None else float(v) for v in out.get("score", none)]
                yield chunk

    return df.mapInPandas(run, schema)


def pad_confidences(rows) -> np.ndarray:
    """Helper for model wrappers: ragged confidence lists -> NaN-padded 2-D array."""
    width = max((len(r) for r in rows), default=0)
    out = np.full((len(rows), max(width, 1)), np.nan)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out
