"""Composed jobs: extract features, ground truth, train, validate, deploy, manifest upkeep,
scoring, monitoring, and the daily cycle that chains them."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.config import (
    AcousticConfig, IngestConfig, MonitorConfig, ScoringConfig, TrainingConfig, ValidityConfig,
)
from transcript_quality.functions.confidence import DEFAULT_CONFIDENCE
from transcript_quality.operators import manifest as MF
from transcript_quality.operators.joins import join_corpus
from transcript_quality.operators import model as ML
from transcript_quality.operators import monitoring as MON
from transcript_quality.operators import prepare as PR
from transcript_quality.operators import registry as RG
from transcript_quality.operators import stats as ST
from transcript_quality.operators.audio import acoustic_features, decode_audio, validity
from transcript_quality.operators.transcripts import (
    add_confidence, add_wer, attach_reference, to_feature_history, with_filename,
)
from transcript_quality import versions as V
from transcript_quality.schemas import REGISTRY
from transcript_quality.session import path_exists
from transcript_quality.sinks import writers as W
from transcript_quality.sources import audio as SA
from transcript_quality.sources import tables as SRC

log = logging.getLogger(__name__)


# ------------------------------------------------------------------ JOB-1 feature extraction
def features_from_files(files: DataFrame, lookup: DataFrame | None = None,
                        transcripts: DataFrame | None = None,
                        acoustic: AcousticConfig = AcousticConfig(),
                        ingest: IngestConfig = IngestConfig(),
                        validate: ValidityConfig | None = None, extractors=()) -> DataFrame:
    """Binary audio rows (batch or stream) -> FEATURE_HISTORY rows.

    ``extractors`` are extra feature transforms (DataFrame -> DataFrame, applied with
    ``df.transform``) over the decoded rows (path, sr, n_samples, n_channels, total_sq, block_sq);
    the columns they add are kept next to the canonical ones.

    ``transcripts`` (path, transcript, word_confidence) comes from :func:`transcribe` or any
    speech-to-text output keyed by the scan's ``path``; ``lookup`` is (filename, reference_text).
    With ``validate`` invalid files (too small, bad header, too short) are left out."""
    spark = files.sparkSession
    dec = decode_audio(files, acoustic, keep=("length",) if validate else ())
    if validate is not None:
        dur = F.when(F.col("sr") > 0, F.col("n_samples") / F.col("sr"))
        ok, _ = validity("length", dur, "error", validate)
        dec = dec.where(ok).drop("length")
    extra = []
    for fn in extractors:
        before = set(dec.columns)
        dec = dec.transform(fn)
        extra += [c for c in dec.columns if c not in before]
    ac = acoustic_features(dec, acoustic, keep=extra)
    return to_feature_history(label_acoustics(ac, lookup, transcripts, ingest), keep=extra)


def label_acoustics(ac: DataFrame, lookup: DataFrame | None = None,
                    transcripts: DataFrame | None = None,
                    ingest: IngestConfig = IngestConfig()) -> DataFrame:
    """The part of JOB-1 after the acoustics: per-file acoustic rows keyed by ``path`` ⟕
    transcripts (JON-2) -> mean word confidence (ARR-1) -> reference by filename (JON-1) ->
    WER with the ingest policy (STR-5/6/7).  Double columns; the canonical float projection
    is :func:`to_feature_history`."""
    if transcripts is None:  # nothing to join: no shuffle
        joined = ac.withColumn("transcript", F.lit(None).cast("string")).withColumn("asr_confidence", F.lit(None).cast("double"))
    else:
        # the confidence list is reduced to its mean before the join, so only one double per file
        # crosses the shuffle; a file without a transcript gets the default
        joined = join_corpus(ac, add_confidence(transcripts).select("path", "transcript", "asr_confidence"), "path")
    rows = with_filename(joined).withColumn("asr_confidence", F.coalesce("asr_confidence", F.lit(DEFAULT_CONFIDENCE)))
    if lookup is not None:
        rows = attach_reference(rows, lookup)
    else:
        rows = rows.withColumn("reference_text", F.lit(None).cast("string"))
    return add_wer(rows, "reference_text", "transcript", ingest.missing_wer, ingest.failed_wer)


def extract_features(spark: SparkSession, landing: str, lookup_path: str | None = None,
                     transcripts: DataFrame | None = None, history_path: str | None = None,
                     acoustic: AcousticConfig = AcousticConfig(), ingest: IngestConfig = IngestConfig(),
                     validate: ValidityConfig | None = None, extractors=()) -> DataFrame:
    """JOB-1 in batch form; appends to ``history_path`` when given."""
    files = SA.read_audio(spark, landing, ingest.glob,
                          min_size_kb=validate.min_size_kb if validate else None)
    lookup = SRC.read_reference_lookup(spark, lookup_path) if lookup_path else None
    rows = features_from_files(files, lookup, transcripts, acoustic, ingest, validate, extractors)
    if history_path:
        W.append_features(rows, history_path)
    return rows


# ------------------------------------------------------------------ JOB-2 ground truth
def generate_ground_truth(manifest: DataFrame, files: DataFrame, hypotheses: DataFrame,
                          acoustic: AcousticConfig = AcousticConfig(),
                          out_path: str | None = None) -> tuple[DataFrame, dict]:
    """Manifest rows whose audio exists -> acoustics + hypothesis + confidence chain + WER
    (failure -> 1.0).  ``hypotheses``: audio_path, hypothesis_text, word_confidence,
    token_confidence, score.  Returns (rows, stats) where stats are one-row DataFrames.

    With ``out_path`` the rows are written once and the statistics read the written table, so
    decoding and WER are not recomputed for each statistic; stats then has the write's run summary as "run" (a dict)."""
    present = MF.existing_audio(manifest, files, by="path")
    feats = acoustic_features(decode_audio(files, acoustic), acoustic) \
        .select(F.col("path").alias("audio_path"), "rms_db", "snr_db", "duration")
    out = ground_truth_rows(present, feats, hypotheses)
    if out_path:
        run = W.write_ground_truth(out, out_path)
        out = SRC.read_ground_truth(out.sparkSession, out_path)
        return out, {**ground_truth_stats(out), "run": run}
    return out, ground_truth_stats(out)


def ground_truth_rows(manifest: DataFrame, feats: DataFrame, hypotheses: DataFrame) -> DataFrame:
    """JOB-2 after the decode: manifest (audio_id, audio_path, reference_text) ⟕ acoustics
    (audio_path, rms_db, snr_db, duration) ⟕ hypotheses (JON-3), all matched on the
    scheme-stripped path -> confidence chain (ARR-2) -> WER, failure -> 1.0 (STR-5/6/7)."""
    def key(c):
        return F.regexp_replace(F.col(c), "^file:", "").alias("audio_path")
    m = manifest.select("audio_id", key("audio_path"), "reference_text")
    ac = feats.select(key("audio_path"), "rms_db", "snr_db", "duration")
    hyp = add_confidence(hypotheses, chain=True).select(key("audio_path"), "hypothesis_text", "asr_confidence")
    rows = join_corpus(join_corpus(m, ac, "audio_path"), hyp, "audio_path") \
        .withColumn("asr_confidence", F.coalesce("asr_confidence", F.lit(DEFAULT_CONFIDENCE)))
    rows = add_wer(rows, "reference_text", "hypothesis_text", missing=1.0, failed=1.0)
    return rows.select("audio_id", "audio_path", "reference_text",
                       F.coalesce("hypothesis_text", F.lit("")).alias("hypothesis_text"),
                       "wer", "asr_confidence", "duration", "rms_db", "snr_db")


def ground_truth_stats(rows: DataFrame) -> dict:
    """AGG-1/2/3 over ground-truth rows."""
    return {"duration": ST.duration_stats(rows), "wer": ST.wer_stats(rows),
            "confidence": ST.confidence_stats(rows)}


# ------------------------------------------------------------------ JOB-3 / 4 / 5 models
def training_rows(spark: SparkSession, history_path: str, cfg: TrainingConfig) -> DataFrame:
    df = SRC.read_features(spark, history_path)
    PR.require_columns(df, cfg.feature_columns, cfg.target_column)
    return PR.prepare(df, cfg.feature_columns, cfg.target_column, cfg.drop_unlabelled)


def train(spark: SparkSession, history_path: str, output_dir: str,
          cfg: TrainingConfig = TrainingConfig(), registry_path: str | None = None) -> dict:
    """JOB-3: guard -> split -> fit -> evaluate -> warn below the rho bar -> save -> register."""
    rows = training_rows(spark, history_path, cfg)
    PR.require_min_samples(rows, cfg.min_samples)
    train_df, test_df = PR.train_test(rows, cfg.split_key, cfg.test_size, cfg.seed)
    model = ML.fit(train_df, cfg)
    met = ML.evaluate(model, test_df, cfg)
    now = datetime.now(timezone.utc)
    version, path = W.save_model(model, output_dir, now)
    n_rows = rows.count()
    result = {"version": version, "model_path": path, "num_samples": n_rows,
              "created_at": now, **{k: met[k] for k in ("spearman_rho", "spearman_p_value", "rmse")}}
    if registry_path:
        reg = spark.createDataFrame([(version, path, now.replace(tzinfo=None), met["spearman_rho"],
                                      met["spearman_p_value"], met["rmse"], n_rows, "candidate")], REGISTRY)
        W.append_registry(reg, registry_path)
    return result


def validate(spark: SparkSession, history_path: str, candidate_path: str,
             production_path: str | None, cfg: TrainingConfig = TrainingConfig(),
             allow_equal: bool = False) -> dict:
    """JOB-4: both models on the same hash-split test rows; gate = candidate rho > production
    rho (a missing or broken production model counts as -1.0)."""
    rows = training_rows(spark, history_path, cfg)
    _, test_df = PR.train_test(rows, cfg.split_key, cfg.test_size, cfg.seed)
    cand = ML.evaluate(SRC.load_model(spark, candidate_path), test_df, cfg)
    prod = None
    if production_path:
        try:
            prod = ML.evaluate(SRC.load_model(spark, production_path), test_df, cfg)
        except Exception as e:  # noqa: BLE001 - broken production counts as absent
            log.error("Failed to load/eval production model: %s", e)
    c = spark.createDataFrame([(cand["spearman_rho"],)], "spearman_rho double")
    p = spark.createDataFrame([(prod["spearman_rho"],)], "spearman_rho double") if prod else None
    gate = RG.compare_models(c, p, allow_equal=allow_equal).first()
    return {"candidate": gate["candidate"], "production": gate["production"],
            "promote": bool(gate["promote"]), "candidate_metrics": cand, "production_metrics": prod}


def _production_root(registry_path: str) -> str:
    return f"{registry_path.rstrip('/')}_production"


def deploy(spark: SparkSession, registry_path: str, version: str) -> None:
    """JOB-5: append the production row for ``version`` to the registry (a log), then switch the production pointer to its folder, which is never
    written again.  Scorers follow the pointer: they load the old model or the new one, also if this job is stopped half-way."""
    reg = spark.read.schema(REGISTRY).parquet(registry_path)
    row = RG.promote(reg, version)
    path = row.first()["path"]
    W.append_registry(row, registry_path)
    V.point(spark, _production_root(registry_path), path)


def roll_back(spark: SparkSession, registry_path: str) -> str:
    """Make the model that was in production before the present one current again; returns its folder."""
    root = _production_root(registry_path)
    before = V.resolve(spark, root, back=1)
    if before is None:
        raise FileNotFoundError(f"No earlier production model: {registry_path}")
    V.point(spark, root, before)
    return before


def production_model_path(spark: SparkSession, registry_path: str) -> str | None:
    """The folder that the production pointer names; without a pointer, the newest production row's."""
    if not path_exists(spark, registry_path):
        return None
    target = V.resolve(spark, _production_root(registry_path))
    if target is not None:
        return target
    reg = spark.read.schema(REGISTRY).parquet(registry_path)
    row = RG.production_version(reg).first()
    return row["path"] if row and row["path"] else None


# ------------------------------------------------------------------ JOB-6 / 7 manifest
def merge_manifest_job(spark: SparkSession, existing_path: str | None, new_rows: DataFrame,
                       out_path: str, max_samples: int | None = None) -> DataFrame:
    """JOB-6: existing manifest (if any) + new rows not yet present, truncated to
    ``max_samples`` with existing rows first; written as CSV to ``out_path``, which may be ``existing_path`` (then a manifest that another
    job replaced in the meantime is a ``versions.Conflict``).  Returns a read of what was written."""
    in_place = existing_path is not None and existing_path.rstrip("/") == out_path.rstrip("/")
    based_on = V.current_number(spark, out_path) if in_place else None
    if existing_path and path_exists(spark, existing_path):
        existing = SRC.read_manifest(spark, existing_path)
    else:
        existing = spark.createDataFrame([], new_rows.schema)
    merged = MF.merge_manifest(existing, new_rows, "audio_id", max_samples)
    return W.replace_manifest(merged, out_path, based_on)


def prepare_lookup(spark: SparkSession, manifest_path: str, files: DataFrame, lookup_path: str,
                   sample_size: int = 51, seed: int = 42, as_json: bool = False) -> dict:
    """JOB-7: seeded exact sample of the manifest, kept where the audio exists, written as the
    filename -> reference-text lookup.  Returns the copied / skipped / entry counts."""
    manifest = SRC.read_manifest(spark, manifest_path, require_rows=True)
    sample = MF.sample_exact(manifest, "audio_id", sample_size, seed).persist()
    present = MF.existing_audio(sample, files)
    lookup = MF.reference_lookup(present)
    W.write_reference_lookup(lookup, lookup_path, as_json=as_json)
    counts = sample.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    copied = present.count()
    sample.unpersist()
    return {"sampled": counts, "copied": copied, "skipped": counts - copied,
            "entries": SRC.read_reference_lookup(spark, lookup_path).count()}


# ------------------------------------------------------------------ JOB-8 / 9 score and monitor
def score_batch(spark: SparkSession, features: DataFrame, model_path: str,
                cfg: TrainingConfig = TrainingConfig(), scoring: ScoringConfig = ScoringConfig(), ts: str | None = None) -> DataFrame:
    """JOB-8: SCORED rows, one for every feature row (failed files with status 500); :func:`monitor` reads them."""
    return ML.scored_rows(ML.score(SRC.load_model(spark, model_path), features, cfg, scoring), ts)


def score_audio(files: DataFrame, model_path: str, transcripts: DataFrame | None = None, cfg: TrainingConfig = TrainingConfig(),
                scoring: ScoringConfig = ScoringConfig(), acoustic: AcousticConfig = AcousticConfig()) -> DataFrame:
    """JOB-8 from a binary file scan (batch or stream): decode -> features -> SCORED rows."""
    rows = features_from_files(files, None, transcripts, acoustic)
    return score_batch(files.sparkSession, rows, model_path, cfg, scoring)


def monitor(scored: DataFrame, ts: str = "ts", cfg: MonitorConfig = MonitorConfig()) -> dict[str, DataFrame]:
    """JOB-9: every dashboard series and alert over a SCORED table."""
    flagged = MON._not_nan_gt(F.col("predicted_wer").cast("double"), cfg.review_threshold)
    is_5xx = F.col("status").cast("string").rlike("^5..$")
    return {
        "wer_histogram": MON.cumulative_histogram(scored, "predicted_wer", cfg.wer_buckets),
        "snr_histogram": MON.cumulative_histogram(scored, "snr_db", cfg.snr_buckets),
        "summary": MON.histogram_summary(scored, "predicted_wer", cfg.review_threshold),
        "p95": MON.windowed_quantile(scored, ts, "predicted_wer", cfg.step, 0.95, cfg.wer_buckets, cfg),
        "request_rate": MON.rate_series(scored, ts, ["1 minute"], cfg.step),
        "flagged_increase": MON.increase_series(scored, ts, cfg.flagged_window, cfg.step, flagged,
                                                cfg.flagged_levels),
        "error_alert": MON.error_rate_alert(scored, ts, is_5xx, cfg),
        "drift_alert": MON.drift_alert(scored, ts, flagged, cfg),
    }


# ------------------------------------------------------------------ JOB-10 daily cycle
def run_daily(spark: SparkSession, landing: str, history_path: str, models_dir: str,
              registry_path: str, lookup_path: str | None = None,
              transcripts: DataFrame | None = None, archive_dir: str | None = None, checkpoint: str | None = None,
              cfg: TrainingConfig = TrainingConfig(), ingest: IngestConfig = IngestConfig(),
              acoustic: AcousticConfig = AcousticConfig()) -> dict:
    """Gate on landed files -> streaming ingest (once per file) -> train -> validate -> deploy
    only when the candidate beats production.  ``checkpoint`` remembers what was ingested from ``landing`` into this history; by
    default it lies beside the history."""
    from transcript_quality.streaming.ingest import ingest_stream
    if not SA.enough_files(spark, landing, ingest.min_files, ingest.glob):
        return {"status": "waiting"}
    lookup = SRC.read_reference_lookup(spark, lookup_path) if lookup_path else None
    ingest_stream(spark, landing, history_path, checkpoint or f"{history_path.rstrip('/')}_ingest_checkpoint",
                  lookup, transcripts, archive_dir, acoustic, ingest)
    trained = train(spark, history_path, models_dir, cfg, registry_path)
    gate = validate(spark, history_path, trained["model_path"],
                    production_model_path(spark, registry_path), cfg)
    if gate["promote"]:
        deploy(spark, registry_path, trained["version"])
    return {"status": "promoted" if gate["promote"] else "kept", "trained": trained, "gate": gate}
