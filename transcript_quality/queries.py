"""Registered queries over the driver's test tables, each with its DuckDB twin.

No audio ships with the test tables, so each query runs the library operator on a stand-in:

* ``embeddings.embedding`` (64 floats) is a waveform (frame 16, hop 4, 16 samples/s) and, mapped
  to [0, 1], a list of word confidences;
* ``conversations`` turn t / t+1 and ``benchmark`` / ``documents`` texts are reference /
  hypothesis pairs; ``documents`` and ``labels`` are manifest rows and landed files;
* ``lineitem`` numeric columns form a feature-history table (rms_db, snr_db, duration,
  asr_confidence, wer), with NaN / NULL holes that the cleaning step must drop;
* ``events`` is scored traffic: value / 100 = predicted WER, value / 5 - 10 = SNR,
  ``event_type = 'error'`` = a 5xx response; one hour of events stands for one minute.

Every query reads whole tables and whole texts.  Doubles are rounded to 6 decimals on both
sides, counts are BIGINT, time steps are epoch seconds.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.config import AcousticConfig, GBTConfig, MonitorConfig, TrainingConfig
from transcript_quality.functions.confidence import mean_confidence, valid_mean
from transcript_quality.functions.text import base_filename, sanitize_filename, strip_file_scheme, tokenize_words
from transcript_quality.operators import manifest as MF
from transcript_quality.operators import monitoring as MON
from transcript_quality.operators import prepare as PR
from transcript_quality.operators import registry as RG
from transcript_quality.operators import stats as ST
from transcript_quality.operators.audio import array_acoustic_features, validity
from transcript_quality.operators.joins import join_small
from transcript_quality.operators.partitioning import copartition, spread
from transcript_quality.operators.transcripts import wer_table

ND = 6  # decimals kept in compared doubles
STANDIN_ACOUSTIC = AcousticConfig(frame_length=16, hop_length=4)
STANDIN_SR = 16
FEATURES = ("rms_db", "snr_db", "duration", "asr_confidence")
# one hour of stand-in events = one minute of traffic: steps and windows scale by 60
STANDIN_MONITOR = MonitorConfig(step="1 hour", error_window="5 hours", error_hold="2 hours",
                                drift_window="10 hours", drift_hold="10 hours",
                                flagged_window="15 hours", error_threshold=0.05 / 60)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # event-time steps are epoch seconds of naive timestamps: read them as UTC wall clock
    if spark.conf.get("spark.sql.session.timeZone", "") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """A table as a stream of its files.  The pattern matches the table whether it is one file or a folder of part files with any names (a
    stream can't be pointed at a single file, and a file name filter on ``sf_dir`` finds no part file)."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).options(**options).parquet(f"{sf_dir.rstrip('/')}/{{{name}}}.parquet")


def rd(c, nd: int = ND):
    return F.round(F.col(c) if isinstance(c, str) else c, nd)


# ------------------------------------------------------------------ stand-in views (Spark + SQL)
def feature_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_rows_of(table(spark, sf_dir, "lineitem"))


def feature_rows_of(li: DataFrame) -> DataFrame:
    return li.select(
        F.concat(F.lit("file:/landing/"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string"), F.lit(".wav")).alias("path"),
        (-F.col("l_quantity")).alias("rms_db"),
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount") * 400).alias("snr_db"),
        (F.col("l_extendedprice") / 10000.0).alias("duration"),
        F.when(F.col("l_tax") == F.lit(0.08).cast("double"), F.lit(None).cast("double"))
         .otherwise(1 - F.col("l_tax") * 10).alias("asr_confidence"),
        (F.col("l_tax") * 5 + F.col("l_discount") * 2).alias("wer"),
    )


FEATURE_VIEW_SQL = """
feat AS (
  SELECT 'file:/landing/' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '.wav' AS path,
         -l_quantity AS rms_db,
         CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_discount * 400 END AS snr_db,
         l_extendedprice / 10000.0 AS duration,
         CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN NULL ELSE 1 - l_tax * 10 END AS asr_confidence,
         l_tax * 5 + l_discount * 2 AS wer
  FROM lineitem),
prepared AS (
  SELECT * FROM feat
  WHERE rms_db IS NOT NULL AND NOT isnan(rms_db) AND snr_db IS NOT NULL AND NOT isnan(snr_db)
    AND duration IS NOT NULL AND NOT isnan(duration)
    AND asr_confidence IS NOT NULL AND NOT isnan(asr_confidence)
    AND wer IS NOT NULL AND NOT isnan(wer))"""


def prepared_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.prepare(feature_view(spark, sf_dir), FEATURES, "wer")


def candidate_prediction(df: DataFrame) -> DataFrame:
    """A fixed scoring rule standing in for a trained model's output."""
    return df.withColumn("prediction", 0.1 + 0.5 * (1 - F.col("asr_confidence")) + 0.005 * F.col("snr_db"))


def production_prediction(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", 0.3 + 0.01 * F.col("duration"))


CANDIDATE_SQL = "0.1 + 0.5 * (1 - asr_confidence) + 0.005 * snr_db"
PRODUCTION_SQL = "0.3 + 0.01 * duration"

TOKENS_SQL = ("list_filter(string_split(regexp_replace(regexp_replace(coalesce({t}, ''), '\\s\\s+', ' ', 'g'), "
              "'^\\s+|\\s+$', '', 'g'), ' '), lambda w: w <> '')")


def tokens_sql(expr: str) -> str:
    return TOKENS_SQL.format(t=expr)


# word-level edit distance by rows of the DP table: row i+1 from row i with
# t_j = min(d_j + 1, d_{j-1} + cost) and d'_j = j + min_{k<=j}(t_k - k)
def edit_distance_cte(pairs: str, keys: str) -> str:
    on = " AND ".join(f"p.{k.strip()} = dp.{k.strip()}" for k in keys.split(","))
    part = ", ".join(f"dp.{k.strip()}" for k in keys.split(","))
    return f"""
dp({keys}, i, j, d) AS (
  SELECT {keys}, 0, j, j FROM {pairs}, range(0, m + 1) t(j)
  UNION ALL
  SELECT {keys}, i, j,
         j + min(t - j) OVER (PARTITION BY {keys} ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  FROM (
    SELECT {part}, dp.i + 1 AS i, dp.j,
           CASE WHEN dp.j = 0 THEN dp.i + 1
                ELSE least(dp.d + 1, lag(dp.d) OVER (PARTITION BY {part} ORDER BY dp.j)
                           + CASE WHEN p.r[dp.i + 1] = p.h[dp.j] THEN 0 ELSE 1 END) END AS t
    FROM dp JOIN {pairs} p ON {on}
    WHERE dp.i < p.n) s),
dist AS (
  SELECT {part}, dp.d AS edits FROM dp JOIN {pairs} p ON {on} AND dp.i = p.n AND dp.j = p.m)"""


# ------------------------------------------------------------------ acoustics
def _acoustic(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return array_acoustic_features(emb, "embedding", STANDIN_SR, STANDIN_ACOUSTIC, keep=("vec_id", "label"))


ACOUSTIC_SQL = """
s AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
blk AS (SELECT vec_id, pos // 4 AS b, sum(x * x) AS e FROM s GROUP BY vec_id, pos // 4),
base AS (SELECT vec_id, label, len(embedding) AS n FROM embeddings),
tot AS (SELECT vec_id, sum(x * x) AS ss FROM s GROUP BY vec_id),
fr AS (SELECT vec_id, k FROM base, range(0, n // 4 + 1) r(k) WHERE n >= 16),
fe AS (SELECT fr.vec_id, fr.k, greatest(sqrt(coalesce(sum(blk.e), 0) / 16.0), 1e-9) AS rms
       FROM fr LEFT JOIN blk ON blk.vec_id = fr.vec_id AND blk.b BETWEEN fr.k - 2 AND fr.k + 1
       GROUP BY fr.vec_id, fr.k),
rk AS (SELECT vec_id, rms, row_number() OVER (PARTITION BY vec_id ORDER BY rms, k) AS r,
              greatest(1, floor(count(*) OVER (PARTITION BY vec_id) * 0.1)) AS kk FROM fe),
sn AS (SELECT vec_id, avg(rms * rms) FILTER (WHERE r <= kk) AS noise, avg(rms * rms) FILTER (WHERE r > kk) AS sig
       FROM rk GROUP BY vec_id),
ac AS (
  SELECT base.vec_id, base.label, CAST(base.n AS BIGINT) AS n_samples,
         CASE WHEN base.n = 0 THEN -100.0 ELSE 20 * log10(sqrt(tot.ss / base.n) + 1e-9) END AS rms_db,
         CASE WHEN base.n < 16 THEN 0.0 ELSE 10 * log10(coalesce(sn.sig, sn.noise) / (sn.noise + 1e-9)) END AS snr_db,
         base.n / 16.0 AS duration
  FROM base LEFT JOIN tot USING (vec_id) LEFT JOIN sn USING (vec_id))"""


@register("acoustic_features", f"""
WITH {ACOUSTIC_SQL}
SELECT vec_id, label, n_samples, round(duration, 6) AS duration, round(rms_db, 6) AS rms_db,
       round(snr_db, 6) AS snr_db FROM ac""")
def acoustic_features(spark, sf_dir):
    a = _acoustic(spark, sf_dir)
    return a.select("vec_id", "label", "n_samples", rd("duration").alias("duration"),
                    rd("rms_db").alias("rms_db"), rd("snr_db").alias("snr_db"))


@register("acoustic_by_label", f"""
WITH {ACOUSTIC_SQL}
SELECT label, CAST(count(*) AS BIGINT) AS n_files, round(avg(rms_db), 6) AS mean_rms_db,
       round(stddev_pop(rms_db), 6) AS std_rms_db, round(avg(snr_db), 6) AS mean_snr_db,
       round(min(snr_db), 6) AS min_snr_db, round(max(snr_db), 6) AS max_snr_db,
       round(sum(duration), 6) AS total_duration
FROM ac GROUP BY label""")
def acoustic_by_label(spark, sf_dir):
    a = _acoustic(spark, sf_dir)
    return a.groupBy("label").agg(
        F.count(F.lit(1)).cast("long").alias("n_files"), rd(F.avg("rms_db")).alias("mean_rms_db"),
        rd(F.stddev_pop("rms_db")).alias("std_rms_db"), rd(F.avg("snr_db")).alias("mean_snr_db"),
        rd(F.min("snr_db")).alias("min_snr_db"), rd(F.max("snr_db")).alias("max_snr_db"),
        rd(F.sum("duration")).alias("total_duration"))


# ------------------------------------------------------------------ validity
@register("audio_validity", f"""
WITH d AS (SELECT doc_id, n_chars, len({tokens_sql('text')}) / 2.5 AS duration FROM documents)
SELECT doc_id, round(n_chars / 1024.0, 6) AS size_kb, round(duration, 6) AS duration,
       (n_chars / 1024.0 >= 1 AND duration >= 0.5) AS is_valid,
       CASE WHEN n_chars / 1024.0 < 1 THEN 'too_small' WHEN duration < 0.5 THEN 'too_short' END AS reason
FROM d""")
def audio_validity(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"))
    dur = (F.size(tokenize_words("text")) / 2.5).alias("duration")
    d = docs.select("doc_id", "n_chars", dur)
    ok, reason = validity("n_chars", "duration")
    return d.select("doc_id", rd(F.col("n_chars") / 1024.0).alias("size_kb"), rd("duration").alias("duration"),
                    ok, reason)


# ------------------------------------------------------------------ word error rate
CONV_PAIRS_SQL = f"""
toks AS (SELECT conv_id, turn, {tokens_sql('text')} AS w FROM conversations),
pairs AS (SELECT a.conv_id, a.turn, a.w AS r, b.w AS h, len(a.w) AS n, len(b.w) AS m
          FROM toks a JOIN toks b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


@register("wer_pairs", f"""
WITH RECURSIVE {CONV_PAIRS_SQL}, {edit_distance_cte('pairs', 'conv_id, turn')}
SELECT p.conv_id, p.turn, CAST(p.n AS BIGINT) AS ref_words, CAST(p.m AS BIGINT) AS hyp_words,
       CAST(d.edits AS BIGINT) AS edits, round(CASE WHEN p.n = 0 THEN NULL ELSE d.edits / p.n END, 6) AS wer
FROM pairs p JOIN dist d ON d.conv_id = p.conv_id AND d.turn = p.turn""")
def wer_pairs(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    a = copartition(conv.select("conv_id", "turn", F.col("text").alias("reference")), ["conv_id", "turn"])
    b = copartition(conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis")),
                    ["conv_id", "turn"])
    pairs = a.join(b, ["conv_id", "turn"])
    w = wer_table(pairs, "reference", "hypothesis", keep=("conv_id", "turn"))
    return w.select("conv_id", "turn", "ref_words", "hyp_words", "edits", rd("wer").alias("wer"))


@register("wer_policy", f"""
WITH RECURSIVE
files AS (SELECT doc_id, CAST(doc_id AS VARCHAR) || '.wav' AS filename, text AS transcript FROM documents),
lookup AS (SELECT CAST(item_id AS VARCHAR) || '.wav' AS filename, text AS reference_text FROM benchmark),
j AS (SELECT f.doc_id, f.transcript, l.reference_text FROM files f LEFT JOIN lookup l USING (filename)),
pairs AS (SELECT doc_id, {tokens_sql('reference_text')} AS r, {tokens_sql('transcript')} AS h FROM j
          WHERE reference_text IS NOT NULL AND reference_text <> ''),
pairs2 AS (SELECT doc_id, r, h, len(r) AS n, len(h) AS m FROM pairs),
{edit_distance_cte('pairs2', 'doc_id')}
SELECT j.doc_id, (j.reference_text IS NOT NULL) AS has_reference,
       round(CASE WHEN j.reference_text IS NULL OR j.reference_text = '' THEN -1.0
                  WHEN p.n = 0 THEN -1.0 ELSE d.edits / p.n END, 6) AS wer
FROM j LEFT JOIN pairs2 p USING (doc_id) LEFT JOIN dist d USING (doc_id)""")
def wer_policy(spark, sf_dir):
    from transcript_quality.operators.transcripts import add_wer, attach_reference
    docs = spread(table(spark, sf_dir, "documents"))
    files = docs.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".wav")).alias("filename"),
                        F.col("text").alias("transcript"))
    bench = table(spark, sf_dir, "benchmark")
    lookup = bench.select(F.concat(F.col("item_id").cast("string"), F.lit(".wav")).alias("filename"),
                          F.col("text").alias("reference_text"))
    j = attach_reference(files, lookup)
    out = add_wer(j, "reference_text", "transcript", missing=-1.0, failed=-1.0)
    return out.select("doc_id", F.col("reference_text").isNotNull().alias("has_reference"), rd("wer").alias("wer"))


# ------------------------------------------------------------------ confidence
def _confidences(emb: DataFrame) -> DataFrame:
    conf = F.transform(F.col("embedding").cast("array<double>"), lambda x, i: F.when(
        i % 3 == 2, F.lit(None).cast("double")).when(x < -0.3, F.lit(float("nan"))).otherwise((x + 1) / 2))
    return emb.select("vec_id", "label", conf.alias("word_confidence"), "embedding")


CONF_SQL = """list_transform(embedding, lambda x, i: CASE WHEN i % 3 = 0 THEN NULL
  WHEN CAST(x AS DOUBLE) < -0.3 THEN CAST('NaN' AS DOUBLE) ELSE (CAST(x AS DOUBLE) + 1) / 2 END)"""


@register("confidence_mean", f"""
SELECT vec_id, round(coalesce(list_avg(list_filter({CONF_SQL}, lambda c: c IS NOT NULL AND NOT isnan(c))), 0.5), 6)
       AS asr_confidence
FROM embeddings""")
def confidence_mean(spark, sf_dir):
    c = _confidences(table(spark, sf_dir, "embeddings"))
    return c.select("vec_id", rd(mean_confidence("word_confidence")).alias("asr_confidence"))


@register("confidence_fallback", """
WITH c AS (
  SELECT vec_id,
    list_avg(list_filter(list_transform(list_filter(embedding, lambda x, i: i % 2 = 1), lambda x: CASE WHEN x > 0.25 THEN CAST(x AS DOUBLE) ELSE CAST('NaN' AS DOUBLE) END),
                         lambda v: v IS NOT NULL AND NOT isnan(v))) AS w,
    list_avg(list_filter(list_transform(list_filter(embedding, lambda x, i: i % 2 = 0), lambda x: CASE WHEN x > 0.25 THEN CAST(x AS DOUBLE) END),
                         lambda v: v IS NOT NULL AND NOT isnan(v))) AS t,
    CASE WHEN label > 2 THEN label / 10.0 END AS s
  FROM embeddings)
SELECT vec_id, round(coalesce(w, t, s, 0.5), 6) AS asr_confidence,
       CASE WHEN w IS NOT NULL THEN 'word' WHEN t IS NOT NULL THEN 'token' WHEN s IS NOT NULL THEN 'score'
            ELSE 'default' END AS source
FROM c""")
def confidence_fallback(spark, sf_dir):
    from transcript_quality.functions.confidence import confidence_chain
    emb = table(spark, sf_dir, "embeddings")
    e = F.col("embedding").cast("array<double>")
    # all items: every other one is a word's confidence, the rest are token confidences
    word = F.transform(F.filter(e, lambda x, i: i % 2 == 0), lambda x: F.when(x > 0.25, x).otherwise(F.lit(float("nan"))))
    token = F.transform(F.filter(e, lambda x, i: i % 2 == 1), lambda x: F.when(x > 0.25, x))
    score = F.when(F.col("label") > 2, F.col("label") / 10.0)
    src = (F.when(valid_mean(word).isNotNull(), "word").when(valid_mean(token).isNotNull(), "token")
           .when(score.isNotNull(), "score").otherwise("default"))
    return emb.select("vec_id", rd(confidence_chain(word, token, score)).alias("asr_confidence"), src.alias("source"))


# ------------------------------------------------------------------ paths and lookups
@register("filename_clean", """
WITH p AS (SELECT page_id, replace('file:' || url, 'file:', '') AS clean_path FROM pages)
SELECT page_id, clean_path, string_split(clean_path, '/')[-1] AS filename,
       translate(string_split(clean_path, '/')[-1], ':', '-') AS safe_name,
       translate(clean_path, ':', '-') AS safe_path
FROM p""")
def filename_clean(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    p = pages.select("page_id", strip_file_scheme(F.concat(F.lit("file:"), F.col("url"))).alias("clean_path"))
    return p.select("page_id", "clean_path", base_filename("clean_path").alias("filename"),
                    sanitize_filename(base_filename("clean_path")).alias("safe_name"),
                    sanitize_filename("clean_path").alias("safe_path"))


@register("lookup_join", f"""
WITH p AS (SELECT page_id, regexp_replace(string_split(url, '/')[-1], '[?#].*$', '') AS filename FROM pages),
l AS (SELECT CAST(doc_id AS VARCHAR) AS filename, text AS reference_text FROM documents)
SELECT p.page_id, p.filename, (l.reference_text IS NOT NULL) AS has_reference,
       CASE WHEN l.reference_text IS NULL THEN NULL ELSE CAST(len({tokens_sql('l.reference_text')}) AS BIGINT) END AS ref_words
FROM p LEFT JOIN l USING (filename)""")
def lookup_join(spark, sf_dir):
    from transcript_quality.operators.transcripts import attach_reference
    pages = table(spark, sf_dir, "pages")
    p = pages.select("page_id", F.regexp_replace(base_filename("url"), r"[?#].*$", "").alias("filename"))
    docs = table(spark, sf_dir, "documents")
    lookup = docs.select(F.col("doc_id").cast("string").alias("filename"), F.col("text").alias("reference_text"))
    j = attach_reference(p, lookup)
    return j.select("page_id", "filename", F.col("reference_text").isNotNull().alias("has_reference"),
                    F.when(F.col("reference_text").isNotNull(), F.size(tokenize_words("reference_text")))
                    .cast("long").alias("ref_words"))


# ------------------------------------------------------------------ manifest
def _manifest(docs: DataFrame) -> DataFrame:
    aid = F.concat(F.lit("a"), F.lpad(F.col("doc_id").cast("string"), 7, "0"))
    return docs.select(aid.alias("audio_id"),
                       F.concat(F.lit("/corpus/audio/"), aid, F.lit(".wav")).alias("audio_path"),
                       F.col("text").alias("reference_text"), F.col("source").alias("speaker_id"),
                       F.col("lang").alias("gender"), "n_chars", "doc_id")


MANIFEST_SQL = """
m AS (SELECT 'a' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS audio_id,
             '/corpus/audio/a' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || '.wav' AS audio_path,
             text AS reference_text, source AS speaker_id, lang AS gender, n_chars, doc_id FROM documents)"""


@register("manifest_merge", f"""
WITH {MANIFEST_SQL},
existing AS (SELECT * FROM m WHERE doc_id IN (SELECT doc_id FROM labels)),
fresh AS (SELECT * FROM m WHERE audio_id NOT IN (SELECT audio_id FROM existing)),
u AS (SELECT *, 0 AS is_new FROM existing UNION ALL SELECT *, 1 AS is_new FROM fresh)
SELECT audio_id, audio_path, speaker_id, gender, n_chars FROM u ORDER BY is_new, audio_id LIMIT 600""")
def manifest_merge(spark, sf_dir):
    m = _manifest(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    existing = m.join(labels.select("doc_id"), "doc_id", "left_semi")
    merged = MF.merge_manifest(existing, m, key="audio_id", max_samples=600)
    return merged.select("audio_id", "audio_path", "speaker_id", "gender", "n_chars")


@register("existing_audio", f"""
WITH {MANIFEST_SQL},
files AS (SELECT 'file:/landing/a' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || '.wav' AS path FROM labels)
SELECT audio_id, audio_path FROM m
WHERE string_split(audio_path, '/')[-1] IN (SELECT string_split(replace(path, 'file:', ''), '/')[-1] FROM files)""")
def existing_audio(spark, sf_dir):
    m = _manifest(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    files = labels.select(F.concat(F.lit("file:/landing/a"), F.lpad(F.col("doc_id").cast("string"), 7, "0"),
                                   F.lit(".wav")).alias("path"))
    return MF.existing_audio(m, files).select("audio_id", "audio_path")


@register("sample_exact", """
SELECT doc_id, source, lang FROM documents
ORDER BY md5('42' || '|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 51""")
def sample_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return MF.sample_exact(docs, "doc_id", 51, seed=42).select("doc_id", "source", "lang")


@register("reference_lookup", f"""
WITH {MANIFEST_SQL}
SELECT translate(string_split(replace(audio_path, 'file:', ''), '/')[-1], ':', '-') AS filename,
       CAST(len(reference_text) AS BIGINT) AS ref_chars
FROM m WHERE doc_id IN (SELECT doc_id FROM labels) AND reference_text IS NOT NULL AND reference_text <> ''""")
def reference_lookup(spark, sf_dir):
    m = _manifest(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    sampled = m.join(labels.select("doc_id"), "doc_id", "left_semi")
    lk = MF.reference_lookup(sampled)
    return lk.select("filename", F.length("reference_text").cast("long").alias("ref_chars"))


# ------------------------------------------------------------------ training table
@register("prepare_rows", f"""
WITH {FEATURE_VIEW_SQL}
SELECT path, round(rms_db, 6) AS rms_db, round(snr_db, 6) AS snr_db, round(duration, 6) AS duration,
       round(asr_confidence, 6) AS asr_confidence, round(wer, 6) AS wer FROM prepared""")
def prepare_rows(spark, sf_dir):
    p = prepared_view(spark, sf_dir)
    return p.select("path", *[rd(c).alias(c) for c in (*FEATURES, "wer")])


@register("hash_split", f"""
WITH {FEATURE_VIEW_SQL}
SELECT path, CASE WHEN CAST(('0x' || substr(md5('42|' || path), 1, 8)) AS BIGINT) % 10000 < 2000
                  THEN 'test' ELSE 'train' END AS split
FROM feat""")
def hash_split(spark, sf_dir):
    return PR.hash_split(feature_view(spark, sf_dir), "path", 0.2, 42).select("path", "split")


# ------------------------------------------------------------------ statistics
@register("duration_stats", f"""
WITH {FEATURE_VIEW_SQL}
SELECT CAST(count(duration) AS BIGINT) AS n_files, round(avg(duration), 6) AS mean_sec, round(max(duration), 6) AS max_sec,
       round(sum(duration), 6) AS total_sec, round(sum(duration) / 60.0, 6) AS total_min FROM feat""")
def duration_stats(spark, sf_dir):
    s = ST.duration_stats(feature_view(spark, sf_dir))
    return s.select("n_files", *[rd(c).alias(c) for c in ("mean_sec", "max_sec", "total_sec", "total_min")])


@register("wer_stats", f"""
WITH {FEATURE_VIEW_SQL}
SELECT round(avg(wer), 6) AS mean_wer, round(quantile_cont(wer, 0.5), 6) AS median_wer,
       round(min(wer), 6) AS min_wer, round(max(wer), 6) AS max_wer FROM feat""")
def wer_stats(spark, sf_dir):
    s = ST.wer_stats(feature_view(spark, sf_dir))
    return s.select(*[rd(c).alias(c) for c in ("mean_wer", "median_wer", "min_wer", "max_wer")])


@register("confidence_stats", f"""
WITH {FEATURE_VIEW_SQL}
SELECT round(avg(asr_confidence), 6) AS mean_conf, round(quantile_cont(asr_confidence, 0.5), 6) AS median_conf,
       round(min(asr_confidence), 6) AS min_conf, round(max(asr_confidence), 6) AS max_conf,
       CAST(count(asr_confidence) AS BIGINT) AS n_with_conf, CAST(count(*) AS BIGINT) AS n_rows,
       round(count(asr_confidence) / count(*), 6) AS coverage FROM feat""")
def confidence_stats(spark, sf_dir):
    s = ST.confidence_stats(feature_view(spark, sf_dir))
    return s.select(*[rd(c).alias(c) for c in ("mean_conf", "median_conf", "min_conf", "max_conf")],
                    "n_with_conf", "n_rows", rd("coverage").alias("coverage"))


def _unpivot_sql(cols, exprs) -> str:
    parts = []
    for c in cols:
        parts.append("SELECT '{c}' AS feature, ".format(c=c) + ", ".join(e.format(c=c) for e in exprs) + " FROM prepared")
    return " UNION ALL ".join(parts)


@register("feature_stats", f"""
WITH {FEATURE_VIEW_SQL}
""" + _unpivot_sql(FEATURES, ["round(avg({c}), 6) AS mean", "round(stddev_pop({c}), 6) AS std",
                              "round(min({c}), 6) AS min", "round(max({c}), 6) AS max"]))
def feature_stats(spark, sf_dir):
    s = ST.feature_stats(prepared_view(spark, sf_dir), FEATURES)
    return s.select("feature", *[rd(c).alias(c) for c in ("mean", "std", "min", "max")])


@register("feature_target_corr", f"""
WITH {FEATURE_VIEW_SQL}
""" + _unpivot_sql(FEATURES, [
    "round(CASE WHEN stddev_pop({c}) = 0 OR stddev_pop(wer) = 0 THEN CAST('NaN' AS DOUBLE) "
    "ELSE covar_pop({c}, wer) / (stddev_pop({c}) * stddev_pop(wer)) END, 6) AS corr"]))
def feature_target_corr(spark, sf_dir):
    s = ST.feature_target_corr(prepared_view(spark, sf_dir), FEATURES, "wer")
    return s.select("feature", rd("corr").alias("corr"))


@register("prediction_stats", f"""
WITH {FEATURE_VIEW_SQL},
pr AS (SELECT wer AS actual, {CANDIDATE_SQL} AS predicted FROM prepared)
SELECT 'actual' AS series, round(avg(actual), 6) AS mean, round(stddev_pop(actual), 6) AS std,
       round(min(actual), 6) AS min, round(max(actual), 6) AS max FROM pr
UNION ALL
SELECT 'predicted', round(avg(predicted), 6), round(stddev_pop(predicted), 6), round(min(predicted), 6),
       round(max(predicted), 6) FROM pr""")
def prediction_stats(spark, sf_dir):
    s = ST.prediction_stats(candidate_prediction(prepared_view(spark, sf_dir)), "wer", "prediction")
    return s.select("series", *[rd(c).alias(c) for c in ("mean", "std", "min", "max")])


@register("error_stats", f"""
WITH {FEATURE_VIEW_SQL},
pr AS (SELECT wer AS actual, {CANDIDATE_SQL} AS predicted FROM prepared)
SELECT round(avg(abs(actual - predicted)), 6) AS mae, round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) AS rmse,
       CAST(count(*) AS BIGINT) AS n FROM pr""")
def error_stats(spark, sf_dir):
    s = ST.error_stats(candidate_prediction(prepared_view(spark, sf_dir)), "wer", "prediction")
    return s.select(rd("mae").alias("mae"), rd("rmse").alias("rmse"), "n")


def _avg_rank_corr_sql(src: str, x: str, y: str) -> str:
    return f"""(
  SELECT corr(rx, ry) AS rho, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0 AS rx,
           rank() OVER (ORDER BY {y}) + (count(*) OVER (PARTITION BY {y}) - 1) / 2.0 AS ry
    FROM {src}))"""


@register("spearman", f"""
SELECT round(rho, 6) AS rho, n FROM {_avg_rank_corr_sql('lineitem', 'l_quantity', 'l_extendedprice')}""")
def spearman(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rho, n = ST.spearman_rho(li, "l_quantity", "l_extendedprice")
    return spark.createDataFrame([(rho, n)], "rho double, n long").select(rd("rho").alias("rho"), "n")


# ------------------------------------------------------------------ scored traffic
def scored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", "event_type", (F.col("value") / 100.0).alias("predicted_wer"),
                     (F.col("value") / 5.0 - 10.0).alias("snr_db"),
                     F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))


@register("review_flags", """
SELECT event_id, round(value / 100.0, 6) AS predicted_wer,
       coalesce(value / 100.0 > 0.4 AND NOT isnan(value / 100.0), false) AS review_recommended,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status
FROM events""")
def review_flags(spark, sf_dir):
    s = MON.flag_for_review(scored_view(spark, sf_dir), 0.4)
    return s.select("event_id", rd("predicted_wer").alias("predicted_wer"), "review_recommended", "status")


def _hist_sql(expr: str, bounds) -> str:
    sel = " UNION ALL ".join(
        f"SELECT CAST('{b}' AS DOUBLE) AS le, CAST(count(*) FILTER (WHERE {expr} <= CAST('{b}' AS DOUBLE)) AS BIGINT) AS count FROM events"
        for b in bounds)
    return sel


@register("histogram_wer", _hist_sql("value / 100.0", STANDIN_MONITOR.wer_buckets))
def histogram_wer(spark, sf_dir):
    return MON.cumulative_histogram(scored_view(spark, sf_dir), "predicted_wer", STANDIN_MONITOR.wer_buckets)


@register("histogram_snr", _hist_sql("(value / 5.0 - 10.0)", STANDIN_MONITOR.snr_buckets))
def histogram_snr(spark, sf_dir):
    return MON.cumulative_histogram(scored_view(spark, sf_dir), "snr_db", STANDIN_MONITOR.snr_buckets)


@register("low_quality_count", """
SELECT CAST(count(value) AS BIGINT) AS n_observed, round(sum(value / 100.0), 6) AS sum_observed,
       CAST(count(*) FILTER (WHERE value / 100.0 > 0.4 AND NOT isnan(value / 100.0)) AS BIGINT) AS n_flagged
FROM events""")
def low_quality_count(spark, sf_dir):
    s = MON.histogram_summary(scored_view(spark, sf_dir), "predicted_wer", 0.4)
    return s.select("n_observed", rd("sum_observed").alias("sum_observed"), "n_flagged")


def _step_sql(measures: str, group: str = "") -> str:
    """Dense per-hour step counts as SQL (k = hour index since the epoch)."""
    g = f"{group}, " if group else ""
    gb = f"PARTITION BY {group} " if group else ""
    return f"""
ev AS (SELECT *, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS k FROM events),
cnt AS (SELECT {g}k, {measures} FROM ev GROUP BY ALL),
bnd AS (SELECT {g}min(k) AS k0, max(k) AS k1 FROM cnt GROUP BY ALL),
grid AS (SELECT {g}unnest(range(k0, k1 + 1)) AS k FROM bnd),
dense AS (SELECT grid.*, {', '.join(f'coalesce(cnt.{m.split(' AS ')[-1].strip()}, 0) AS {m.split(' AS ')[-1].strip()}' for m in measures.split(','))}
          FROM grid LEFT JOIN cnt USING ({g}k))"""


@register("rate_windows", f"""
WITH {_step_sql('count(*) AS n', 'event_type')}
""" + "\nUNION ALL\n".join(f"""SELECT d.event_type, (d.k + 1) * 3600 AS step_end, CAST({wh * 3600} AS BIGINT) AS window_sec,
       CAST(sum(d2.n) AS BIGINT) AS n_in_window, round(sum(d2.n) / {wh * 3600.0}, 6) AS rate
FROM dense d JOIN dense d2 ON d2.event_type = d.event_type AND d2.k BETWEEN d.k - {wh - 1} AND d.k
GROUP BY d.event_type, d.k""" for wh in (1, 5, 10)))
def rate_windows(spark, sf_dir):
    r = MON.rate_series(table(spark, sf_dir, "events"), "ts", ["1 hour", "5 hours", "10 hours"], "1 hour",
                        group_cols=("event_type",))
    return r.select("event_type", "step_end", "window_sec", "n_in_window", rd("rate").alias("rate"))


@register("increase_windows", f"""
WITH {_step_sql("count(*) FILTER (WHERE value / 100.0 > 0.4) AS n")}
SELECT (d.k + 1) * 3600 AS step_end, CAST(sum(d2.n) AS BIGINT) AS increase,
       CASE WHEN sum(d2.n) >= 10 THEN 'red' WHEN sum(d2.n) >= 1 THEN 'orange' ELSE 'green' END AS level
FROM dense d JOIN dense d2 ON d2.k BETWEEN d.k - 14 AND d.k GROUP BY d.k""")
def increase_windows(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    return MON.increase_series(s, "ts", STANDIN_MONITOR.flagged_window, STANDIN_MONITOR.step,
                               MON._not_nan_gt(F.col("predicted_wer"), 0.4), STANDIN_MONITOR.flagged_levels)


def _p95_sql(bounds, window_sec: int = 3600, histogram: bool = False) -> str:
    bs = [float(b) for b in bounds]
    cols = ", ".join(f"count(*) FILTER (WHERE value / 100.0 <= CAST('{b}' AS DOUBLE)) AS c{i}" for i, b in enumerate(bs))
    k = len(bs)
    # first bucket (among the first k-1) whose cumulative count reaches the rank
    pick = "CASE " + " ".join(f"WHEN c{i} >= rnk THEN {i}" for i in range(k - 1)) + f" ELSE {k - 1} END"
    ub = "[" + ", ".join(f"CAST('{b}' AS DOUBLE)" for b in bs) + "]"
    cs = "[" + ", ".join(f"c{i}" for i in range(k)) + "]"
    return f"""
WITH w AS (SELECT CAST(floor(epoch(ts) / {window_sec}) * {window_sec} AS BIGINT) AS window_start, CAST(count(*) AS BIGINT) AS n,
                  sum(value / 100.0) AS total, {cols}
           FROM events GROUP BY 1),
r AS (SELECT *, 0.95 * c{k - 1} AS rnk FROM w),
b AS (SELECT *, {pick} AS bi, {ub} AS ub, {cs} AS cs FROM r),
q AS (SELECT window_start, n, total, {', '.join(f'CAST(c{i} AS BIGINT) AS b{i}' for i in range(k))},
        CASE WHEN cs[{k}] <= 0 THEN CAST('NaN' AS DOUBLE)
             WHEN bi = {k - 1} THEN {bs[-2]}
             WHEN bi = 0 AND ub[1] <= 0 THEN ub[1]
             ELSE (CASE WHEN bi > 0 THEN ub[bi] ELSE 0.0 END)
                  + (ub[bi + 1] - CASE WHEN bi > 0 THEN ub[bi] ELSE 0.0 END)
                  * ((rnk - CASE WHEN bi > 0 THEN cs[bi] ELSE 0 END) / (cs[bi + 1] - CASE WHEN bi > 0 THEN cs[bi] ELSE 0 END))
        END AS p95 FROM b)
SELECT window_start, n, """ + (
        "round(total, 6) AS sum, " + ", ".join(f"b{i}" for i in range(k)) + ", round(p95, 6) AS p95 FROM q"
        if histogram else
        f"""round(n / {float(window_sec)}, 6) AS per_second, round(p95, 6) AS p95,
       CASE WHEN p95 >= 0.5 THEN 'red' WHEN p95 >= 0.3 THEN 'orange' ELSE 'green' END AS p95_level
FROM q""")


@register("p95_from_buckets", _p95_sql(STANDIN_MONITOR.wer_buckets))
def p95_from_buckets(spark, sf_dir):
    q = MON.windowed_quantile(scored_view(spark, sf_dir), "ts", "predicted_wer", "1 hour", 0.95,
                              STANDIN_MONITOR.wer_buckets, STANDIN_MONITOR)
    return q.select("window_start", "n", rd("per_second").alias("per_second"), rd("p95").alias("p95"), "p95_level")


def _alert_sql(value_expr: str, threshold: float, window_steps: int, hold_steps: int, measures: str) -> str:
    return f"""
WITH {_step_sql(measures)},
roll AS (SELECT d.k, {', '.join(f'sum(d2.{m.split(' AS ')[-1].strip()}) AS {m.split(' AS ')[-1].strip()}_w' for m in measures.split(','))}
         FROM dense d JOIN dense d2 ON d2.k BETWEEN d.k - {window_steps - 1} AND d.k GROUP BY d.k),
v AS (SELECT k, {value_expr} AS value FROM roll),
c AS (SELECT k, value, coalesce(value > {threshold!r} AND NOT isnan(value), false) AS cond FROM v),
s AS (SELECT *, coalesce(max(CASE WHEN NOT cond THEN k END) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1,
                         min(k) OVER ()) AS run_start FROM c)
SELECT (k + 1) * 3600 AS step_end, round(value, 6) AS value,
       CASE WHEN NOT cond THEN 'inactive' WHEN (k - run_start) >= {hold_steps} THEN 'firing' ELSE 'pending' END AS state
FROM s"""


@register("alert_error_rate", _alert_sql("n_w / 18000.0", 0.05 / 60, 5, 2,
                                         "count(*) FILTER (WHERE event_type = 'error') AS n"))
def alert_error_rate(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    a = MON.error_rate_alert(s, "ts", F.col("status").cast("string").rlike("^5..$"), STANDIN_MONITOR)
    return a.select("step_end", rd("value").alias("value"), "state")


@register("alert_drift", _alert_sql("CASE WHEN requests_w = 0 THEN NULL ELSE flagged_w / requests_w END", 0.5, 10, 10,
                                    "count(*) FILTER (WHERE value / 100.0 > 0.4) AS flagged, count(*) AS requests"))
def alert_drift(spark, sf_dir):
    s = scored_view(spark, sf_dir)
    a = MON.drift_alert(s, "ts", MON._not_nan_gt(F.col("predicted_wer"), 0.4), STANDIN_MONITOR)
    return a.select("step_end", rd("value").alias("value"), "state")


# ------------------------------------------------------------------ registry and gate
@register("model_gate", f"""
WITH {FEATURE_VIEW_SQL},
test AS (SELECT *, {CANDIDATE_SQL} AS cand, {PRODUCTION_SQL} AS prod FROM prepared
         WHERE CAST(('0x' || substr(md5('42|' || path), 1, 8)) AS BIGINT) % 10000 < 2000),
c AS {_avg_rank_corr_sql('test', 'wer', 'cand')},
p AS {_avg_rank_corr_sql('test', 'wer', 'prod')}
SELECT round((SELECT rho FROM c), 6) AS candidate, round(coalesce((SELECT rho FROM p), -1.0), 6) AS production,
       coalesce((SELECT rho FROM c) > coalesce((SELECT rho FROM p), -1.0), false) AS promote""")
def model_gate(spark, sf_dir):
    from pyspark import StorageLevel
    _, test = PR.train_test(prepared_view(spark, sf_dir), "path", 0.2, 42)
    test = test.persist(StorageLevel.MEMORY_AND_DISK)  # scanned and split once for both models
    try:
        c_rho, _ = ST.spearman_rho(candidate_prediction(test), "wer", "prediction")
        p_rho, _ = ST.spearman_rho(production_prediction(test), "wer", "prediction")
    finally:
        test.unpersist()
    cand = spark.createDataFrame([(c_rho,)], "spearman_rho double")
    prod = spark.createDataFrame([(p_rho,)], "spearman_rho double")
    g = RG.compare_models(cand, prod)
    return g.select(rd("candidate").alias("candidate"), rd("production").alias("production"), "promote")


@register("latest_version", """
SELECT event_type, arg_max(strftime(ts, 'v%Y%m%d_%H%M%S_%g'), ts) AS version, CAST(count(*) AS BIGINT) AS n_versions
FROM events GROUP BY event_type""")
def latest_version(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    reg = ev.select("event_type", RG.version_label("ts").alias("version"), F.col("ts").alias("created_at"),
                    F.lit("").alias("path"))
    latest = RG.latest_version(reg, group_cols=("event_type",))
    counts = reg.groupBy("event_type").agg(F.count(F.lit(1)).cast("long").alias("n_versions"))
    return latest.join(counts, "event_type").select("event_type", "version", "n_versions")


# ------------------------------------------------------------------ models (rows-only checks)
FULL_GBT = TrainingConfig()


@register("gbt_metrics")
def gbt_metrics(spark, sf_dir):
    from transcript_quality.operators import model as ML
    train, test = PR.train_test(prepared_view(spark, sf_dir), "path", 0.2, 42)
    m = ML.fit(train, FULL_GBT)
    met = ML.metrics(ML.predict(m, test, FULL_GBT), FULL_GBT)
    return spark.createDataFrame([(met["spearman_rho"], met["spearman_p_value"], met["rmse"], met["num_samples"])],
                                 "spearman_rho double, spearman_p_value double, rmse double, num_samples long")


@register("importance")
def importance(spark, sf_dir):
    from transcript_quality.operators import model as ML
    train, _ = PR.train_test(prepared_view(spark, sf_dir), "path", 0.2, 42)
    return ML.feature_importance(ML.fit(train, FULL_GBT), list(FEATURES))


# ------------------------------------------------------------------ streaming (stream = batch)
@register("stream_wer_histogram", _p95_sql(STANDIN_MONITOR.wer_buckets, 86400, histogram=True))
def stream_wer_histogram(spark, sf_dir):
    """STM-3/4/10 on a real stream: events are read with ``readStream``, deduplicated by id within
    the watermark, aggregated per event-time day in update mode, and each micro-batch's updated
    windows are written to its own folder in the shared checkpoint location; the table is the
    latest row per window."""
    import uuid

    from transcript_quality.session import shared_dir
    from transcript_quality.streaming import monitor as SM
    # all files of the table in one micro-batch: file by file, the watermark of the first would drop earlier events of the next
    ev = stream_table(spark, sf_dir, "events")
    scored = ev.select("event_id", "ts", (F.col("value") / 100.0).alias("predicted_wer"))
    hist = SM.windowed_histogram_stream(scored, "ts", "predicted_wer", "1 day", STANDIN_MONITOR.wer_buckets,
                                        watermark="2 days", dedupe_key="event_id")
    run = shared_dir(spark, "streams", f"wer_histogram_{uuid.uuid4().hex}")
    SM.run_to_table(hist, f"{run}/out", f"{run}/checkpoint")
    out = SM.latest_per_key(spark, f"{run}/out", ["window_start"])
    bounds = list(STANDIN_MONITOR.wer_buckets)
    return SM.with_quantile(out, bounds, 0.95).select(
        "window_start", "n", rd("sum").alias("sum"), *[f"b{i}" for i in range(len(bounds))], rd("p95").alias("p95"))


@register("throughput", f"""
WITH {_step_sql('count(*) AS n')}
SELECT (k + 1) * 3600 AS step_end, CAST(n AS BIGINT) AS requests, round(n / 3600.0, 6) AS per_second FROM dense""")
def throughput(spark, sf_dir):
    """STM-5: requests per second per evaluation step (all traffic)."""
    r = MON.rate_series(table(spark, sf_dir, "events"), "ts", ["1 hour"], "1 hour")
    return r.select("step_end", F.col("n_in_window").alias("requests"), rd("rate").alias("per_second"))


@register("status_levels", f"""
WITH {_step_sql("count(*) FILTER (WHERE value / 100.0 > 0.4) AS n")},
inc AS (SELECT d.k, CAST(sum(d2.n) AS BIGINT) AS flagged FROM dense d JOIN dense d2 ON d2.k BETWEEN d.k - 14 AND d.k GROUP BY d.k),
p AS ({_p95_sql(STANDIN_MONITOR.wer_buckets).strip()})
SELECT (inc.k + 1) * 3600 AS step_end, inc.flagged,
       CASE WHEN inc.flagged >= 10 THEN 'red' WHEN inc.flagged >= 1 THEN 'orange' ELSE 'green' END AS flagged_level,
       p.p95, coalesce(p.p95_level, 'green') AS p95_level
FROM inc LEFT JOIN p ON p.window_start = inc.k * 3600""")
def status_levels(spark, sf_dir):
    """STM-6/7: the two stat-panel levels per evaluation step."""
    s = scored_view(spark, sf_dir)
    inc = MON.increase_series(s, "ts", STANDIN_MONITOR.flagged_window, STANDIN_MONITOR.step,
                              MON._not_nan_gt(F.col("predicted_wer"), 0.4), STANDIN_MONITOR.flagged_levels)
    p95 = MON.windowed_quantile(s, "ts", "predicted_wer", "1 hour", 0.95, STANDIN_MONITOR.wer_buckets, STANDIN_MONITOR)
    j = inc.join(p95.select((F.col("window_start") + 3600).alias("step_end"), "p95", "p95_level"), "step_end", "left")
    return j.select("step_end", F.col("increase").alias("flagged"), F.col("level").alias("flagged_level"),
                    rd("p95").alias("p95"), F.coalesce("p95_level", F.lit("green")).alias("p95_level"))


@register("stream_acoustic_features", f"""
WITH {ACOUSTIC_SQL}
SELECT vec_id, label, n_samples, round(duration, 6) AS duration, round(rms_db, 6) AS rms_db,
       round(snr_db, 6) AS snr_db FROM ac""")
def stream_acoustic_features(spark, sf_dir):
    """STM-1 on the stand-in: waveforms read with ``readStream``, featurised by the same
    stateless expressions, each micro-batch written to its own folder, read back as a table."""
    import uuid

    from transcript_quality.session import shared_dir
    from transcript_quality.sinks.writers import write_stream
    src = stream_table(spark, sf_dir, "embeddings", maxFilesPerTrigger=1)
    feats = array_acoustic_features(src, "embedding", STANDIN_SR, STANDIN_ACOUSTIC, keep=("vec_id", "label"))
    run = shared_dir(spark, "streams", f"acoustic_{uuid.uuid4().hex}")
    write_stream(feats, f"{run}/out", f"{run}/checkpoint")
    out = spark.read.schema(feats.schema).option("recursiveFileLookup", True).parquet(f"{run}/out")
    return out.select("vec_id", "label", "n_samples", rd("duration").alias("duration"),
                      rd("rms_db").alias("rms_db"), rd("snr_db").alias("snr_db"))


# ------------------------------------------------------------------ composed jobs after the decode
def _standin_path(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(".wav"))


def _word_confidences(words: Column, min_len: int = 0, invalid=None) -> Column:
    """Stand-in model output: a word's confidence 1 - 1 / (1 + length) grows with its length; words of ``min_len`` letters or
    fewer get ``invalid`` (NULL or NaN)."""
    bad = F.lit(invalid).cast("double")
    return F.transform(words, lambda w: F.when(F.length(w) > min_len, 1.0 - 1.0 / (1.0 + F.length(w))).otherwise(bad))


def _word_conf_sql(words: str, min_len: int = 0, invalid: str = "NULL") -> str:
    return (f"list_transform({words}, lambda w: CASE WHEN length(w) > {min_len} "
            f"THEN CAST(1 AS DOUBLE) - CAST(1 AS DOUBLE) / (1 + length(w)) ELSE CAST({invalid} AS DOUBLE) END)")


def _valid_avg_sql(lst: str) -> str:
    return f"list_avg(list_filter({lst}, lambda c: c IS NOT NULL AND NOT isnan(c)))"


def _f32(c: str) -> str:
    return f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS {c}"


@register("feature_rows", f"""
WITH RECURSIVE {ACOUSTIC_SQL},
tr AS (SELECT 'file:/landing/' || CAST(doc_id AS VARCHAR) || '.wav' AS path, text AS transcript,
              {_word_conf_sql(tokens_sql('text'))} AS wc FROM documents),
lk AS (SELECT CAST(item_id AS VARCHAR) || '.wav' AS filename, text AS reference_text FROM benchmark),
r AS (SELECT a.path, a.rms_db, a.snr_db, a.duration, tr.transcript,
             coalesce({_valid_avg_sql('tr.wc')}, 0.5) AS asr_confidence, lk.reference_text
      FROM (SELECT 'file:/landing/' || CAST(vec_id AS VARCHAR) || '.wav' AS path, * FROM ac) a
      LEFT JOIN tr USING (path)
      LEFT JOIN lk ON lk.filename = string_split(replace(a.path, 'file:', ''), '/')[-1]),
pairs AS (SELECT path, {tokens_sql('reference_text')} AS r, {tokens_sql('transcript')} AS h FROM r
          WHERE reference_text IS NOT NULL AND reference_text <> ''),
pairs2 AS (SELECT path, r, h, len(r) AS n, len(h) AS m FROM pairs),
{edit_distance_cte('pairs2', 'path')},
out AS (SELECT r.path, r.rms_db, r.snr_db, r.duration, r.asr_confidence,
               CASE WHEN r.reference_text IS NULL OR r.reference_text = '' THEN -1.0
                    WHEN p.n = 0 THEN -1.0 ELSE d.edits / p.n END AS wer
        FROM r LEFT JOIN pairs2 p USING (path) LEFT JOIN dist d USING (path))
SELECT path, {', '.join(_f32(c) for c in (*FEATURES, 'wer'))} FROM out""")
def feature_rows(spark, sf_dir):
    """JOB-1 after the decode on the stand-in: per-file acoustics (waveforms from
    ``embeddings``) ⟕ transcripts (``documents`` text, word confidences from the stand-in model)
    -> mean word confidence -> reference by filename (``benchmark``) -> WER with the ingest
    policy -> the canonical float feature-history projection."""
    from transcript_quality.operators.transcripts import to_feature_history
    from transcript_quality.plans.jobs import label_acoustics
    emb = table(spark, sf_dir, "embeddings").withColumn("path", _standin_path("file:/landing/", "vec_id"))
    ac = array_acoustic_features(emb, "embedding", STANDIN_SR, STANDIN_ACOUSTIC, keep=("path",))
    docs = spread(table(spark, sf_dir, "documents"))
    tr = docs.select(_standin_path("file:/landing/", "doc_id").alias("path"), F.col("text").alias("transcript"),
                     _word_confidences(tokenize_words("text")).alias("word_confidence"))
    bench = table(spark, sf_dir, "benchmark")
    lookup = bench.select(F.concat(F.col("item_id").cast("string"), F.lit(".wav")).alias("filename"),
                          F.col("text").alias("reference_text"))
    rows = to_feature_history(label_acoustics(ac, lookup, tr))
    return rows.select("path", *[rd(F.col(c).cast("double")).alias(c) for c in (*FEATURES, "wer")])


@register("ground_truth_rows", f"""
WITH RECURSIVE {ACOUSTIC_SQL},
{MANIFEST_SQL},
files AS (SELECT vec_id, 'file:/corpus/audio/a' || lpad(CAST(vec_id AS VARCHAR), 7, '0') || '.wav' AS path FROM embeddings),
present AS (SELECT audio_id, audio_path, reference_text FROM m
            WHERE replace(audio_path, 'file:', '') IN (SELECT replace(path, 'file:', '') FROM files)),
feats AS (SELECT replace(files.path, 'file:', '') AS audio_path, ac.rms_db, ac.snr_db, ac.duration
          FROM ac JOIN files USING (vec_id)),
hyp AS (SELECT '/corpus/audio/a' || lpad(CAST(item_id AS VARCHAR), 7, '0') || '.wav' AS audio_path,
               text AS hypothesis_text,
               {_valid_avg_sql(_word_conf_sql(tokens_sql('text'), 6, "'NaN'"))} AS wc,
               {_valid_avg_sql(_word_conf_sql(tokens_sql('text'), 3))} AS tc,
               CASE WHEN length(text) > 100 THEN 0.7 END AS sc
        FROM benchmark),
r AS (SELECT p.audio_id, p.audio_path, p.reference_text, coalesce(h.hypothesis_text, '') AS hypothesis_text,
             coalesce(h.wc, h.tc, h.sc, 0.5) AS asr_confidence, f.duration, f.rms_db, f.snr_db
      FROM present p LEFT JOIN feats f USING (audio_path) LEFT JOIN hyp h USING (audio_path)),
-- edit distance is symmetric: run the DP over the (short) hypothesis words, divide by the reference words
pairs AS (SELECT audio_id, {tokens_sql('hypothesis_text')} AS r, {tokens_sql('reference_text')} AS h FROM r
          WHERE reference_text IS NOT NULL AND reference_text <> ''),
pairs2 AS (SELECT audio_id, r, h, len(r) AS n, len(h) AS m FROM pairs),
{edit_distance_cte('pairs2', 'audio_id')}
SELECT r.audio_id, r.audio_path, r.hypothesis_text,
       round(CASE WHEN r.reference_text IS NULL OR r.reference_text = '' THEN 1.0
                  WHEN p.m = 0 THEN 1.0 ELSE d.edits / p.m END, 6) AS wer,
       round(r.asr_confidence, 6) AS asr_confidence, round(r.duration, 6) AS duration,
       round(r.rms_db, 6) AS rms_db, round(r.snr_db, 6) AS snr_db
FROM r LEFT JOIN pairs2 p USING (audio_id) LEFT JOIN dist d USING (audio_id)""")
def ground_truth_rows(spark, sf_dir):
    """JOB-2 after the decode on the stand-in: manifest (``documents``) rows whose audio landed
    (``embeddings`` as files) ⟕ acoustics ⟕ hypotheses (``benchmark`` texts with word / token /
    score confidences) -> confidence chain -> WER, failure -> 1.0."""
    from transcript_quality.plans import jobs as J
    m = _manifest(table(spark, sf_dir, "documents"))
    emb = table(spark, sf_dir, "embeddings").withColumn(
        "path", F.concat(F.lit("file:/corpus/audio/a"), F.lpad(F.col("vec_id").cast("string"), 7, "0"), F.lit(".wav")))
    present = MF.existing_audio(m, emb.select("path"), by="path")
    feats = array_acoustic_features(emb, "embedding", STANDIN_SR, STANDIN_ACOUSTIC, keep=("path",)) \
        .withColumnRenamed("path", "audio_path")
    words = tokenize_words("text")
    hyp = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("/corpus/audio/a"), F.lpad(F.col("item_id").cast("string"), 7, "0"), F.lit(".wav"))
        .alias("audio_path"),
        F.col("text").alias("hypothesis_text"),
        _word_confidences(words, 6, float("nan")).alias("word_confidence"),
        _word_confidences(words, 3).alias("token_confidence"),
        F.when(F.length("text") > 100, F.lit(0.7)).alias("score"))
    rows = J.ground_truth_rows(present, feats, hyp)
    return rows.select("audio_id", "audio_path", "hypothesis_text",
                       *[rd(c).alias(c) for c in ("wer", "asr_confidence", "duration", "rms_db", "snr_db")])


# ------------------------------------------------------------------ written and read again
def _run_dir(spark: SparkSession, name: str) -> str:
    import uuid

    from transcript_quality.session import shared_dir
    return shared_dir(spark, "queries", f"{name}_{uuid.uuid4().hex}")


@register("manifest_union", f"""
WITH {MANIFEST_SQL} SELECT audio_id, audio_path, speaker_id, gender, n_chars FROM m""")
def manifest_union(spark, sf_dir):
    """JON-4 / SET-1 without a cap: the labelled documents' manifest, then all rows not yet in it."""
    m = _manifest(table(spark, sf_dir, "documents"))
    existing = m.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return MF.merge_manifest(existing, m, key="audio_id").select("audio_id", "audio_path", "speaker_id", "gender", "n_chars")


@register("manifest_roundtrip", f"""
WITH {MANIFEST_SQL} SELECT audio_id, audio_path, md5(reference_text) AS text_md5, speaker_id, gender FROM m""")
def manifest_roundtrip(spark, sf_dir):
    """SNK-3 / SRC-4 / JOB-6: the labelled rows are written as CSV, then all rows are merged into that manifest in place;
    texts have quotes and line breaks."""
    from transcript_quality.plans.jobs import merge_manifest_job
    path = _run_dir(spark, "manifest")
    m = _manifest(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    rows = m.select("audio_id", "audio_path", "reference_text", "speaker_id", "gender")
    merge_manifest_job(spark, None, rows.join(labels.select(F.concat(F.lit("a"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias("audio_id")), "audio_id", "left_semi"), path)
    out = merge_manifest_job(spark, path, rows, path)
    return out.select("audio_id", "audio_path", F.md5("reference_text").alias("text_md5"), "speaker_id", "gender")


@register("lookup_roundtrip", f"""
WITH {MANIFEST_SQL} SELECT string_split(audio_path, '/')[-1] AS filename, md5(reference_text) AS text_md5 FROM m WHERE reference_text <> ''""")
def lookup_roundtrip(spark, sf_dir):
    """SNK-4 / SRC-2 / JSN-1: the reference lookup written as JSON objects and read back."""
    from transcript_quality.sinks.writers import write_reference_lookup
    from transcript_quality.sources.tables import read_reference_lookup
    path = _run_dir(spark, "lookup")
    write_reference_lookup(MF.reference_lookup(_manifest(table(spark, sf_dir, "documents"))), path, as_json=True)
    return read_reference_lookup(spark, path).select("filename", F.md5("reference_text").alias("text_md5"))


@register("history_rows", f"""
WITH {FEATURE_VIEW_SQL} SELECT path, {', '.join(f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 4) AS {c}" for c in (*FEATURES, 'wer'))} FROM feat""")
def history_rows(spark, sf_dir):
    """SNK-1 / SNK-7 / SRC-3 / SET-3: half of the rows are appended in batch, half by a stream to the same history."""
    from transcript_quality.schemas import FEATURE_HISTORY
    from transcript_quality.sinks import writers as W
    from transcript_quality.sources.tables import read_features
    run = _run_dir(spark, "history")
    half = F.pmod(F.crc32(F.col("path").cast("binary")), F.lit(2)) == 0
    rows = feature_view(spark, sf_dir)
    W.append_features(rows.where(half), f"{run}/history")
    late = feature_rows_of(stream_table(spark, sf_dir, "lineitem")).where(~half)
    W.write_stream(late.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_HISTORY.fields]), f"{run}/history", f"{run}/checkpoint")
    back = read_features(spark, f"{run}/history")
    return back.select("path", *[rd(F.col(c).cast("double"), 4).alias(c) for c in (*FEATURES, "wer")])


# ------------------------------------------------------------------ rank correlation with its p-value
@register("spearman_p", """
WITH v AS (SELECT list_avg(embedding) AS x, CAST(label AS DOUBLE) AS y FROM embeddings),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM v),
s AS (SELECT corr(rx, ry) AS rho, count(*) AS n FROM r),
t AS (SELECT rho, n, n - 2 AS dof, abs(rho) * sqrt((n - 2) / ((1 - rho) * (1 + rho))) AS t FROM s),
-- Simpson's rule over the density of Student's t from 0 to |t|
g AS (SELECT rho, n, t, sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                            * exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(dof * pi())
                            * pow(1 + pow(t * i / 2000, 2) / dof, -(dof + 1) / 2.0)) * t / 2000 / 3 AS half
      FROM t, range(0, 2001) q(i) GROUP BY rho, n, t)
SELECT round(rho, 6) AS rho, round(1 - 2 * half, 6) AS p_value, CAST(n AS BIGINT) AS n FROM g""")
def spearman_p(spark, sf_dir):
    """AGG-8 / AGG-9: mean item of a vector against its label."""
    emb = table(spark, sf_dir, "embeddings")
    mean = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double")) / F.size("embedding")
    out = ST.spearman(emb.select(mean.alias("x"), F.col("label").cast("double").alias("y")), "x", "y")
    return out.select(rd("rho").alias("rho"), rd("p_value").alias("p_value"), "n")


# ------------------------------------------------------------------ files as bytes
QUANT_SQL = """quant AS (SELECT vec_id, label, list_transform(embedding, lambda x: greatest(-32768, least(32767, round(CAST(x AS DOUBLE) * 32768))) / 32768.0) AS embedding FROM embeddings)"""


def _le_hex(n: Column, width: int) -> Column:
    """An integer column as little-endian bytes in hex."""
    return F.concat(*[F.lpad(F.hex(F.pmod(F.floor(n / F.lit(float(256 ** i))).cast("long"), F.lit(256))), 2, "0") for i in range(width)])


def wav_files(emb: DataFrame, sr: Column) -> DataFrame:
    """binaryFile rows (path, length, content): each vector as a 16-bit PCM file; every tenth has a broken header."""
    v = F.transform("embedding", lambda x: F.greatest(F.lit(-32768.0), F.least(F.lit(32767.0), F.round(x.cast("double") * 32768))))
    size = F.size("embedding") * 2
    tag = F.when(F.col("vec_id") % 10 == 3, F.lit("4A554E4B")).otherwise(F.lit("52494646"))
    head = F.concat(tag, _le_hex(size + 36, 4), F.lit("57415645666D74201000000001000100"), _le_hex(sr, 4), _le_hex(sr * 2, 4),
                    F.lit("0200100064617461"), _le_hex(size, 4))
    content = F.unhex(F.concat(head, F.array_join(F.transform(v, lambda x: _le_hex(F.pmod(x, F.lit(65536.0)), 2)), "")))
    return emb.select(F.concat(F.lit("file:/landing/"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("path"), content.alias("content")) \
        .withColumn("length", F.length("content").cast("long"))


def _vec_of(path: str = "path") -> Column:
    return F.regexp_extract(path, r"(\d+)\.wav$", 1).cast("long").alias("vec_id")


@register("decoded_features", f"""
WITH {QUANT_SQL}, {ACOUSTIC_SQL.replace("FROM embeddings", "FROM quant")}
SELECT vec_id, vec_id % 10 = 3 AS failed, CASE WHEN vec_id % 10 <> 3 THEN round(duration, 6) END AS duration,
       CASE WHEN vec_id % 10 <> 3 THEN round(rms_db, 5) END AS rms_db, CASE WHEN vec_id % 10 <> 3 THEN round(snr_db, 5) END AS snr_db FROM ac""")
def decoded_features(spark, sf_dir):
    """DEC-1 / PRJ-2: bytes -> decode -> acoustics; a broken file leaves its row without features."""
    from transcript_quality.operators import audio as A
    files = wav_files(table(spark, sf_dir, "embeddings"), F.lit(STANDIN_SR))
    out = A.acoustic_features(A.decode_audio(files, STANDIN_ACOUSTIC), STANDIN_ACOUSTIC)
    return out.select(_vec_of(), F.col("error").isNotNull().alias("failed"), rd("duration").alias("duration"), rd("rms_db", 5).alias("rms_db"), rd("snr_db", 5).alias("snr_db"))


@register("decoded_validity", """
WITH f AS (SELECT vec_id, 44 + 2 * len(embedding) AS length, len(embedding) / (16.0 * (1 + vec_id % 12)) AS duration, vec_id % 10 = 3 AS broken FROM embeddings)
SELECT vec_id, round(length / 1024.0, 6) AS size_kb, CASE WHEN NOT broken THEN round(duration, 6) END AS duration, NOT broken AND duration >= 0.5 AS is_valid,
       CASE WHEN broken THEN 'invalid_header' WHEN duration < 0.5 THEN 'too_short' END AS reason FROM f""")
def decoded_validity(spark, sf_dir):
    """FLT-2 from the headers of files of several rates."""
    from transcript_quality.config import ValidityConfig
    from transcript_quality.operators import audio as A
    files = wav_files(table(spark, sf_dir, "embeddings"), F.lit(STANDIN_SR) * (1 + F.col("vec_id") % 12))
    out = A.validate_audio(files, ValidityConfig(min_size_kb=0.1))
    return out.select(_vec_of(), rd("size_kb").alias("size_kb"), rd("duration").alias("duration"), "is_valid", "reason")


# ------------------------------------------------------------------ scoring
SCORE_TREE = TrainingConfig(gbt=GBTConfig(n_estimators=1, max_depth=3, max_bins=64))


@register("score_rows", f"""
WITH {FEATURE_VIEW_SQL},
s AS (SELECT path, snr_db, CASE WHEN snr_db IS NOT NULL AND NOT isnan(snr_db) AND asr_confidence IS NOT NULL THEN 200 ELSE 500 END AS status,
             CASE WHEN rms_db > -10 THEN 0.2 WHEN rms_db > -30 THEN 0.35 ELSE 0.6 END AS p FROM feat)
SELECT path, CAST(status AS INTEGER) AS status, CASE WHEN status = 200 THEN CAST(p AS DOUBLE) END AS predicted_wer, status = 200 AND p > 0.4 AS review_recommended FROM s""")
def score_rows(spark, sf_dir):
    """ML-6 / JOB-8: SCORED rows for every file, failed ones with status 500.  The model is a tree fitted to a target with three values, so
    its predictions are those values."""
    from transcript_quality.operators import model as ML
    target = F.when(F.col("rms_db") > -10, 0.2).when(F.col("rms_db") > -30, 0.35).otherwise(0.6)
    model = ML.fit(prepared_view(spark, sf_dir).withColumn("wer", target), SCORE_TREE)
    out = ML.scored_rows(ML.score(model, feature_view(spark, sf_dir), SCORE_TREE))
    return out.select("path", "status", rd("predicted_wer").alias("predicted_wer"), "review_recommended")


# ------------------------------------------------------------------ diagnostics
def _diag_sql(col: str, name: str, section: str) -> str:
    return (f"SELECT '{section}' AS section, '{name}' AS name, unnest(['mean', 'std', 'min', 'max']) AS metric, "
            f"unnest([avg({col}), stddev_pop({col}), min({col}), max({col})]) AS value FROM s")


@register("diagnostics", f"""
WITH {FEATURE_VIEW_SQL},
s AS (SELECT * EXCLUDE (wer), CASE WHEN rms_db > -10 THEN 0.2 WHEN rms_db > -30 THEN 0.35 ELSE 0.6 END + CASE WHEN duration > 5 THEN 0.1 ELSE 0 END AS wer,
             CASE WHEN rms_db > -10 THEN 0.2 WHEN rms_db > -30 THEN 0.35 ELSE 0.6 END AS prediction FROM prepared),
r AS ({' UNION ALL '.join(_diag_sql(c, c, 'feature_stats') for c in FEATURES)}
      UNION ALL {' UNION ALL '.join(f"SELECT 'feature_target_corr', '{c}', 'corr', corr({c}, wer) FROM s" for c in FEATURES)}
      UNION ALL {_diag_sql('wer', 'actual', 'prediction_stats')} UNION ALL {_diag_sql('prediction', 'predicted', 'prediction_stats')}
      UNION ALL SELECT 'error_stats', 'error', 'mae', avg(abs(wer - prediction)) FROM s
      UNION ALL SELECT 'error_stats', 'error', 'rmse', sqrt(avg((wer - prediction) * (wer - prediction))) FROM s)
SELECT section, name, metric, round(CAST(value AS DOUBLE), 6) AS value FROM r""")
def diagnostics(spark, sf_dir):
    """ML-7: the statistics of a model's predictions (its importances are the ``importance`` query).  The model is fitted to a target
    with three values and judged against one that differs for long files."""
    from transcript_quality.operators import model as ML
    level = F.when(F.col("rms_db") > -10, 0.2).when(F.col("rms_db") > -30, 0.35).otherwise(0.6)
    rows = prepared_view(spark, sf_dir)
    model = ML.fit(rows.withColumn("wer", level), SCORE_TREE)
    out = ML.diagnostics(model, rows.withColumn("wer", level + F.when(F.col("duration") > 5, 0.1).otherwise(0.0)), SCORE_TREE)
    return out.where("section <> 'importance'").select("section", "name", "metric", rd("value").alias("value"))


# ------------------------------------------------------------------ sliding stream with late and repeated rows
@register("stream_snr_histogram", f"""
WITH e AS (SELECT epoch(ts) AS s, value / 5.0 - 10 AS v FROM events),
w AS (SELECT CAST((floor(s / 86400) - o) * 86400 AS BIGINT) AS window_start, v FROM e, range(0, 2) r(o))
SELECT window_start, CAST(count(*) AS BIGINT) AS n, round(sum(v), 4) AS sum,
       {', '.join(f"CAST(count(*) FILTER (WHERE v <= {b if b != float('inf') else "CAST('inf' AS DOUBLE)"}) AS BIGINT) AS b{i}" for i, b in enumerate(STANDIN_MONITOR.snr_buckets))}
FROM w GROUP BY window_start""")
def stream_snr_histogram(spark, sf_dir):
    """STM-3 / STM-10: SNR histogram over sliding windows of two days.  The events are landed twice and read in two micro-batches: of
    the second, rows older than the watermark are late and the others repeat an id, so both are left out."""
    from transcript_quality.streaming import monitor as SM
    run = _run_dir(spark, "snr_histogram")
    ev = table(spark, sf_dir, "events")
    for _ in range(2):
        ev.write.mode("append").parquet(f"{run}/landing")
        stream = spark.readStream.schema(ev.schema).parquet(f"{run}/landing")
        scored = stream.select("event_id", "ts", (F.col("value") / 5.0 - 10).alias("snr_db"))
        hist = SM.windowed_histogram_stream(scored, "ts", "snr_db", "2 days", STANDIN_MONITOR.snr_buckets, watermark="3 days",
                                            dedupe_key="event_id", slide="1 day")
        SM.run_to_table(hist, f"{run}/out", f"{run}/checkpoint")  # all files of a landing are one micro-batch
    out = SM.latest_per_key(spark, f"{run}/out", ["window_start"])
    return out.select("window_start", "n", rd("sum", 4).alias("sum"), *[f"b{i}" for i in range(len(STANDIN_MONITOR.snr_buckets))])


def _alert_stream_sql() -> str:
    """Both alerts without the last step, which the watermark has not passed."""
    parts = []
    for name, sql in (("error_rate", ORACLE["alert_error_rate"]), ("drift", ORACLE["alert_drift"])):
        parts.append(f"SELECT '{name}' AS alert, * FROM ({sql}) WHERE step_end < (SELECT (max(CAST(floor(epoch(ts) / 3600) AS BIGINT)) + 1) * 3600 FROM events)")
    return "\nUNION ALL\n".join(parts)


@register("stream_alerts", _alert_stream_sql())
def stream_alerts(spark, sf_dir):
    """STM-8 / STM-9 on a stream: the events land in three parts of time, each read by a query of its own that goes on from the checkpoint (a restart between
    them); the intervals of the alerts, a row a step."""
    from transcript_quality.operators.intervals import each_step
    from transcript_quality.sinks.writers import write_stream
    from transcript_quality.streaming import alerts as SA
    run = _run_dir(spark, "alerts")
    rows = scored_view(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "status", "predicted_wer")
    lo, hi = rows.agg(F.min("ts"), F.max("ts")).first()
    alerts = SA.standard_alerts(F.col("status").cast("string").rlike("^5..$"), MON._not_nan_gt(F.col("predicted_wer"), 0.4), STANDIN_MONITOR)
    for i in range(3):
        part = rows if lo is None else rows.where((F.col("ts") >= F.lit(lo + (hi - lo) * i / 3)) & ((F.col("ts") < F.lit(lo + (hi - lo) * (i + 1) / 3)) if i < 2 else F.lit(True)))
        part.write.mode("append").parquet(f"{run}/landing")
        stream = spark.readStream.schema(rows.schema).parquet(f"{run}/landing")
        with SA.rocksdb_state(spark):
            write_stream(SA.alert_stream(stream, "ts", alerts, STANDIN_MONITOR.step, "0 seconds"), f"{run}/out", f"{run}/checkpoint")
    steps = each_step(spark.read.parquet(f"{run}/out").select("alert", "k", "to", "value", "state"))
    return steps.select("alert", ((F.col("k") + 1) * 3600).alias("step_end"), rd("value").alias("value"), "state")


# ------------------------------------------------------------------ exact percentile beside the buckets
@register("p95_exact", """
SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS window_start, CAST(count(*) AS BIGINT) AS n, round(quantile_cont(value / 100.0, 0.95), 6) AS p95_exact
FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1""")
def p95_exact(spark, sf_dir):
    """STM-4: the exact percentile of each window."""
    out = MON.windowed_exact_quantile(scored_view(spark, sf_dir), "ts", "predicted_wer", "1 hour", 0.95)
    return out.select("window_start", "n", rd("quantile").alias("p95_exact"))


@register("value_quantiles", """
SELECT label, CAST(count(*) AS BIGINT) AS n, round(quantile_cont(CAST(x AS DOUBLE), 0.75), 6) AS upper_quartile
FROM (SELECT label, unnest(embedding) AS x FROM embeddings) WHERE label IS NOT NULL AND NOT isnan(x) GROUP BY label""")
def value_quantiles(spark, sf_dir):
    """AGG-4 by group: exact upper quartile of the samples of each label, few groups of many values."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    return ST.quantile_by(rows, ["label"], "x", 0.75, "upper_quartile").select("label", "n", rd("upper_quartile").alias("upper_quartile"))


# ------------------------------------------------------------------ evaluation with its report
@register("evaluation", f"""
WITH {FEATURE_VIEW_SQL},
s AS (SELECT CASE WHEN rms_db > -10 THEN 0.2 WHEN rms_db > -30 THEN 0.35 ELSE 0.6 END + CASE WHEN duration > 5 THEN 0.1 ELSE 0 END AS wer,
             CASE WHEN rms_db > -10 THEN 0.2 WHEN rms_db > -30 THEN 0.35 ELSE 0.6 END AS prediction FROM prepared)
SELECT * FROM ({ORACLE["diagnostics"]})
UNION ALL SELECT 'metrics', 'test', 'rmse', round(sqrt(avg((wer - prediction) * (wer - prediction))), 6) FROM s
UNION ALL SELECT 'metrics', 'test', 'spearman_rho', round(rho, 6) FROM {_avg_rank_corr_sql('s', 'wer', 'prediction')}
UNION ALL SELECT 'metrics', 'test', 'num_samples', CAST(count(*) AS DOUBLE) FROM s""")
def evaluation(spark, sf_dir):
    """ML-3: metrics and diagnostics of one evaluation; the model is that of ``diagnostics``."""
    from transcript_quality.operators import model as ML
    level = F.when(F.col("rms_db") > -10, 0.2).when(F.col("rms_db") > -30, 0.35).otherwise(0.6)
    rows = prepared_view(spark, sf_dir)
    model = ML.fit(rows.withColumn("wer", level), SCORE_TREE)
    # the target as a decimal sum, so that equal values tie on both sides
    judged = rows.withColumn("wer", level + F.when(F.col("duration") > 5, 0.1).otherwise(0.0))
    m = ML.evaluate(model, judged, SCORE_TREE, with_diagnostics=True)
    report = m["diagnostics"].where("section <> 'importance'").select("section", "name", "metric", "value")
    names = ("rmse", "spearman_rho", "num_samples")
    own = spark.createDataFrame([("metrics", "test", k, float(m[k])) for k in names], report.schema)
    return report.unionByName(own).select("section", "name", "metric", rd("value").alias("value"))


# ------------------------------------------------------------------ a stream of scores
@register("stream_scores", ORACLE["score_rows"])
def stream_scores(spark, sf_dir):
    """STM-2: the feature rows as a stream, each answered by the model and written with its micro-batch."""
    from transcript_quality.operators import model as ML
    from transcript_quality.sinks.writers import write_stream
    from transcript_quality.streaming.ingest import score_stream
    run = _run_dir(spark, "scores")
    target = F.when(F.col("rms_db") > -10, 0.2).when(F.col("rms_db") > -30, 0.35).otherwise(0.6)
    model = ML.fit(prepared_view(spark, sf_dir).withColumn("wer", target), SCORE_TREE)
    scored = ML.scored_rows(score_stream(feature_rows_of(stream_table(spark, sf_dir, "lineitem")), model, SCORE_TREE))
    write_stream(scored, f"{run}/out", f"{run}/checkpoint")
    out = spark.read.schema(scored.schema).option("recursiveFileLookup", True).parquet(f"{run}/out")
    return out.select("path", "status", rd("predicted_wer").alias("predicted_wer"), "review_recommended")


# ------------------------------------------------------------------ audio files on the shared folder
def _file_rows(files: DataFrame) -> DataFrame:
    from transcript_quality.operators import audio as A
    out = A.acoustic_features(A.decode_audio(files, STANDIN_ACOUSTIC), STANDIN_ACOUSTIC)
    return out.select(_vec_of(), F.col("error").isNotNull().alias("failed"), rd("duration").alias("duration"), rd("rms_db", 5).alias("rms_db"), rd("snr_db", 5).alias("snr_db"))


@register("file_features", ORACLE["decoded_features"])
def file_features(spark, sf_dir):
    """SRC-1 / SRC-6 / DEC-1: every vector is written as a WAV file in the shared folder; the files are scanned, decoded and featurised."""
    from transcript_quality.sinks.writers import write_files
    from transcript_quality.sources import audio as SA
    folder = f"{_run_dir(spark, 'audio')}/landing"
    n = write_files(wav_files(table(spark, sf_dir, "embeddings"), F.lit(STANDIN_SR)), folder)
    if n and not SA.enough_files(spark, folder, n):
        raise RuntimeError(f"{folder} has fewer than the {n} files written")
    return _file_rows(SA.read_audio(spark, folder))


@register("stream_file_features", ORACLE["decoded_features"])
def stream_file_features(spark, sf_dir):
    """SRC-5 / STM-1 on files: two landings in one folder, each read by a run that goes on from the checkpoint, so every file counts once."""
    from transcript_quality.sinks.writers import write_files, write_stream
    from transcript_quality.sources import audio as SA
    run = _run_dir(spark, "audio_stream")
    emb = table(spark, sf_dir, "embeddings")
    for i in range(2):
        write_files(wav_files(emb.where(F.pmod("vec_id", F.lit(2)) == i), F.lit(STANDIN_SR)), f"{run}/landing")
        rows = _file_rows(SA.stream_audio(spark, f"{run}/landing"))
        write_stream(rows, f"{run}/out", f"{run}/checkpoint", conf=SA.small_file_settings(spark))
    return spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{run}/out")


# ------------------------------------------------------------------ whole-table replacement
@register("table_versions", f"""
WITH {MANIFEST_SQL} SELECT 'before' AS seen, audio_id, md5(reference_text) AS text_md5 FROM m WHERE gender = 'en'
UNION ALL SELECT 'now', audio_id, md5(reference_text) FROM m""")
def table_versions(spark, sf_dir):
    """SNK-3: a manifest is replaced while a reader holds its first version."""
    from transcript_quality.sinks.writers import write_manifest
    from transcript_quality.sources.tables import read_manifest
    path = _run_dir(spark, "versions")
    rows = _manifest(table(spark, sf_dir, "documents"))
    write_manifest(rows.where("gender = 'en'"), path)
    before = read_manifest(spark, path)
    write_manifest(rows, path)
    seen = [d.select(F.lit(n).alias("seen"), "audio_id", F.md5("reference_text").alias("text_md5")) for n, d in (("before", before), ("now", read_manifest(spark, path)))]
    return seen[0].unionByName(seen[1])


@register("registry_promote", """
WITH c AS (SELECT 'v' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS version, CAST(sum(o_totalprice) AS DOUBLE) AS rho FROM orders GROUP BY o_custkey),
best AS (SELECT version FROM c ORDER BY rho DESC, version LIMIT 1), worst AS (SELECT version FROM c ORDER BY rho, version LIMIT 1),
log AS (SELECT version, 'candidate' AS stage FROM c UNION ALL SELECT version, 'production' FROM worst UNION ALL SELECT version, 'production' FROM best)
SELECT version, stage, version IN (SELECT version FROM best) AS in_production FROM log""")
def registry_promote(spark, sf_dir):
    """ML-5 / JOB-5: a registry with a candidate for each customer (its orders' sum is the metric): the weakest is deployed, then the strongest; the
    pointer names the second, and the log has both."""
    from transcript_quality.plans import jobs
    from transcript_quality.schemas import REGISTRY
    from transcript_quality.sinks.writers import append_registry
    path = f"{_run_dir(spark, 'registry')}/models"
    version = F.concat(F.lit("v"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("version")
    c = table(spark, sf_dir, "orders").groupBy(version).agg(F.sum("o_totalprice").cast("double").alias("spearman_rho"))
    none = F.lit(None).cast("double")
    append_registry(c.select("version", F.concat(F.lit(f"{path}/"), "version").alias("path"), F.lit("2024-01-01").cast("timestamp").alias("created_at"), "spearman_rho",
                             none.alias("spearman_p_value"), none.alias("rmse"), F.lit(0).cast("long").alias("num_samples"), F.lit("candidate").alias("stage")), path)
    log = spark.read.schema(REGISTRY).parquet(path)
    for better in (F.col("spearman_rho").asc(), F.col("spearman_rho").desc()):
        jobs.deploy(spark, path, log.orderBy(better, "version").first()["version"])
    log = spark.read.schema(REGISTRY).parquet(path)
    return log.select("version", "stage", (F.col("path") == jobs.production_model_path(spark, path)).alias("in_production"))


# ------------------------------------------------------------------ run summaries
@register("run_summaries", f"""
WITH {FEATURE_VIEW_SQL}, {MANIFEST_SQL}, scored AS ({ORACLE["score_rows"]}),
s AS (SELECT 'append' AS job, 'rows' AS metric, count(*) AS n FROM feat
      UNION ALL SELECT 'append', 'failed', count(*) FILTER (rms_db IS NULL) FROM feat
      UNION ALL SELECT 'append', 'unlabelled', count(*) FILTER (wer = -1) FROM feat
      UNION ALL SELECT 'manifest', 'rows', count(*) FROM m
      UNION ALL SELECT 'manifest', 'unlabelled', count(*) FILTER (coalesce(reference_text, '') = '') FROM m
      UNION ALL SELECT 'score', 'rows', count(*) FROM scored
      UNION ALL SELECT 'score', 'failed', count(*) FILTER (status <> 200) FROM scored
      UNION ALL SELECT 'score', 'flagged', count(*) FILTER (review_recommended) FROM scored)
SELECT * FROM s UNION ALL SELECT 'stream', metric, n FROM s WHERE job = 'append'""")
def run_summaries(spark, sf_dir):
    """AGG-14: what a history append, the same as a stream, a manifest write and a scoring write report of themselves."""
    from transcript_quality.operators import model as ML
    from transcript_quality.schemas import FEATURE_HISTORY
    from transcript_quality.sinks import writers as W
    from transcript_quality.streaming.summaries import run_summaries as listen
    run = _run_dir(spark, "summaries")
    target = F.when(F.col("rms_db") > -10, 0.2).when(F.col("rms_db") > -30, 0.35).otherwise(0.6)
    model = ML.fit(prepared_view(spark, sf_dir).withColumn("wer", target), SCORE_TREE)
    rows = feature_view(spark, sf_dir)
    got = {"append": W.append_features(rows, f"{run}/history"), "manifest": W.write_manifest(_manifest(table(spark, sf_dir, "documents")), f"{run}/manifest"),
           "score": W.append_scores(ML.scored_rows(ML.score(model, rows, SCORE_TREE)), f"{run}/scores")}
    stream = feature_rows_of(stream_table(spark, sf_dir, "lineitem")).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_HISTORY.fields])
    with listen(spark) as seen:
        got["stream"] = seen.of(W.write_stream(stream, f"{run}/history", f"{run}/checkpoint", metrics=W.history_metrics()))
    return spark.createDataFrame([(job, m, int(n)) for job, metrics in got.items() for m, n in metrics.items()], "job string, metric string, n long")
