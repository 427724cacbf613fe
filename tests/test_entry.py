"""Driver contract: entry smoke run, every registered query runs, and SQL twins agree (sf0.001)."""

import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
FAST_ORACLE = ["acoustic_features", "audio_validity", "confidence_mean", "confidence_fallback", "filename_clean",
               "lookup_join", "manifest_merge", "existing_audio", "sample_exact", "reference_lookup", "prepare_rows",
               "hash_split", "wer_stats", "confidence_stats", "feature_target_corr", "spearman", "histogram_wer",
               "rate_windows", "p95_from_buckets", "alert_error_rate", "alert_drift", "model_gate", "latest_version",
               "wer_pairs", "feature_rows", "ground_truth_rows", "manifest_union", "manifest_roundtrip", "lookup_roundtrip",
               "history_rows", "spearman_p", "decoded_features", "decoded_validity", "score_rows"]


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "mean_snr_db" in df.columns


def test_every_query_has_sql_or_is_model_based():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    library = {n for n in q if not re.match(r"op\d+_|pipeline$", n)}
    assert library - set(s) == {"gbt_metrics", "importance"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST_ORACLE)
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows) and digest(df.columns, rows) == digest(ocols, orows)
