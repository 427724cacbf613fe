"""Exact quantiles in groups, ranks by running sums, files written by tasks, reports of an evaluation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transcript_quality.operators import monitoring as MON
from transcript_quality.operators import stats as ST
from transcript_quality.operators.transcripts import to_feature_history
from transcript_quality.sinks.writers import write_files
from transcript_quality.sources.audio import read_audio


@pytest.mark.parametrize("q", [0.0, 0.3, 0.95, 1.0])
def test_quantile_by_against_numpy(spark, q):
    rng = random.Random(5)
    rows = [("hot", float(rng.randrange(40))) for _ in range(600)] + [("all equal", 2.0)] * 50 + [("one", -1.5)] + \
        [("wide", rng.gauss(0, 1e6)) for _ in range(101)] + [("none", None), ("nan", math.nan), (None, 1.0), ("one", None), ("hot", math.nan)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r.g: (r.n, r.quantile) for r in ST.quantile_by(df, ["g"], "x", q, partitions=5).collect()}
    want = {}
    for g in ("hot", "all equal", "one", "wide"):
        xs = [x for k, x in rows if k == g and x is not None and not math.isnan(x)]
        want[g] = (len(xs), float(np.quantile(xs, q)))
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][0] == want[g][0] and got[g][1] == pytest.approx(want[g][1], rel=1e-12)
    every = ST.quantile_by(df.where("g = 'wide'"), [], "x", q).collect()
    assert len(every) == 1 and every[0]["quantile"] == pytest.approx(want["wide"][1])
    assert ST.quantile_by(df.limit(0), ["g"], "x", q).collect() == []


def test_windows_and_names(spark):
    rows = spark.sql("SELECT * FROM VALUES (TIMESTAMP'2024-01-01 00:00:01', 1.0D), (TIMESTAMP'2024-01-01 00:00:59', 3.0D), (TIMESTAMP'2024-01-01 00:02:00', 7.0D), (NULL, 9.0D) AS t(ts, n)")
    got = sorted((r.n, r.quantile) for r in MON.windowed_exact_quantile(rows, "ts", "n", "1 minute", 0.5).collect())
    assert got == [(1, 7.0), (2, 2.0)]


def test_ranks_over_many_ranges(spark):
    rng = random.Random(2)
    xs = [float(rng.randrange(50)) for _ in range(400)]
    got = {r.v: r["rank"] for r in ST.average_ranks(spark.createDataFrame([(x,) for x in xs], "v double"), rows_per_bucket=4).collect()}
    for v in set(xs):
        assert got[v] == sum(x < v for x in xs) + (xs.count(v) + 1) / 2


def test_write_files_twice(spark, tmp_path):
    folder = str(tmp_path / "landing")
    df = spark.createDataFrame([("file:/a/1.wav", bytearray(b"abc")), ("x/2.wav", bytearray(b"")), ("3.wav", None)], "path string, content binary")
    for _ in range(2):
        assert write_files(df, folder) == 3
    assert {p.name: p.read_bytes() for p in (tmp_path / "landing").iterdir()} == {"1.wav": b"abc", "2.wav": b"", "3.wav": b""}
    back = {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in read_audio(spark, folder).collect()}
    assert back == {"1.wav": b"abc"}  # Spark's scan of binary files leaves empty files out
    assert write_files(df.limit(0), str(tmp_path / "none")) == 0


def test_missing_features_are_zero(spark):
    df = spark.createDataFrame([("a", 1.0, None, None), ("b", 2.0, 3.0, "broken")], "path string, rms_db double, snr_db double, error string") \
        .withColumn("wer", F.lit(-1.0))
    got = {r.path: r for r in to_feature_history(df).collect()}
    assert (got["a"].rms_db, got["a"].snr_db, got["a"].duration, got["a"].asr_confidence, got["a"].wer) == (1.0, 0.0, 0.0, 0.0, -1.0)
    assert got["b"].rms_db is None and got["b"].snr_db is None and got["b"].wer is None
