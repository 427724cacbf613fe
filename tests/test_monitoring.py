from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from transcript_quality.config import MonitorConfig, WER_BUCKETS
from transcript_quality.operators import monitoring as MON


def test_review_threshold_is_strict_and_nan_safe(spark):
    df = spark.createDataFrame([(0.9,), (0.1,), (0.41,), (0.4,), (float("nan"),), (None,)], "predicted_wer double")
    got = [r.review_recommended for r in MON.flag_for_review(df, 0.4).collect()]
    assert got == [True, False, True, False, False, False]


def test_histogram_count_and_sum(spark):
    df = spark.createDataFrame([(0.5,), (0.05,), (0.95,), (2.0,)], "v double")
    h = {r.le: r["count"] for r in MON.cumulative_histogram(df, "v", WER_BUCKETS).collect()}
    assert h[0.0] == 0 and h[0.1] == 1 and h[0.5] == 2 and h[1.0] == 3 and h[float("inf")] == 4
    s = MON.histogram_summary(df, "v", 0.4).first()
    assert (s.n_observed, s.sum_observed, s.n_flagged) == (4, 3.5, 3)


def prom_quantile(q, bounds, cum):
    """Straight transcription of the interpolation rule for checking."""
    total = cum[-1]
    if total == 0:
        return float("nan")
    rank = q * total
    b = next((i for i in range(len(bounds) - 1) if cum[i] >= rank), len(bounds) - 1)
    if b == len(bounds) - 1:
        return bounds[-2]
    if b == 0 and bounds[0] <= 0:
        return bounds[0]
    start = bounds[b - 1] if b > 0 else 0.0
    prev = cum[b - 1] if b > 0 else 0
    return start + (bounds[b] - start) * (rank - prev) / (cum[b] - prev)


@pytest.mark.parametrize("cum", [[0, 1, 3, 3, 5, 8, 9, 9, 10, 10], [0, 0, 0, 0, 0, 0, 0, 0, 1, 20],
                                 [5, 5, 5, 5, 5, 5, 5, 5, 5, 5], [0, 0, 2, 4, 6, 8, 10, 12, 14, 14]])
def test_bucket_quantile(spark, cum):
    bounds = [float(b) for b in WER_BUCKETS]
    df = spark.createDataFrame([(cum,)], "c array<bigint>")
    got = df.select(MON.bucket_quantile(0.95, bounds, F.col("c")).alias("p")).first().p
    assert got == pytest.approx(prom_quantile(0.95, bounds, cum))


def _events(spark, per_step):
    t0 = datetime(2024, 1, 1)
    rows = []
    for k, n in enumerate(per_step):
        for i in range(n):
            rows.append((t0 + timedelta(seconds=15 * k + i * 0.01), "error", 0.9))
    return spark.createDataFrame(rows, "ts timestamp, event_type string, predicted_wer double")


def test_error_alert_pending_then_firing(spark):
    # 5m window / 15 s step = 20 steps; threshold 0.05/s = 15 errors per window
    per_step = [0] * 5 + [2] * 30 + [0] * 30
    df = _events(spark, per_step)
    a = MON.error_rate_alert(df, "ts", F.col("event_type") == "error", MonitorConfig()).orderBy("step_end").collect()
    states = [r.state for r in a]
    assert states[0] == "inactive" and "pending" in states and "firing" in states
    first_true = states.index("pending")
    assert states[first_true:first_true + 8] == ["pending"] * 8          # 2 minutes = 8 steps
    assert states[first_true + 8] == "firing"


def test_rate_series_dense_grid(spark):
    df = _events(spark, [1, 0, 0, 3])
    r = MON.rate_series(df, "ts", ["30 seconds"], "15 seconds").orderBy("step_end").collect()
    assert [x.n_in_window for x in r] == [1, 1, 0, 3] and r[-1].rate == pytest.approx(0.1)


def test_windowed_quantile_levels(spark):
    df = _events(spark, [10])
    q = MON.windowed_quantile(df, "ts", "predicted_wer", "1 minute").first()
    assert q.n == 10 and q.p95 == pytest.approx(0.8 + 0.2 * 0.95) and q.p95_level == "red"
