"""Batch monitoring of scored traffic: histograms, rates, quantiles, levels and alerts.

Counter and histogram series are rebuilt from event-time rows.  Everything is pre-aggregated to
evaluation steps first (partial aggregation, one row per step and series).  Trailing windows and alert states are intervals
(`operators.intervals`): exact over any gap, with no row for steps at which nothing changes.
Rates are exact counts over event time divided by the window length (no counter extrapolation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transcript_quality.config import MonitorConfig
from transcript_quality.operators.intervals import each_step, state_intervals, window_intervals
from transcript_quality.operators.stats import quantile_by


def seconds(duration: str) -> int:
    """'15 seconds' / '5 minutes' / '2 hours' / '1 day' -> seconds."""
    value, unit = duration.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(float(value) * scale)


def epoch_seconds(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000.0)


def _not_nan_gt(c: Column, threshold: float) -> Column:
    """``c > threshold`` that is False for NULL and NaN (Spark orders NaN above numbers)."""
    return F.coalesce(c.isNotNull() & ~F.isnan(c) & (c > F.lit(threshold)), F.lit(False))


def flag_for_review(df: DataFrame, threshold: float = 0.4, col: str = "predicted_wer") -> DataFrame:
    """FLT-3: strict ``predicted_wer > threshold``; NaN/NULL predictions are never flagged."""
    return df.withColumn("review_recommended", _not_nan_gt(F.col(col).cast("double"), threshold))


# --------------------------------------------------------------------------- histograms
def _bound_counts(v: Column, bounds) -> list[Column]:
    return [F.count_if(v <= F.lit(float(b))).cast("long").alias(f"b{i}") for i, b in enumerate(bounds)]


def cumulative_histogram(df: DataFrame, col: str, bounds, group_cols=()) -> DataFrame:
    """AGG-10/11: rows (group..., le, count) with cumulative ``value <= le`` counts.

    One aggregate with one conditional count per bound (partial aggregation, no row explosion);
    the long form is a bounded ``stack`` over the bucket columns."""
    bounds = [float(b) for b in bounds]
    if bounds[-1] != float("inf"):
        bounds.append(float("inf"))
    v = F.col(col).cast("double")
    wide = df.groupBy(*group_cols).agg(*_bound_counts(v, bounds))
    pieces = ", ".join(f"CAST('{b}' AS DOUBLE), b{i}" for i, b in enumerate(bounds))
    return wide.selectExpr(*[f"`{g}`" for g in group_cols],
                           f"stack({len(bounds)}, {pieces}) AS (le, `count`)")


def histogram_summary(df: DataFrame, col: str, threshold: float = 0.4) -> DataFrame:
    """AGG-11/12: histogram ``_count`` and ``_sum`` and the low-quality counter."""
    v = F.col(col).cast("double")
    return df.agg(F.count(v).cast("long").alias("n_observed"), F.sum(v).alias("sum_observed"),
                  F.count_if(_not_nan_gt(v, threshold)).cast("long").alias("n_flagged"))


def bucket_quantile(q: float, bounds, cum_counts: Column) -> Column:
    """Quantile from cumulative bucket counts with linear interpolation inside the bucket.

    ``bounds`` ascending and ending in +Inf; ``cum_counts`` an ARRAY<BIGINT> aligned with it.
    The rank falling into the +Inf bucket returns the highest finite bound; a first bucket with
    an upper bound <= 0 returns that bound; no observations -> NaN."""
    bounds = [float(b) for b in bounds]
    k = len(bounds)
    ub = F.array(*[F.lit(b) for b in bounds])
    c = cum_counts
    total = F.element_at(c, k).cast("double")
    rank = F.lit(float(q)) * total
    # first index (1-based) among the first k-1 buckets with cum >= rank, else k
    hit = F.array_position(F.transform(F.slice(c, 1, k - 1), lambda x: x.cast("double") >= rank), True)
    b = F.when(hit > 0, hit).otherwise(F.lit(k)).cast("int")
    prev_count = F.when(b > 1, F.element_at(c, F.greatest(b - 1, F.lit(1))).cast("double")).otherwise(F.lit(0.0))
    start = F.when(b > 1, F.element_at(ub, F.greatest(b - 1, F.lit(1)))).otherwise(F.lit(0.0))
    end = F.element_at(ub, b)
    width_count = F.element_at(c, b).cast("double") - prev_count
    interp = start + (end - start) * F.try_divide(rank - prev_count, width_count)
    return (F.when(total <= 0, F.lit(float("nan")))
            .when(b == k, F.lit(bounds[-2]))
            .when((b == 1) & (F.lit(bounds[0]) <= 0), F.lit(bounds[0]))
            .otherwise(interp))


def level(value: Column, orange: float, red: float) -> Column:
    """Traffic-light level of a stat panel (thresholds inclusive)."""
    return (F.when(value >= F.lit(red), "red").when(value >= F.lit(orange), "orange")
            .otherwise("green"))


def windowed_quantile(df: DataFrame, ts: str, col: str, window: str, q: float = 0.95,
                      bounds=None, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """STM-4/5/7: per tumbling window the bucket-interpolated quantile, throughput per second
    and the p95 level.  One grouped aggregate; all per-window work is on bounded arrays."""
    bounds = [float(b) for b in (bounds or cfg.wer_buckets)]
    w = seconds(window)
    v = F.col(col).cast("double")
    start = (F.floor(epoch_seconds(ts) / w) * w).cast("long")
    agg = df.groupBy(start.alias("window_start")).agg(
        F.count(F.lit(1)).cast("long").alias("n"), *_bound_counts(v, bounds))
    cum = F.array(*[F.col(f"b{i}") for i in range(len(bounds))])
    p = bucket_quantile(q, bounds, cum)
    return agg.select(
        "window_start", "n",
        (F.col("n") / F.lit(float(w))).alias("per_second"),
        p.alias("p95"),
        level(p, *cfg.p95_levels).alias("p95_level"),
    )


def windowed_exact_quantile(df: DataFrame, ts: str, col: str, window: str, q: float = 0.95) -> DataFrame:
    """STM-4, exact form: per tumbling window the quantile of the values themselves, with linear interpolation, beside the one from
    buckets.  Rows without a time are in no window; a window holds any share of the rows."""
    w = seconds(window)
    rows = df.select((F.floor(epoch_seconds(ts) / w) * w).cast("long").alias("window_start"), F.col(col).alias("value"))
    return quantile_by(rows, ["window_start"], "value", q)


# --------------------------------------------------------------------------- step series
#: In a listing of steps, a stretch of more steps without a change gives its first and last one (a stray old time stamp would give millions).
LONGEST_STRETCH = 10_000


def step_counts(df: DataFrame, ts: str, step: str, measures: dict[str, Column], group_cols=()) -> DataFrame:
    """Counts of each evaluation step (bucket ``[k*step, (k+1)*step)``) that has rows."""
    k = F.floor(epoch_seconds(ts) / seconds(step)).cast("long")
    return df.groupBy(*group_cols, k.alias("k")).agg(*[m.cast("long").alias(name) for name, m in measures.items()])


def rate_intervals(df: DataFrame, ts: str, windows, step: str, group_cols=(), where: Column | None = None) -> DataFrame:
    """WIN-3: rows (group..., window_sec, k, to, n_in_window, rate), constant from step k up to step ``to``, for each w in ``windows``:
    the events of the last w seconds, and these / w.  All windows are swept at once."""
    st = seconds(step)
    measure = F.count_if(where) if where is not None else F.count(F.lit(1))
    sizes = [seconds(w) for w in windows]
    for wdef, ws in zip(windows, sizes):
        if ws % st:
            raise ValueError(f"window {wdef} must be a multiple of the step {step}")
    counts = step_counts(df, ts, step, {"n_in_window": measure}, group_cols).withColumn(
        "window_sec", F.explode(F.array(*[F.lit(ws).cast("long") for ws in sizes])))
    out = window_intervals(counts, ["n_in_window"], (F.col("window_sec") / st).cast("long"), (*group_cols, "window_sec"))
    return out.drop("_part").withColumn("rate", F.col("n_in_window") / F.col("window_sec").cast("double"))


def rate_series(df: DataFrame, ts: str, windows, step: str, group_cols=(),
                where: Column | None = None) -> DataFrame:
    """WIN-3: ``rate(x[w])`` for each w in ``windows``, a row a step: rows (group..., step_end, window_sec,
    n_in_window, rate) where rate = events in [step_end - w, step_end) / w seconds (stretches: ``LONGEST_STRETCH``)."""
    steps = each_step(rate_intervals(df, ts, windows, step, group_cols, where), LONGEST_STRETCH)
    return steps.select(*group_cols, ((F.col("k") + 1) * seconds(step)).alias("step_end"), "window_sec", "n_in_window", "rate")


def increase_intervals(df: DataFrame, ts: str, window: str, step: str, where: Column, levels=(1.0, 10.0)) -> DataFrame:
    """WIN-4 + STM-6: rows (k, to, increase, level): ``increase(x[w])`` of a counter (events matching ``where``) with its level."""
    counts = step_counts(df, ts, step, {"increase": F.count_if(where)})
    out = window_intervals(counts, ["increase"], F.lit(seconds(window) // seconds(step)).cast("long"))
    return out.drop("_part").withColumn("level", level(F.col("increase"), *levels))


def increase_series(df: DataFrame, ts: str, window: str, step: str, where: Column,
                    levels=(1.0, 10.0)) -> DataFrame:
    """`increase_intervals`, a row a step."""
    steps = each_step(increase_intervals(df, ts, window, step, where, levels), LONGEST_STRETCH)
    return steps.select(((F.col("k") + 1) * seconds(step)).alias("step_end"), "increase", "level")


def _hold_steps(hold: str, step: str) -> int:
    return -(-seconds(hold) // seconds(step))


def alert_value(hits: Column, requests: Column, window: str, mode: str) -> Column:
    """What an alert compares: hits per second of the window ("rate"), or hits / requests ("ratio"; NULL without requests)."""
    if mode not in ("rate", "ratio"):
        raise ValueError(f"mode must be rate or ratio, not {mode}")
    return (hits / F.lit(float(seconds(window))) if mode == "rate"
            else F.try_divide(hits.cast("double"), requests.cast("double")))


def alert_intervals(df: DataFrame, ts: str, hit: Column, window: str, hold: str, threshold: float, step: str, mode: str = "rate") -> DataFrame:
    """WIN-5: rows (k, to, value, state), constant from step k up to step ``to``: ``value > threshold`` is 'pending' from its first true step
    and 'firing' once it has held for ``hold``."""
    counts = step_counts(df, ts, step, {"hits": F.count_if(hit), "requests": F.count(F.lit(1))})
    series = window_intervals(counts, ["hits", "requests"], F.lit(seconds(window) // seconds(step)).cast("long"))
    value = alert_value(F.col("hits"), F.col("requests"), window, mode)
    return state_intervals(series, value, _not_nan_gt(value, threshold), _hold_steps(hold, step))


def _alert_steps(intervals: DataFrame, step: str) -> DataFrame:
    return each_step(intervals, LONGEST_STRETCH).select(((F.col("k") + 1) * seconds(step)).alias("step_end"), "value", "state")


def error_rate_alert(df: DataFrame, ts: str, is_error: Column, cfg: MonitorConfig = MonitorConfig(),
                     threshold: float | None = None, mode: str = "rate") -> DataFrame:
    """STM-8: 5xx rate over ``error_window`` > threshold per second (``mode="ratio"``: share of the requests), held
    ``error_hold``; a row a step."""
    thr = cfg.error_threshold if threshold is None else threshold
    return _alert_steps(alert_intervals(df, ts, is_error, cfg.error_window, cfg.error_hold, thr, cfg.step, mode), cfg.step)


def drift_alert(df: DataFrame, ts: str, flagged: Column, cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """STM-9: low-quality rate / request rate over ``drift_window`` > threshold, held
    ``drift_hold`` (ratio of sums over the same rows); a row a step."""
    return _alert_steps(alert_intervals(df, ts, flagged, cfg.drift_window, cfg.drift_hold, cfg.drift_threshold, cfg.step, "ratio"), cfg.step)
