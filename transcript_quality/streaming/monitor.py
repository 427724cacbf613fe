"""Structured Streaming monitoring: event-time windowed histograms with watermark and dedupe.

``windowed_histogram_stream`` is the stateful aggregate (one row per window with one cumulative
count per bucket bound, plus count and sum).  ``run_to_table`` drives any streaming aggregate in
update mode into a table: each micro-batch's updated rows land in their own ``batch=<id>``
folder, written with overwrite so a retried batch replaces (never duplicates) its output, and
``latest_per_key`` folds the folders into the current value of every key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.operators.monitoring import bucket_quantile


def windowed_histogram_stream(scored: DataFrame, ts: str, col: str, window: str, bounds,
                              watermark: str = "10 minutes", dedupe_key: str | None = None,
                              slide: str | None = None) -> DataFrame:
    """STM-3/10: per event-time window (tumbling, or sliding with ``slide``) the cumulative
    bucket counts ``b0..bk`` (value <= bound), the count and the sum of ``col``."""
    bounds = [float(b) for b in bounds]
    if bounds[-1] != float("inf"):
        bounds.append(float("inf"))
    s = scored.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    if dedupe_key:
        s = s.dropDuplicatesWithinWatermark([dedupe_key])
    v = F.col(col).cast("double")
    win = F.window(ts, window, slide) if slide else F.window(ts, window)
    return s.groupBy(win.alias("w")).agg(
        F.count(F.lit(1)).cast("long").alias("n"), F.sum(v).alias("sum"),
        *[F.count_if(v <= F.lit(b)).cast("long").alias(f"b{i}") for i, b in enumerate(bounds)],
    ).select(F.unix_seconds(F.col("w.start")).alias("window_start"),
             F.unix_seconds(F.col("w.end")).alias("window_end"), "*").drop("w")


def with_quantile(hist: DataFrame, bounds, q: float = 0.95, out: str = "p95") -> DataFrame:
    """STM-4 on rows of ``windowed_histogram_stream`` (works on streams and tables)."""
    bounds = [float(b) for b in bounds]
    if bounds[-1] != float("inf"):
        bounds.append(float("inf"))
    cum = F.array(*[F.col(f"b{i}") for i in range(len(bounds))])
    return hist.withColumn(out, bucket_quantile(q, bounds, cum))


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                 output_mode: str = "update"):
    """Start ``stream`` writing each micro-batch to ``out_path/batch=<id>`` (idempotent on
    retry).  With ``available_now`` the call waits until all available input is processed."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")

    w = stream.writeStream.outputMode(output_mode).foreachBatch(write) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return w.start()


def latest_per_key(spark: SparkSession, out_path: str, key_cols) -> DataFrame:
    """Current row of every key: the one written by the latest micro-batch."""
    df = spark.read.parquet(out_path)
    keys = list(key_cols)
    value_cols = [c for c in df.columns if c not in keys and c != "batch"]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), F.col("batch")).alias("_v"))
    return latest.select(*keys, "_v.*")
