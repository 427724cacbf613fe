"""Model registry rows: version labels, latest version, promotion gate, promote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transcript_quality.schemas import REGISTRY


def version_label(ts: str | Column) -> Column:
    """DAT-1: 'v' + yyyyMMdd_HHmmss, plus milliseconds so two runs in one second differ."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.lit("v"), F.date_format(c, "yyyyMMdd_HHmmss_SSS"))


def latest_version(registry: DataFrame, stage: str | None = None, group_cols=()) -> DataFrame:
    """WIN-6: newest entry (max_by created_at, ties broken by version) per group."""
    r = registry if stage is None else registry.where(F.col("stage") == stage)
    order = F.struct("created_at", "version")
    return r.groupBy(*group_cols).agg(
        F.max_by("version", order).alias("version"),
        F.max_by("path", order).alias("path"),
        F.max("created_at").alias("created_at"))


def compare_models(candidate: DataFrame, production: DataFrame | None,
                   metric: str = "spearman_rho", allow_equal: bool = False) -> DataFrame:
    """JON-6 + ML-4: one row (candidate, production, promote).

    Both metric sets are stacked as (role, value) rows and folded by one aggregate (no join).
    A missing, empty or NaN production metric counts as -1.0; a NaN candidate never promotes;
    the comparison is strict unless ``allow_equal``."""
    rows = candidate.select(F.lit("candidate").alias("role"), F.col(metric).cast("double").alias("value"))
    if production is not None:
        rows = rows.unionByName(production.select(F.lit("production").alias("role"),
                                                  F.col(metric).cast("double").alias("value")))
    folded = rows.agg(
        F.first(F.when(F.col("role") == "candidate", F.col("value")), ignorenulls=True).alias("candidate"),
        F.first(F.when(F.col("role") == "production", F.col("value")), ignorenulls=True).alias("production"))
    p = F.col("production")
    p = F.when(p.isNull() | F.isnan(p), F.lit(-1.0)).otherwise(p)
    c = F.col("candidate")
    better = (c >= p) if allow_equal else (c > p)
    return folded.select(
        "candidate", p.alias("production"),
        F.coalesce(c.isNotNull() & ~F.isnan(c) & better, F.lit(False)).alias("promote"))


def promote(registry: DataFrame, version: str) -> DataFrame:
    """ML-5: the registry row to append that makes ``version`` production; raises if absent."""
    row = registry.where(F.col("version") == version).limit(1)
    if row.count() == 0:
        raise FileNotFoundError(f"Candidate model not found: {version}")
    return row.select(*[F.col(c) for c in REGISTRY.fieldNames() if c not in ("stage", "created_at")],
                      F.current_timestamp().alias("created_at"), F.lit("production").alias("stage")) \
        .select(*REGISTRY.fieldNames())


def production_version(registry: DataFrame) -> DataFrame:
    return latest_version(registry, stage="production")
