"""Training-table checks, cleaning and the seeded hash split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, feature_columns, target_column: str) -> DataFrame:
    """PRJ-4 / SET-2: fail early when feature or target columns are absent."""
    missing = set(feature_columns) - set(df.columns)
    if missing:
        raise ValueError(f"Missing feature columns: {sorted(missing)}. Available columns: {df.columns}")
    if target_column not in df.columns:
        raise ValueError(f"Target column '{target_column}' not found in data")
    return df


def _valid(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c)


def prepare(df: DataFrame, feature_columns, target_column: str,
            drop_unlabelled: bool = False) -> DataFrame:
    """FLT-1: keep rows whose features and target are all non-NULL and non-NaN.

    ``drop_unlabelled`` also drops rows with a negative target (the ingest marks rows without a
    reference text with -1.0)."""
    require_columns(df, feature_columns, target_column)
    cond = F.lit(True)
    for c in [*feature_columns, target_column]:
        cond = cond & _valid(F.col(c).cast("double"))
    if drop_unlabelled:
        cond = cond & (F.col(target_column) >= 0)
    return df.where(cond)


def require_min_samples(df: DataFrame, n: int) -> DataFrame:
    """FLT-4: raise when fewer than ``n`` rows exist (reads at most ``n`` rows to decide)."""
    if df.limit(n).count() < n:
        raise ValueError(f"Insufficient training data: {df.count()} samples (minimum: {n})")
    return df


def split_bucket(key, seed: int = 42) -> Column:
    """Stable bucket 0..9999 from md5(seed|key): independent of partitioning and row order."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), k.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 10000).cast("int")


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """LIM-3: adds ``split`` = 'test' for a ``test_size`` share of keys, else 'train'."""
    cut = int(round(test_size * 10000))
    return df.withColumn("split", F.when(split_bucket(key, seed) < cut, "test").otherwise("train"))


def train_test(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42):
    s = hash_split(df, key, test_size, seed)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"))
