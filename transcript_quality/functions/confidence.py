"""Transcript confidence from per-word / per-token confidence arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CONFIDENCE = 0.5


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def valid_mean(values) -> Column:
    """Mean of the non-NULL, non-NaN items; NULL when there are none (or the array is NULL)."""
    valid = F.filter(_c(values).cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c))
    total = F.aggregate(valid, F.lit(0.0).cast("double"), lambda a, v: a + v)
    return F.try_divide(total, F.size(valid).cast("double"))


def mean_confidence(word_confidence, default: float = DEFAULT_CONFIDENCE) -> Column:
    """Ingest rule: mean valid word confidence, else ``default``."""
    return F.coalesce(valid_mean(word_confidence), F.lit(default))


def confidence_chain(word_confidence, token_confidence, score,
                     default: float = DEFAULT_CONFIDENCE) -> Column:
    """Offline rule: word mean -> token mean -> score -> ``default``."""
    return F.coalesce(valid_mean(word_confidence), valid_mean(token_confidence),
                      _c(score).cast("double"), F.lit(default))
