import math
from datetime import datetime

import pytest

from transcript_quality.operators.registry import compare_models, latest_version, promote, version_label
from transcript_quality.schemas import REGISTRY

GATE_CASES = [(0.85, 0.80, True), (0.80, 0.85, False), (0.80, 0.80, False), (0.50, -1.0, True),
              (0.0, -1.0, True), (-0.5, -1.0, True), (0.3, 0.6, False)]


@pytest.mark.parametrize("cand,prod,expected", GATE_CASES)
def test_gate_is_strict(spark, cand, prod, expected):
    c = spark.createDataFrame([(cand,)], "spearman_rho double")
    p = spark.createDataFrame([(prod,)], "spearman_rho double")
    assert compare_models(c, p).first().promote is expected


def test_gate_missing_and_nan(spark):
    c = spark.createDataFrame([(0.2,)], "spearman_rho double")
    r = compare_models(c, None).first()
    assert r.production == -1.0 and r.promote
    nan = spark.createDataFrame([(float("nan"),)], "spearman_rho double")
    assert not compare_models(nan, None).first().promote
    assert compare_models(c, nan).first().production == -1.0
    same = spark.createDataFrame([(0.8,)], "spearman_rho double")
    assert compare_models(same, same, allow_equal=True).first().promote


def _registry(spark):
    rows = [("v1", "/m/v1", datetime(2024, 1, 1), 0.5, 0.01, 0.2, 100, "candidate"),
            ("v2", "/m/v2", datetime(2024, 1, 2), 0.6, 0.01, 0.2, 100, "candidate"),
            ("v1", "/m/v1", datetime(2024, 1, 3), 0.5, 0.01, 0.2, 100, "production")]
    return spark.createDataFrame(rows, REGISTRY)


def test_latest_and_promote(spark):
    reg = _registry(spark)
    assert latest_version(reg, "candidate").first().version == "v2"
    assert latest_version(reg, "production").first().path == "/m/v1"
    row = promote(reg, "v2").first()
    assert row.stage == "production" and row.version == "v2"
    with pytest.raises(FileNotFoundError):
        promote(reg, "v9")


def test_version_label(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 6, 7, 8, 9, 123000),)], "ts timestamp")
    assert df.select(version_label("ts").alias("v")).first().v == "v20240506_070809_123"
