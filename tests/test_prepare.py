import pytest

from transcript_quality.operators.prepare import (
    hash_split, prepare, require_columns, require_min_samples, train_test,
)

F4 = [(1.0, 2.0, 0.1), (2.0, 3.0, 0.2), (3.0, 4.0, 0.3), (4.0, 5.0, 0.4), (5.0, 6.0, 0.5)]


def test_nan_rows_dropped(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, nan, 0.1), (nan, 2.0, 0.2), (3.0, 3.0, nan), (4.0, 4.0, 0.4)],
                               "feat1 double, feat2 double, target double")
    assert prepare(df, ["feat1", "feat2"], "target").count() == 1
    df2 = spark.createDataFrame([(1.0, None, 0.1), (1.0, 1.0, -1.0), (1.0, 1.0, 0.5)], "feat1 double, feat2 double, target double")
    assert prepare(df2, ["feat1", "feat2"], "target").count() == 2
    assert prepare(df2, ["feat1", "feat2"], "target", drop_unlabelled=True).count() == 1


def test_missing_columns(spark):
    df = spark.createDataFrame(F4, "feat1 double, feat2 double, target double")
    with pytest.raises(ValueError, match="Missing feature columns"):
        require_columns(df, ["feat1", "nope"], "target")
    with pytest.raises(ValueError, match="not found in data"):
        require_columns(df, ["feat1"], "wer")


def test_min_samples(spark):
    df = spark.createDataFrame(F4, "feat1 double, feat2 double, target double")
    assert require_min_samples(df, 5) is df
    with pytest.raises(ValueError, match="Insufficient training data"):
        require_min_samples(df, 6)


def test_hash_split_stable_and_sized(spark):
    df = spark.range(20000).selectExpr("concat('p', id) AS path")
    a = {r.path for r in hash_split(df, "path").where("split = 'test'").collect()}
    b = {r.path for r in hash_split(df.repartition(7), "path").where("split = 'test'").collect()}
    assert a == b and 0.18 < len(a) / 20000 < 0.22
    tr, te = train_test(df, "path")
    train_paths = {r.path for r in tr.collect()}
    assert tr.count() + te.count() == 20000 and not (train_paths & a)
