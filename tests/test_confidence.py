import math

from transcript_quality.functions.confidence import confidence_chain, mean_confidence


def test_mean_confidence_rules(spark):
    nan = float("nan")
    df = spark.createDataFrame([([0.9, 0.9, 0.9, 0.9],), (None,), ([],), ([0.2, None, nan, 0.4],), ([None, nan],)],
                               "c array<double>")
    got = [r.v for r in df.select(mean_confidence("c").alias("v")).collect()]
    assert [round(v, 9) for v in got] == [0.9, 0.5, 0.5, 0.3, 0.5]


def test_confidence_chain(spark):
    nan = float("nan")
    df = spark.createDataFrame([
        ([0.8], [0.1], 0.2), ([nan], [0.6, 0.7], 0.2), (None, [None], 0.25), ([], None, None)],
        "w array<double>, t array<double>, s double")
    got = [r.v for r in df.select(confidence_chain("w", "t", "s").alias("v")).collect()]
    assert [round(v, 9) for v in got] == [0.8, 0.65, 0.25, 0.5]
    assert not any(math.isnan(v) for v in got)
