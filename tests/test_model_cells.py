"""Large training tables are fitted by cells of their bins: the same trees from a bounded number of rows."""

import math

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from transcript_quality.config import GBTConfig, TrainingConfig
from transcript_quality.operators import model as ML
from transcript_quality.sources.tables import load_model

CFG = TrainingConfig(gbt=GBTConfig(n_estimators=5, max_depth=4, max_bins=6))


def table(spark, n=4000):
    r = lambda k: (F.xxhash64("id", F.lit(k)) % 1000) / 1000.0
    rows = spark.range(n).select("id", F.col("id").cast("string").alias("path"), F.round(r(1) * 50).alias("rms_db"), (r(2) * 40).alias("snr_db"),
                                 F.exp(r(3)).alias("duration"), F.floor(r(4) * 4).cast("double").alias("asr_confidence"))
    return rows.withColumn("wer", 0.5 - 0.01 * F.col("snr_db") + 0.02 * F.col("duration") * F.col("asr_confidence") + 0.001 * F.col("rms_db") + r(5) / 10)


def test_cells_give_the_trees_of_the_rows(spark, tmp, monkeypatch):
    df, seen = table(spark), []
    plain = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, rows: seen.append(rows.count()) or plain(self, rows))
    by_rows, by_cells = ML.fit(df, CFG, rows_at_most=4000), ML.fit(df, CFG)
    assert seen[0] == 4000 and seen[1] <= 6 ** 4
    a, b = ([r.prediction for r in ML.predict(m, df, CFG).orderBy("path").collect()] for m in (by_rows, by_cells))
    assert b == pytest.approx(a, abs=1e-9)
    assert by_cells.stages[-1].featureImportances.toArray() == pytest.approx(by_rows.stages[-1].featureImportances.toArray(), abs=1e-9)
    assert ML.predict(by_cells, df, CFG).columns == ML.predict(by_rows, df, CFG).columns
    holes = df.limit(50).withColumn("snr_db", F.lit(None).cast("double")).withColumn("duration", F.lit(math.nan))
    a, b = ([r.prediction for r in ML.predict(m, holes, CFG).orderBy("path").collect()] for m in (by_rows, by_cells))
    assert b == pytest.approx(a, abs=1e-9)
    by_cells.write().save(f"{tmp}/model")
    assert [r.prediction for r in ML.predict(load_model(spark, f"{tmp}/model"), holes, CFG).orderBy("path").collect()] == b


def test_edges_from_counts_and_from_quantiles(spark):
    df = table(spark)
    exact = ML.bin_edges(df, "duration", 4000, 6)
    ranged = ML.bin_edges(df, "duration", 4000, 6, marks=100)
    sizes = [df.where((F.col("duration") > a) & (F.col("duration") <= b)).count() for a, b in zip([-math.inf, *ranged], [*ranged, math.inf])]
    assert len(exact) == len(ranged) == 5 and all(abs(s - 4000 / 6) <= 2 * 4000 / 100 for s in sizes)
    assert ranged == pytest.approx(exact, rel=0.03)
    heavy = df.withColumn("x", F.when(F.col("id") < 9, -math.inf).when(F.col("id") > 3900, math.inf).otherwise(0.0))
    assert ML.bin_edges(heavy, "x", 4000, 6) == [-math.inf]
    assert ML.bin_edges(df.withColumn("x", F.lit(1.0)), "x", 4000, 6) == []
