"""Boosted-tree WER model: fit, evaluate, diagnostics, batch scoring."""

from __future__ import annotations

import logging
import math

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transcript_quality.config import GBTConfig, ScoringConfig, TrainingConfig
from transcript_quality.operators import stats
from transcript_quality.operators.monitoring import flag_for_review
from transcript_quality.operators.partitioning import spread
from transcript_quality.schemas import SCORED

log = logging.getLogger(__name__)


def gbt_pipeline(cfg: TrainingConfig = TrainingConfig(), gbt: GBTConfig | None = None) -> Pipeline:
    """ML-1: feature vector in configured order -> GBT regressor."""
    g = gbt or cfg.gbt
    # rows with a missing feature are kept (NaN in the vector); training rows are complete, and score() answers
    # incomplete ones without a prediction
    assembler = VectorAssembler(inputCols=list(cfg.feature_columns), outputCol="features", handleInvalid="keep")
    reg = GBTRegressor(featuresCol="features", labelCol=cfg.target_column, predictionCol="prediction",
                       maxIter=g.n_estimators, maxDepth=g.max_depth, stepSize=g.learning_rate,
                       seed=g.seed, maxBins=g.max_bins)
    return Pipeline(stages=[assembler, reg])


def _as_double(df: DataFrame, cfg: TrainingConfig) -> DataFrame:
    cols = [*cfg.feature_columns, cfg.target_column]
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.col(c).cast("double").alias(c) for c in cols if c in df.columns])


def fit(train_df: DataFrame, cfg: TrainingConfig = TrainingConfig(), rows_at_most: int | None = None) -> PipelineModel:
    """Boosted trees read their input several times (split finding, binning); the projected
    training rows are persisted for the fit so the scan and split run once.

    Trees split at the edges of ``max_bins`` bins a feature, so rows in the same bins of all features (a cell) go the same way in every tree.
    If there are more rows than cells can be (``rows_at_most``: ``max_bins`` to the power of the number of features), all rows are therefore
    counted by cell, and the trees are grown on the cells, weighted by their rows, with the mean target: gains, leaf values and importances
    are those of the rows, as the spread of the target inside a cell is the same on both sides of a gain.  The passes of a fit then read
    a bounded number of cells, whatever the number of rows."""
    cols = [*cfg.feature_columns, cfg.target_column]
    rows = spread(_as_double(train_df.select(*cols), cfg)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        most = cfg.gbt.max_bins ** len(cfg.feature_columns) if rows_at_most is None else rows_at_most
        return _fit_cells(rows, n, cfg) if n > most else gbt_pipeline(cfg).fit(rows)
    finally:
        rows.unpersist()


def _bins(cfg: TrainingConfig) -> list[str]:
    return [f"_bin_{c}" for c in cfg.feature_columns]


def _fit_cells(rows: DataFrame, n: int, cfg: TrainingConfig) -> PipelineModel:
    """The model of the cells: features -> numbers of their bins -> trees that split between any two bins."""
    feats, bins = list(cfg.feature_columns), _bins(cfg)
    # a value at an edge belongs below it, as in a tree; Bucketizer puts it above, so its edges are the next larger numbers
    splits = [[-math.inf, *[math.nextafter(e, math.inf) for e in bin_edges(rows, c, n, cfg.gbt.max_bins)], math.inf] for c in feats]
    dealt = Bucketizer(inputCols=feats, outputCols=bins, splitsArray=splits, handleInvalid="keep")
    # the sum drops Bucketizer's note that a bin is a category: bins are ordered numbers here
    cells = dealt.transform(rows).groupBy(*[(F.col(b) + 0.0).alias(b) for b in bins]).agg(F.avg(cfg.target_column).alias(cfg.target_column), F.count(F.lit(1)).cast("double").alias("_rows"))
    cells = spread(cells).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        assembler, reg = gbt_pipeline(cfg).getStages()
        assembler = assembler.setInputCols(bins)
        # with the square of maxBins above the number of cells Spark finds the bins' numbers in all cells and not in some of them
        reg = reg.setWeightCol("_rows").setMaxBins(max(cfg.gbt.max_bins, math.isqrt(cells.count()) + 1))
        return PipelineModel(stages=[dealt, assembler, reg.fit(assembler.transform(cells))])
    finally:
        cells.unpersist()


def bin_edges(rows: DataFrame, col: str, n: int, max_bins: int, marks: int = 10_000) -> list[float]:
    """The edges of ``max_bins`` bins at most of about as many of the n rows each, chosen as Spark's trees choose theirs: between any two values where
    there are so few, else the nearest cuts to each multiple of n / max_bins.

    All rows count.  The values come with their counts, where they are more than about ``marks`` in ranges between ``marks`` quantiles with the rows counted in
    each; that much reaches the driver, whatever the table."""
    if rows.agg(F.approx_count_distinct(col)).first()[0] <= marks:
        points = sorted(map(tuple, rows.groupBy(col).count().collect()))
        cuts = [(a + b) / 2.0 for (a, _), (b, _) in zip(points, points[1:])]
    else:
        tops = sorted(set(rows.agg(F.percentile_approx(col, [k / marks for k in range(1, marks + 1)], 10 * marks)).first()[0]))
        ranges = Bucketizer(inputCol=col, outputCol="_range", splits=[-math.inf, *[math.nextafter(t, math.inf) for t in tops[:-1]], math.inf])
        points = sorted(map(tuple, ranges.transform(rows.select(col)).groupBy("_range").count().collect()))
        cuts = [tops[int(k)] for k, _ in points[:-1]]
    if len(points) > max_bins:
        near, target, upto = [], n / max_bins, points[0][1]
        for cut, (_, c) in zip(cuts, points[1:], strict=True):
            if abs(upto - target) < abs(upto + c - target):
                near.append(cut)
                target += n / max_bins
            upto += c
        cuts = near
    return sorted({c for c in cuts if c < math.inf})  # neither NaN nor infinite: nothing lies above that


def predict(model: PipelineModel, df: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    return model.transform(_as_double(df, cfg)).drop("features", *_bins(cfg))


def metrics(pred: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> dict:
    """ML-3: spearman rho, p-value and RMSE of predictions (one pass for RMSE, one distributed
    rank correlation)."""
    pairs = pred.select(cfg.target_column, "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rho, n = stats.spearman_rho(pairs, cfg.target_column, "prediction")
        rmse = stats.error_stats(pairs, cfg.target_column, "prediction").first()["rmse"]
    finally:
        pairs.unpersist()
    return {"spearman_rho": rho, "spearman_p_value": stats.spearman_p_value(rho, n),
            "rmse": rmse, "num_samples": n}


def evaluate(model: PipelineModel | None, df: DataFrame, cfg: TrainingConfig = TrainingConfig(), with_diagnostics: bool = False) -> dict:
    """ML-3: the metrics of a model on labelled rows; with ``with_diagnostics`` also the report of :func:`diagnostics` over the same predictions, as
    a DataFrame under ``diagnostics`` (its source rows stay persisted, as there)."""
    if model is None:
        raise RuntimeError("No model loaded to evaluate.")
    pred = predict(model, df, cfg)
    if with_diagnostics:
        pred = pred.persist(StorageLevel.MEMORY_AND_DISK)
    m = metrics(pred, cfg)
    if with_diagnostics:
        m["diagnostics"] = _report(model, pred, cfg, "test")
    if m["spearman_rho"] < cfg.min_spearman_rho:
        log.warning("Model performance below threshold: Spearman Rho = %.4f (threshold: %s)",
                    m["spearman_rho"], cfg.min_spearman_rho)
    return m


def feature_importance(model: PipelineModel, names=None) -> DataFrame:
    """SRT-2: importances sorted descending; names fall back to feature_i on a count mismatch."""
    reg = model.stages[-1]
    imp = reg.featureImportances.toArray().tolist()
    if names is None or len(list(names)) != len(imp):
        names = [f"feature_{i}" for i in range(len(imp))]
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(list(names), imp)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def diagnostics(model: PipelineModel, df: DataFrame, cfg: TrainingConfig = TrainingConfig(),
                split_label: str = "test") -> DataFrame:
    """ML-7: long report (section, name, metric, value) built from a handful of aggregates.  The predictions are
    persisted for them (memory, spilling to disk), so the model runs once."""
    return _report(model, predict(model, df, cfg).persist(StorageLevel.MEMORY_AND_DISK), cfg, split_label)


def _report(model: PipelineModel, pred: DataFrame, cfg: TrainingConfig, split_label: str) -> DataFrame:
    feats = list(cfg.feature_columns)
    fs = stats.feature_stats(pred, feats)
    corr = stats.feature_target_corr(pred, feats, cfg.target_column)
    ps = stats.prediction_stats(pred, cfg.target_column, "prediction")
    es = stats.error_stats(pred, cfg.target_column, "prediction")
    imp = feature_importance(model, feats)
    parts = [
        imp.select(F.lit("importance").alias("section"), F.col("feature").alias("name"),
                   F.lit("importance").alias("metric"), F.col("importance").alias("value")),
        fs.selectExpr("'feature_stats' AS section", "feature AS name",
                      "stack(4, 'mean', mean, 'std', std, 'min', min, 'max', max) AS (metric, value)"),
        corr.selectExpr("'feature_target_corr' AS section", "feature AS name", "'corr' AS metric",
                        "corr AS value"),
        ps.selectExpr("'prediction_stats' AS section", "series AS name",
                      "stack(4, 'mean', mean, 'std', std, 'min', min, 'max', max) AS (metric, value)"),
        es.selectExpr("'error_stats' AS section", "'error' AS name",
                      "stack(2, 'mae', mae, 'rmse', rmse) AS (metric, value)"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("split", F.lit(split_label))


def score(model: PipelineModel, df: DataFrame, cfg: TrainingConfig = TrainingConfig(),
          scoring: ScoringConfig = ScoringConfig()) -> DataFrame:
    """ML-6: predicted WER, review flag and status for feature rows (batch or streaming DataFrame).  Every row is answered: a
    row with a missing feature (a file that failed) gets status 500, no prediction and no flag, the others 200."""
    ok = F.lit(True)
    for c in cfg.feature_columns:
        x = F.col(c).cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(F.coalesce(x, F.lit(0.0)))
    pred = predict(model, df.withColumn("status", F.when(ok, 200).otherwise(500)), cfg)
    pred = pred.withColumn("predicted_wer", F.when(F.col("status") == 200, F.col("prediction"))).drop("prediction")
    return flag_for_review(pred, scoring.review_threshold)


def scored_rows(scored: DataFrame, ts: str | None = None) -> DataFrame:
    """SCORED rows of scored features: ``ts`` names a timestamp column (default: the time of scoring); a missing transcript is
    NULL."""
    have = set(scored.columns)
    at = F.col(ts).cast("timestamp") if ts else F.current_timestamp()
    cols = {"ts": at, "transcript": F.col("transcript") if "transcript" in have else F.lit(None)}
    return scored.select(*[cols.get(f.name, F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in SCORED.fields])
