"""Global machine-learning forecasters on the feature panel (N01-N10) with ``pyspark.ml``.

One model is fitted on all series at once; estimators are Spark's distributed ones
(normal equations / L-BFGS / OWL-QN for linear models, distributed tree induction for
trees and ensembles), so neither the panel nor a series is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators import metrics
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y


def estimators(seed: int = 0) -> dict:
    """The model zoo, keyed by the names used in forecast tables."""
    return {
        "LinearRegression": LinearRegression(solver="normal", regParam=0.0),
        "Ridge": LinearRegression(regParam=0.01, elasticNetParam=0.0),
        "Lasso": LinearRegression(regParam=0.01, elasticNetParam=1.0),
        "ElasticNet": LinearRegression(regParam=0.01, elasticNetParam=0.5),
        "DecisionTree": DecisionTreeRegressor(maxDepth=6, seed=seed),
        "Bagging": RandomForestRegressor(numTrees=20, featureSubsetStrategy="all", maxDepth=6, seed=seed),
        "RandomForest": RandomForestRegressor(numTrees=20, featureSubsetStrategy="onethird", maxDepth=6, seed=seed),
        "GBM": GBTRegressor(maxIter=30, maxDepth=4, stepSize=0.1, seed=seed),
    }


def pipeline(features: Sequence[str], estimator, id_dummies: bool = False, id_col: str = ID) -> Pipeline:
    """Feature vector (plus one-hot series id for a global model, N09) -> estimator."""
    stages = []
    cols = list(features)
    if id_dummies:
        stages += [StringIndexer(inputCol=id_col, outputCol="_id_idx", handleInvalid="keep"),
                   OneHotEncoder(inputCol="_id_idx", outputCol="_id_oh", dropLast=True)]
        cols.append("_id_oh")
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip"))
    stages.append(estimator.copy().setFeaturesCol("features").setLabelCol(Y).setPredictionCol(YHAT))
    return Pipeline(stages=stages)


def fit_predict(train: DataFrame, score: DataFrame, features: Sequence[str], models: Mapping[str, object],
                id_dummies: bool = False) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each model on ``train`` rows with a target and complete features, predict
    ``score``; returns the long forecast table ``(unique_id, ds, model, y_hat)``."""
    clean = train.where(F.col(Y).isNotNull()).dropna(subset=list(features))
    fitted, out = {}, None
    for name, est in models.items():
        pm = pipeline(features, est, id_dummies).fit(clean)
        fitted[name] = pm
        p = pm.transform(score.dropna(subset=list(features))).select(ID, DS, F.lit(name).alias(MODEL), F.col(YHAT).cast("double"))
        out = p if out is None else out.unionByName(p)
    return out, fitted


def coefficients_table(spark, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``(term, estimate)`` for linear models or ``(term, importance)`` for trees."""
    est = model.stages[-1]
    if hasattr(est, "coefficients"):
        rows = [("(intercept)", float(est.intercept))] + [(f, float(c)) for f, c in zip(features, est.coefficients.toArray())]
        return spark.createDataFrame(rows, "term string, estimate double")
    imp = est.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "term string, importance double")


# ---- leaderboards over many candidates (N10) ------------------------------------------

class Candidate(NamedTuple):
    name: str
    algorithm: str
    estimator: object


def candidates(seed: int = 0) -> list[Candidate]:
    """Candidates in the order they are tried: one default per algorithm first, then variants."""
    zoo = estimators(seed)
    out = [Candidate("GLM_1", "GLM", zoo["Ridge"]), Candidate("DRF_1", "DRF", zoo["RandomForest"]), Candidate("GBM_1", "GBM", zoo["GBM"]),
           Candidate("Tree_1", "Tree", zoo["DecisionTree"])]
    out += [Candidate(f"GLM_{i}", "GLM", zoo[n]) for i, n in enumerate(("Lasso", "ElasticNet", "LinearRegression"), 2)]
    out.append(Candidate("DRF_2", "DRF", zoo["Bagging"]))
    out += [Candidate(f"GBM_{i}", "GBM", GBTRegressor(maxIter=n, maxDepth=d, stepSize=s, subsamplingRate=0.8, seed=seed))
            for i, (n, d, s) in enumerate(((20, 3, 0.2), (50, 2, 0.1)), 2)]
    return out


def automl(train: DataFrame, holdout: DataFrame, features: Sequence[str], tried: Sequence[Candidate], max_models: int | None = None,
           include: Sequence[str] = (), exclude: Sequence[str] = (), sort: str = "rmse") -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit the first ``max_models`` candidates of the allowed algorithms and rank them by ``sort`` on the
    ``holdout`` rows: (model, algorithm, metrics, rank, rank_in_algorithm) and the fitted pipelines."""
    chosen = [c for c in tried if (not include or c.algorithm in include) and c.algorithm not in exclude][:max_models]
    if not chosen:
        raise ValueError("no candidate left")
    fc, fitted = fit_predict(train, holdout, features, {c.name: c.estimator for c in chosen})
    scored = metrics.point_metrics(metrics.score_frame(fc, holdout), by=[MODEL])
    algorithm = F.create_map(*[F.lit(x) for c in chosen for x in (c.name, c.algorithm)])
    board = scored.withColumn("algorithm", F.element_at(algorithm, F.col(MODEL)))
    order = F.abs(F.col(sort)) if sort == "bias" else F.col(sort)
    for by, out in (([], "rank"), (["algorithm"], "rank_in_algorithm")):  # one row a model
        board = board.withColumn(out, F.row_number().over(Window.partitionBy(*by or [F.lit(1)]).orderBy(order, MODEL)))
    return board, fitted


def best_model(board: DataFrame, criterion: str = "rmse", algorithm: str | None = None) -> str:
    """Name of the best model of a leaderboard by any of its metrics, of one algorithm if named."""
    rows = board if algorithm is None else board.where(F.col("algorithm") == algorithm)
    first = rows.orderBy(F.abs(F.col(criterion)) if criterion == "bias" else F.col(criterion), MODEL).first()
    if first is None:
        raise ValueError(f"no model of {algorithm}")
    return first[MODEL]
