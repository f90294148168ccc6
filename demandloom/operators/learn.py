"""Feature-based learners on Spark ML: boosted trees, random search, feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import numpy as np
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parameter presets of the two boosted members.
PRESETS: dict[str, dict[str, Any]] = {
    "xgboost": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1},
    "lightgbm": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05},
}

# Fixed values: (low, high) of the searched parameters.
SEARCH_SPACE = {
    "maxIter": (50, 300),
    "maxDepth": (3, 10),
    "stepSize": (0.01, 0.3),
    "subsamplingRate": (0.6, 1.0),
    "featureShare": (0.6, 1.0),
    "minInstancesPerNode": (10, 50),
    "minInfoGain": (0.0, 0.5),
    "maxBins": (32, 128),
}


def boosted_trees(
    rows: DataFrame,
    features: Sequence[str],
    target: str = "sales",
    params: Mapping[str, Any] = PRESETS["xgboost"],
    validation: str | None = "is_validation",
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted regression trees; boosting stops once the validation error stalls.

    Null features take the mean of the fitted rows, in scoring too, so every row gets a prediction.
    """
    learner = GBTRegressor(featuresCol="__x", labelCol=target, seed=seed, **dict(params))
    if validation is not None:
        learner = learner.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*_assembled(features), learner]).fit(rows)


def _assembled(features: Sequence[str]) -> list:
    """Stages from feature columns, nulls filled with means of the fitted rows, to one vector."""
    filled = [f"__filled_{f}" for f in features]
    return [
        Imputer(inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__x", handleInvalid="error"),
    ]


def predict(model: PipelineModel, rows: DataFrame, name: str = "prediction") -> DataFrame:
    scored = model.transform(rows)
    scored = scored.drop("__x", *[c for c in scored.columns if c.startswith("__filled_")])
    return scored if name == "prediction" else scored.withColumnRenamed("prediction", name)


def draw_parameters(trials: int, seed: int = 42) -> list[dict[str, Any]]:
    """Seeded random draws from the search space; the step size is drawn on a log scale."""
    rng = np.random.default_rng(seed)
    drawn = []
    for _ in range(trials):
        point: dict[str, Any] = {}
        for name, (low, high) in SEARCH_SPACE.items():
            if name == "stepSize":
                point[name] = float(np.exp(rng.uniform(np.log(low), np.log(high))))
            elif isinstance(low, int):
                point[name] = int(rng.integers(low, high + 1))
            else:
                point[name] = float(rng.uniform(low, high))
        point["featureSubsetStrategy"] = f"{point.pop('featureShare'):.3f}"
        drawn.append(point)
    return drawn


def search(
    rows: DataFrame,
    features: Sequence[str],
    target: str = "sales",
    candidates: Sequence[Mapping[str, Any]] | None = None,
    trials: int = 50,
    parallelism: int = 4,
    seed: int = 42,
) -> tuple[dict[str, Any], list[tuple[dict[str, Any], float]]]:
    """Parameters with the lowest validation RMSE, and the RMSE of every candidate.

    ``rows`` carries ``is_validation``, set on the latest rows. Candidates are fitted as
    parallel Spark jobs over the same cached rows.
    """
    points = [dict(c) for c in (candidates or draw_parameters(trials, seed))]
    cached = rows.select(*features, target, "is_validation").persist()
    held = cached.where("is_validation")

    def loss(point: dict[str, Any]) -> float:
        model = boosted_trees(cached, features, target, point, "is_validation", seed)
        error = F.col("prediction") - F.col(target)
        return float(predict(model, held).agg(F.sqrt(F.avg(error * error))).first()[0])

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            losses = list(pool.map(loss, points))
    finally:
        cached.unpersist()
    results = sorted(zip(points, losses), key=lambda pair: pair[1])
    return results[0][0], results


def importances(model: PipelineModel, features: Sequence[str], rows: DataFrame, name: str) -> DataFrame:
    """Importance per feature of a fitted tree ensemble: ``model, feature, importance``."""
    weights = model.stages[-1].featureImportances.toArray()
    pairs = [(name, f, float(w)) for f, w in zip(features, weights)]
    return rows.sparkSession.createDataFrame(pairs, "model string, feature string, importance double")


def select_features(
    rows: DataFrame,
    features: Sequence[str],
    target: str = "sales",
    threshold: float = 0.001,
    trees: int = 100,
    depth: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Features whose random-forest importance reaches the threshold."""
    forest = RandomForestRegressor(
        featuresCol="__x", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed
    )
    model = Pipeline(stages=[*_assembled(features), forest]).fit(rows)
    ranked = importances(model, features, rows, "random_forest")
    return ranked.where(F.col("importance") >= threshold).select("feature", "importance")
