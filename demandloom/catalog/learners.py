"""Queries that fit Spark ML learners."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from demandloom.catalog.registry import query
from demandloom.catalog.tables import panel
from demandloom.config import METRICS, CvConfig, FeatureConfig
from demandloom.operators import evaluate, features, learn, metrics, select, split
from demandloom.plans import flows
from demandloom.plans.tables import durable

CONFIG = FeatureConfig()
FEATURES = [
    "month", "dayofweek", "is_weekend", "is_holiday", "dayofweek_sin", "dayofweek_cos",
    *[f"sales_lag_{k}" for k in CONFIG.lags],
    *[f"sales_shifted_{w}_{s}" for w in CONFIG.windows for s in CONFIG.stats],
]


def training_rows(spark, folder):
    """Every row of the panel with the configured leak-free features, split by time; computed once.

    The first rows of a series have null features, which the learners fill.
    """
    rows = features.cyclical_features(features.date_features(panel(spark, folder)))
    rows = features.lag_features(rows, lags=CONFIG.lags)
    rows = features.rolling_features(rows, windows=CONFIG.windows, stats=CONFIG.stats, shift=1)
    rows = rows.withColumnsRenamed(
        {f"sales_rolling_{w}_{s}": f"sales_shifted_{w}_{s}" for w in CONFIG.windows for s in CONFIG.stats}
    )
    return durable(split.chronological_split(rows))


def fitted(rows, params=learn.PRESETS["xgboost"]):
    seen = rows.where("split <> 'test'")
    marked = seen.selectExpr("*", "split = 'val' AS is_validation")
    return learn.boosted_trees(marked, FEATURES, params=params)


@query("gbt_forecast", "date:d store_id:s sales:2 prediction:2")
def gbt_forecast(spark, folder):
    rows = training_rows(spark, folder)
    return learn.predict(fitted(rows), rows.where("split = 'test'"))


@query("feature_importance", "model:s rank:i feature:s importance:4")
def feature_importance(spark, folder):
    rows = training_rows(spark, folder)
    tables = [
        learn.importances(fitted(rows, params), FEATURES, rows, name)
        for name, params in learn.PRESETS.items()
    ]
    return select.top_features(reduce(DataFrame.unionByName, tables), len(FEATURES))


@query("feature_selection", "feature:s importance:4")
def feature_selection(spark, folder):
    rows = training_rows(spark, folder).where("split = 'train'")
    return learn.select_features(rows, FEATURES)


@query("training_holdout", "model:s " + " ".join(f"{m}:4" for m in METRICS))
def training_holdout(spark, folder):
    """Boosted and classical members and their ensemble on the test rows."""
    members = flows.scored_members(training_rows(spark, folder), FEATURES)
    return metrics.forecast_metrics(metrics.predicted_only(flows.with_ensemble(durable(members))))


@query("boosted_cv", "model:s fold_id:i rmse:4 mae:4 bias:4")
def boosted_cv(spark, folder):
    rows = training_rows(spark, folder).where("split <> 'test'")
    scores = evaluate.learner_fold_scores(rows, FEATURES, CvConfig(), learn.PRESETS)
    return evaluate.fold_metrics(scores, ["model", "fold_id"])
