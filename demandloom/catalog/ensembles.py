"""Ensemble queries."""

from __future__ import annotations

from demandloom.catalog.registry import query
from demandloom.catalog.tables import METRICS_SQL, MODELS, SCORED_ALL, scored
from demandloom.config import METRICS
from demandloom.operators import ensemble, metrics

KEYS = ["date", "store_id"]
MEMBERS = ["naive_7", "naive_1", "mean_7"]
EARLY = "date < DATE '2000-01-01'"

WEIGHTS = f"""
shifted AS (SELECT model, r2, greatest(0, r2) + 1e-6 AS s FROM models),
floored AS (SELECT model, r2, greatest(0.05::DOUBLE, s / sum(s) OVER ()) AS w FROM shifted),
weights AS (SELECT model, r2, w / sum(w) OVER () AS weight FROM floored)"""


def every(spark, folder):
    """The scored rows, those that lack a member too: the first days of a series."""
    return scored(spark, folder, complete=False)


def weights(spark, folder):
    return ensemble.score_weights(every(spark, folder))


@query("ensemble_weights", "model:s r2:6 weight:6", f"{SCORED_ALL}, {MODELS}, {WEIGHTS} => SELECT * FROM weights")
def ensemble_weights(spark, folder):
    return weights(spark, folder)


@query("ensemble_deployable", "model:s weight:6",
       f"""{SCORED_ALL}, {MODELS}, {WEIGHTS} =>
       SELECT model, weight / sum(weight) OVER () AS weight FROM weights
       WHERE model IN ('naive_7', 'mean_7')""")
def ensemble_deployable(spark, folder):
    return ensemble.deployable_weights(weights(spark, folder), ["naive_7", "mean_7"])


@query("ensemble_predict", "date:d store_id:s actual:2 prediction:2",
       f"""{SCORED_ALL}, {MODELS}, {WEIGHTS} =>
       SELECT date, store_id, max(actual) AS actual,
              sum(weight * prediction) / sum(weight) AS prediction
       FROM scored JOIN weights USING (model) WHERE prediction IS NOT NULL GROUP BY 1, 2""")
def ensemble_predict(spark, folder):
    return ensemble.weighted_prediction(every(spark, folder), KEYS, weights(spark, folder))


@query("ensemble_mean", "date:d store_id:s prediction:2",
       f"{SCORED_ALL} => SELECT date, store_id, avg(prediction) AS prediction FROM scored GROUP BY 1, 2")
def ensemble_mean(spark, folder):
    return ensemble.mean_prediction(every(spark, folder), KEYS)


@query("ensemble_metrics", " ".join(f"{m}:4" for m in METRICS),
       f"""{SCORED_ALL}, means AS (SELECT date, store_id, max(actual) AS actual,
              avg(prediction) AS prediction FROM scored WHERE prediction IS NOT NULL GROUP BY 1, 2) =>
       SELECT {METRICS_SQL} FROM means""")
def ensemble_metrics(spark, folder):
    mean = ensemble.weighted_prediction(every(spark, folder), KEYS)
    return metrics.forecast_metrics(mean, [])


@query("ensemble_dynamic", "date:d store_id:s actual:2 prediction:2",
       f"""{SCORED_ALL}, near AS (SELECT *,
              count(prediction) OVER w AS n, avg(abs(prediction - actual)) OVER w AS local_error FROM scored
              WINDOW w AS (PARTITION BY store_id, model ORDER BY date
                           ROWS BETWEEN 30 PRECEDING AND 29 FOLLOWING)),
       weighted AS (SELECT *, CASE WHEN n < 10 THEN 1.0 ELSE 1.0 / (local_error + 1e-6) END AS w
                    FROM near) =>
       SELECT date, store_id, max(actual) AS actual, sum(w * prediction) / sum(w) FILTER (WHERE prediction IS NOT NULL)
                AS prediction
       FROM weighted GROUP BY 1, 2""")
def ensemble_dynamic(spark, folder):
    return ensemble.dynamic_prediction(every(spark, folder))


@query("blend_weights", "model:s weight:4 n_left_out:i")
def blend_weights(spark, folder):
    return ensemble.blend_weights(every(spark, folder), KEYS, MEMBERS, "rmse")


@query("blend_weights_mae", "model:s weight:4 n_left_out:i")
def blend_weights_mae(spark, folder):
    return ensemble.blend_weights(every(spark, folder), KEYS, MEMBERS, "mae")


def _stacked(spark, folder, meta):
    rows = every(spark, folder)
    fit, use = rows.where(EARLY), rows.where(f"NOT ({EARLY})")
    return ensemble.stacked_prediction(fit, use, KEYS, MEMBERS, meta)


@query("stacking", "date:d store_id:s actual:2 prediction:2 error:s")
def stacking(spark, folder):
    return _stacked(spark, folder, "ridge")


@query("stacking_lasso", "date:d store_id:s actual:2 prediction:2 error:s")
def stacking_lasso(spark, folder):
    return _stacked(spark, folder, "lasso")
