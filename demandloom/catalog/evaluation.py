"""Metric, fold, horizon, residual and forecast queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.registry import query
from demandloom.catalog.tables import (
    METRICS_SQL,
    MODELS,
    PANEL,
    SCORED,
    daily,
    panel,
    scored,
)
from demandloom.catalog.validation import NUMBERED, parts
from demandloom.config import METRICS, CvConfig, HorizonConfig, MonitoringConfig
from demandloom.operators import evaluate, forecast, metrics

SIX = " ".join(f"{m}:4" for m in METRICS)


@query("forecast_metrics", f"model:s {SIX}", f"{SCORED}, {MODELS} => SELECT * FROM models")
def forecast_metrics(spark, folder):
    return metrics.forecast_metrics(scored(spark, folder))


@query("store_metrics", f"model:s store_id:s {SIX}",
       f"{SCORED} => SELECT model, store_id, {METRICS_SQL} FROM scored GROUP BY 1, 2")
def store_metrics(spark, folder):
    return metrics.forecast_metrics(scored(spark, folder), ["model", "store_id"])


@query("metric_alerts", "model:s metric:s value:4 limit:2",
       f"""{SCORED}, {MODELS} =>
       SELECT model, 'rmse' AS metric, rmse AS value, 1000.0 AS "limit" FROM models WHERE rmse > 1000
       UNION ALL SELECT model, 'mape', mape, 0.2 FROM models WHERE mape > 0.2""")
def metric_alerts(spark, folder):
    limits = MonitoringConfig()
    return metrics.metric_alerts(
        metrics.forecast_metrics(scored(spark, folder)),
        {"rmse": limits.alert_rmse, "mape": limits.alert_mape},
    )


@query("seasonal_naive", "store_id:s date:d step:i prediction:2",
       f"""{PANEL},
       last AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS back
                FROM panel),
       ends AS (SELECT store_id, max(date) AS final FROM panel GROUP BY 1),
       steps AS (SELECT unnest(range(1, 31)) AS step) =>
       SELECT store_id, final + CAST(step AS INTEGER) AS date, step, sales AS prediction
       FROM ends JOIN last USING (store_id) JOIN steps ON 7 - back = (step - 1) % 7
       WHERE back <= 7""")
def seasonal_naive(spark, folder):
    return forecast.seasonal_naive(panel(spark, folder), 30)


def _folds_sql(horizon: int, splits: int = 5) -> str:
    span = horizon * splits
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date) - 1 AS position,
                    count(*) OVER (PARTITION BY store_id) AS n FROM series),
origins AS (SELECT DISTINCT store_id, n, unnest(range(0, {splits})) AS i
            FROM (SELECT DISTINCT store_id, n FROM numbered)),
placed AS (SELECT store_id, i, n - {horizon} - ({splits - 1} - i) * {horizon} AS train_end, n
           FROM origins),
folds AS (SELECT store_id, train_end,
                 row_number() OVER (PARTITION BY store_id ORDER BY i) - 1 AS fold_id
          FROM placed
          WHERE train_end >= greatest({2 * horizon}, n - {span},
                                      CAST(floor(n * 0.4::DOUBLE) AS BIGINT))),
scores AS (
  SELECT t.store_id, 'seasonal_naive' AS model, f.fold_id, f.train_end,
         t.position - f.train_end + 1 AS step, t.date, t.sales AS actual, p.sales AS prediction
  FROM folds f
  JOIN numbered t ON t.store_id = f.store_id AND t.position >= f.train_end
                 AND t.position < f.train_end + {horizon}
  JOIN numbered p ON p.store_id = f.store_id
                 AND p.position = f.train_end - 7 + (t.position - f.train_end) % 7
  WHERE f.train_end >= 7)"""


STORE_SERIES = f"{PANEL}, series AS (SELECT * FROM panel)"
DAY_SERIES = f"""{PANEL},
series AS (SELECT 'all' AS store_id, date, sum(sales) AS sales FROM panel GROUP BY date)"""


@query("naive_fold_scores",
       "store_id:s model:s fold_id:i train_end:i step:i date:d actual:2 prediction:2",
       f"{STORE_SERIES}, {_folds_sql(30)} => SELECT * FROM scores")
def naive_fold_scores(spark, folder):
    return evaluate.naive_fold_scores(panel(spark, folder), CvConfig())


@query("cv_fold_metrics", f"store_id:s model:s fold_id:i {SIX}",
       f"""{STORE_SERIES}, {_folds_sql(30)} =>
       SELECT store_id, model, fold_id, {METRICS_SQL} FROM scores GROUP BY 1, 2, 3""")
def cv_fold_metrics(spark, folder):
    return evaluate.fold_metrics(evaluate.naive_fold_scores(panel(spark, folder), CvConfig()))


AGG = [(m, s) for m in METRICS for s in ("mean", "std", "min", "max")]
AGG_SQL = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}


@query("cv_aggregate", "store_id:s model:s n_folds:i " + " ".join(f"{m}_{s}:4" for m, s in AGG),
       f"""{STORE_SERIES}, {_folds_sql(30)},
       per_fold AS (SELECT store_id, model, fold_id, {METRICS_SQL} FROM scores GROUP BY 1, 2, 3) =>
       SELECT store_id, model, count(*) AS n_folds,
       {", ".join(f"{AGG_SQL[s]}({m}) AS {m}_{s}" for m, s in AGG)}
       FROM per_fold GROUP BY 1, 2""")
def cv_aggregate(spark, folder):
    return evaluate.cross_validate(evaluate.naive_fold_scores(panel(spark, folder), CvConfig(), unfolded=True))


@query("cv_panel_rows", f"model:s fold_id:i {SIX}",
       f"""{PANEL}, series AS (SELECT 'all' AS store_id, sales,
                               date + INTERVAL (row_number() OVER (PARTITION BY date
                                 ORDER BY store_id)) SECOND AS date FROM panel),
       {_folds_sql(30)} =>
       SELECT model, fold_id, {METRICS_SQL} FROM scores GROUP BY 1, 2""")
def cv_panel_rows(spark, folder):
    scores = evaluate.panel_row_naive_scores(panel(spark, folder), CvConfig())
    return evaluate.fold_metrics(scores, ["model", "fold_id"])


HORIZON = (
    "n_folds:i rmse:2 mae:2 wape:4 mape:4 bias:2 rmse_std:2 mae_std:2 wape_std:4 bias_std:2"
)
HORIZON_SQL = f"""
prefixes AS (SELECT s.*, h AS horizon FROM scores s, (SELECT unnest([1, 3, 7, 14]) AS h)
             WHERE step <= h),
per_fold AS (SELECT store_id, model, fold_id, horizon, {METRICS_SQL} FROM prefixes
             GROUP BY 1, 2, 3, 4)"""
HORIZON_MEANS = """
count(*) AS n_folds, avg(rmse) AS rmse, avg(mae) AS mae, avg(wape) AS wape, avg(mape) AS mape,
avg(bias) AS bias, stddev_pop(rmse) AS rmse_std, stddev_pop(mae) AS mae_std,
stddev_pop(wape) AS wape_std, stddev_pop(bias) AS bias_std"""


def day_scores(spark, folder):
    return evaluate.naive_fold_scores(daily(spark, folder), HorizonConfig(), keys=[], unfolded=True)


@query("multi_horizon", f"model:s horizon:i {HORIZON}",
       f"""{DAY_SERIES}, {_folds_sql(14)}, {HORIZON_SQL} =>
       SELECT model, horizon, {HORIZON_MEANS} FROM per_fold GROUP BY 1, 2""")
def multi_horizon(spark, folder):
    return evaluate.multi_horizon(day_scores(spark, folder))


@query("multi_horizon_stores", f"store_id:s model:s horizon:i {HORIZON}",
       f"""{STORE_SERIES}, {_folds_sql(14)}, {HORIZON_SQL} =>
       SELECT store_id, model, horizon, {HORIZON_MEANS} FROM per_fold GROUP BY 1, 2, 3""")
def multi_horizon_stores(spark, folder):
    scores = evaluate.naive_fold_scores(panel(spark, folder), HorizonConfig(), unfolded=True)
    return evaluate.multi_horizon(scores, keys=["store_id"])


@query("prediction_diagnostics",
       "model:s pred_mean:2 pred_std:2 extreme_low_count:i extreme_high_count:i residual_mean:2"
       " residual_std:2 mape:4 wape:4 bias:2",
       f"""{SCORED}, {MODELS}, ends AS (SELECT min(actual) AS low, max(actual) AS high FROM scored),
       spread AS (SELECT model, avg(prediction) AS pred_mean, stddev_pop(prediction) AS pred_std,
           count(*) FILTER (WHERE prediction < low * 0.5) AS extreme_low_count,
           count(*) FILTER (WHERE prediction > high * 1.5) AS extreme_high_count,
           avg(actual - prediction) AS residual_mean,
           stddev_samp(actual - prediction) AS residual_std FROM scored, ends GROUP BY model) =>
       SELECT spread.*, mape, wape, bias FROM spread JOIN models USING (model)""")
def prediction_diagnostics(spark, folder):
    return metrics.prediction_diagnostics(scored(spark, folder))


@query("error_histogram", "model:s bin:i left:2 right:2 n:i",
       f"""{SCORED}, errors AS (SELECT model, prediction - actual AS e FROM scored),
       ends AS (SELECT model, min(e) AS a, (max(e) - min(e)) / 50 AS w FROM errors GROUP BY 1),
       binned AS (SELECT model, a, w, least(49, CAST(floor((e - a) / w) AS BIGINT)) AS bin
                  FROM errors JOIN ends USING (model)) =>
       SELECT model, bin, a + bin * w AS left, a + (bin + 1) * w AS right, count(*) AS n
       FROM binned GROUP BY model, a, w, bin""")
def error_histogram(spark, folder):
    return metrics.error_histogram(scored(spark, folder), F.col("prediction") - F.col("actual"))


@query("residual_boxplot",
       "model:s q1:4 median:4 q3:4 whisker_low:4 whisker_high:4 n_outliers:i",
       f"""{SCORED}, r AS (SELECT model, actual - prediction AS residual FROM scored),
       q AS (SELECT model, quantile_cont(residual, 0.25) AS q1, median(residual) AS median,
                    quantile_cont(residual, 0.75) AS q3 FROM r GROUP BY 1),
       t AS (SELECT *, residual BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
             FROM r JOIN q USING (model)) =>
       SELECT model, q1, median, q3, min(residual) FILTER (WHERE inside) AS whisker_low,
              max(residual) FILTER (WHERE inside) AS whisker_high,
              count(*) FILTER (WHERE NOT inside) AS n_outliers FROM t GROUP BY 1, 2, 3, 4""")
def residual_boxplot(spark, folder):
    return metrics.residual_box(scored(spark, folder))


def _ratio_sql(x: str, pair) -> str:
    return " / ".join("(" + " + ".join(f"{c!r}::DOUBLE * ({x}) ** {i}" for i, c in enumerate(p)) + ")" for p in pair)


ROOT_SQL = "sqrt(-ln(least(share, 1 - share)))"
QUANTILE_SQL = f"""
CASE WHEN abs(share - 0.5::DOUBLE) <= 0.425::DOUBLE
     THEN (share - 0.5::DOUBLE) * {_ratio_sql("(0.180625::DOUBLE - (share - 0.5::DOUBLE) ** 2)", metrics.QUANTILE_CENTRE)}
     WHEN {ROOT_SQL} <= 5
     THEN sign(share - 0.5::DOUBLE) * {_ratio_sql(f"({ROOT_SQL} - 1.6::DOUBLE)", metrics.QUANTILE_FLANK)}
     ELSE sign(share - 0.5::DOUBLE) * {_ratio_sql(f"({ROOT_SQL} - 5.0::DOUBLE)", metrics.QUANTILE_TAIL)} END"""


@query("qq_points", "model:s theoretical:6 ordered:2",
       f"""{SCORED}, ranked AS (SELECT model, actual - prediction AS ordered,
              row_number() OVER (PARTITION BY model ORDER BY actual - prediction) AS i,
              count(*) OVER (PARTITION BY model) AS n FROM scored),
       shares AS (SELECT *, CASE WHEN i = n THEN 0.5::DOUBLE ** (1.0::DOUBLE / n)
              WHEN i = 1 THEN 1 - 0.5::DOUBLE ** (1.0::DOUBLE / n)
              ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS share FROM ranked) =>
       SELECT model, {QUANTILE_SQL} AS theoretical, ordered FROM shares""")
def qq_points(spark, folder):
    return metrics.qq_points(scored(spark, folder))


CLASSICAL = {"seasonal_naive": {}, "holt_winters": {}, "sarimax": {}}


@query("classical_cv", "store_id:s model:s n_folds:i rmse_mean:4 mae_mean:4 wape_mean:4 error:s")
def classical_cv(spark, folder):
    scores = evaluate.classical_fold_scores(panel(spark, folder), CvConfig(), CLASSICAL)
    return evaluate.cross_validate(scores)


@query("classical_naive_cv", f"store_id:s model:s fold_id:i {SIX}",
       f"""{STORE_SERIES}, {_folds_sql(30)} =>
       SELECT store_id, model, fold_id, {METRICS_SQL} FROM scores GROUP BY 1, 2, 3""")
def classical_naive_cv(spark, folder):
    models = {"seasonal_naive": {}}
    scores = evaluate.classical_fold_scores(panel(spark, folder), CvConfig(), models)
    return evaluate.fold_metrics(scores)


@query("holt_winters", "store_id:s date:d step:i prediction:4")
def holt_winters(spark, folder):
    return forecast.forecast_ahead(panel(spark, folder), 30, {"holt_winters": {}})


@query("sarima", "store_id:s date:d step:i prediction:4")
def sarima(spark, folder):
    return forecast.forecast_ahead(panel(spark, folder), 30, {"sarimax": {}})


@query("holdout_naive", f"stage:s store_id:s {SIX}",
       f"""{NUMBERED},
       placed AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date) - 1 AS place
                  FROM parts),
       sizes AS (SELECT store_id, count(*) FILTER (WHERE split = 'train') AS n_train,
                        count(*) FILTER (WHERE split = 'val') AS n_val FROM parts GROUP BY 1),
       stages AS (SELECT store_id, 'val' AS stage, n_train AS train_end FROM sizes
                  UNION ALL SELECT store_id, 'test', n_train + n_val FROM sizes),
       scores AS (SELECT t.store_id, stage, t.sales AS actual, p.sales AS prediction
                  FROM placed t JOIN stages s ON s.store_id = t.store_id AND s.stage = t.split
                  JOIN placed p ON p.store_id = t.store_id
                   AND p.place = train_end - 7 + (t.place - train_end) % 7) =>
       SELECT stage, store_id, {METRICS_SQL} FROM scores GROUP BY 1, 2""")
def holdout_naive(spark, folder):
    scores = evaluate.holdout_scores(parts(spark, folder), {"seasonal_naive": {}})
    return metrics.forecast_metrics(scores, ["stage", "store_id"])
