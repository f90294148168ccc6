"""Ranking, promotion and metric-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.evaluation import DAY_SERIES, HORIZON_MEANS, HORIZON_SQL, _folds_sql, day_scores
from demandloom.catalog.quality import QUALITY, checks
from demandloom.catalog.registry import query
from demandloom.catalog.tables import METRICS_SQL, MODELS, SCORED, scored, table
from demandloom.config import METRICS
from demandloom.operators import evaluate, metrics, quality, select

SIX = " ".join(f"{m}:4" for m in METRICS)
LATE = "date >= DATE '2000-01-01'"


def model_metrics(spark, folder):
    return metrics.forecast_metrics(scored(spark, folder))


@query("leaderboard", f"rank:i model:s {SIX}",
       f"""{SCORED}, {MODELS} =>
       SELECT row_number() OVER (ORDER BY mae NULLS LAST, rmse NULLS LAST, wape NULLS LAST) AS rank, *
       FROM models""")
def leaderboard(spark, folder):
    return select.leaderboard(model_metrics(spark, folder))


@query("store_leaderboard", "store_id:s rank:i model:s mae:4",
       f"""{SCORED}, m AS (SELECT store_id, model, {METRICS_SQL} FROM scored GROUP BY 1, 2) =>
       SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY mae NULLS LAST) AS rank FROM m""")
def store_leaderboard(spark, folder):
    rows = metrics.forecast_metrics(scored(spark, folder), ["store_id", "model"])
    return select.leaderboard(rows, ["store_id"])


@query("best_by_metric", "metric:s model:s",
       f"""{SCORED}, {MODELS} =>
       SELECT 'mae' AS metric, arg_min(model, mae) AS model FROM models
       UNION ALL SELECT 'rmse', arg_min(model, rmse) FROM models
       UNION ALL SELECT 'wape', arg_min(model, wape) FROM models
       UNION ALL SELECT 'bias', arg_min(model, abs(bias)) FROM models""")
def best_by_metric(spark, folder):
    return select.best_by_metric(model_metrics(spark, folder))


@query("best_model", "model:s rmse:4",
       f"{SCORED}, {MODELS} => SELECT arg_min(model, rmse) AS model, min(rmse) AS rmse FROM models")
def best_model(spark, folder):
    return select.best_model(model_metrics(spark, folder))


COMPARED = f"""{SCORED},
late AS (SELECT * FROM scored WHERE {LATE}),
production AS (SELECT model, {METRICS_SQL} FROM scored WHERE model <> 'naive_1' GROUP BY 1),
candidate AS (SELECT model, {METRICS_SQL} FROM late GROUP BY 1),
old AS (SELECT model, unnest(['rmse', 'mae', 'r2']) AS metric, unnest([rmse, mae, r2]) AS production
        FROM production),
new AS (SELECT model, unnest(['rmse', 'mae', 'r2']) AS metric, unnest([rmse, mae, r2]) AS candidate
        FROM candidate),
gains AS (SELECT model, metric, production, candidate,
                 CASE WHEN metric = 'r2' THEN (candidate - production) / abs(production)
                      ELSE (production - candidate) / production END AS gain,
                 CASE WHEN metric = 'r2' THEN candidate > production ELSE candidate < production END
                   AS better FROM old JOIN new USING (model, metric)),
comparison AS (SELECT model, metric, production, candidate, gain * 100 AS improvement,
                      CAST(better AS INTEGER) AS is_better,
                      CAST(better AND abs(gain) >= 0.01 AS INTEGER) AS improved FROM gains)"""


def compared(spark, folder):
    """Metrics of all rows as production, of the late rows as candidate."""
    rows = scored(spark, folder)
    old = metrics.forecast_metrics(rows.where("model <> 'naive_1'"))
    new = metrics.forecast_metrics(rows.where(LATE))
    production, candidate = select.long_metrics(old), select.long_metrics(new)
    return production, candidate, select.compare_metrics(production, candidate)


@query("metric_comparison",
       "model:s metric:s production:4 candidate:4 improvement:4 is_better:i improved:i",
       f"{COMPARED} => SELECT * FROM comparison")
def metric_comparison(spark, folder):
    return compared(spark, folder)[2]


@query("promotion_decision", "model:s promoted:i reason:s n_improved:i n_compared:i",
       f"""{COMPARED}, verdict AS (SELECT model,
              count(*) FILTER (WHERE metric IN ('rmse', 'mae')) AS k,
              count(*) FILTER (WHERE metric IN ('rmse', 'mae') AND improved = 1) AS g,
              sum(improved) AS n_improved, count(*) AS n_compared FROM comparison GROUP BY 1) =>
       SELECT c.model, CASE WHEN p.model IS NULL THEN 0 WHEN k > 0 AND k = g THEN 1 ELSE 0 END
                AS promoted,
              CASE WHEN p.model IS NULL THEN 'No production model to compare against'
                   WHEN k > 0 AND k = g THEN 'Performance improved'
                   ELSE 'Performance not improved sufficiently' END AS reason,
              coalesce(n_improved, 0) AS n_improved, coalesce(n_compared, 0) AS n_compared
       FROM candidate c LEFT JOIN production p USING (model) LEFT JOIN verdict USING (model)""")
def promotion_decision(spark, folder):
    production, candidate, comparison = compared(spark, folder)
    return select.promotion_decisions(candidate, production, comparison)


def registry(spark, folder):
    """Version table: every order month of a customer segment is one version of its model."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("model")
    )
    orders = table(spark, folder, "orders").join(customers, "o_custkey")
    months = orders.groupBy("model", F.date_trunc("month", "o_orderdate").alias("start_time")).agg(
        F.max("o_orderkey").alias("run_id"), F.sum("o_totalprice").alias("value")
    )
    number = (F.year("start_time") - 1994) * 12 + F.month("start_time")
    stage = F.when(number % 12 == 0, "Production").otherwise("Staging")
    status = F.when(number % 5 == 0, "FAILED").otherwise("FINISHED")
    return months.withColumns(
        {"version": number.cast("string"), "stage": stage, "status": status, "key": F.lit("rmse")}
    )


REGISTRY = """
months AS (SELECT c_mktsegment AS model, date_trunc('month', o_orderdate) AS start_time,
                  max(o_orderkey) AS run_id, sum(o_totalprice) AS value
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
numbered AS (SELECT *, (year(start_time) - 1994) * 12 + month(start_time) AS version FROM months),
registry AS (SELECT *, CASE WHEN version % 12 = 0 THEN 'Production' ELSE 'Staging' END AS stage,
                    CASE WHEN version % 5 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status
             FROM numbered)"""


@query("latest_run", "model:s run_id:i start_time:t",
       f"""{REGISTRY} => SELECT model, arg_max(run_id, start_time) AS run_id,
       max(start_time) AS start_time FROM registry WHERE status = 'FINISHED' GROUP BY 1""")
def latest_run(spark, folder):
    return select.latest_run(registry(spark, folder), ["model"])


@query("best_run", "run_id:i value:2",
       f"{REGISTRY} => SELECT arg_min(run_id, value) AS run_id, min(value) AS value FROM registry")
def best_run(spark, folder):
    return select.best_run(registry(spark, folder), "rmse")


@query("latest_version", "model:s version:i run_id:i stage:s",
       f"""{REGISTRY} => SELECT model, max(version) AS version, arg_max(run_id, version) AS run_id,
       'Production' AS stage FROM registry WHERE stage = 'Production' GROUP BY 1""")
def latest_version(spark, folder):
    return select.latest_version(registry(spark, folder), "Production")


@query("stage_update", "model:s version:s stage:s",
       f"""{REGISTRY}, newest AS (SELECT model, max(version) AS top, sum(value) AS v FROM registry
                                  GROUP BY 1),
       go AS (SELECT model FROM newest WHERE v > (SELECT avg(v) FROM newest)) =>
       SELECT model, version,
              CASE WHEN model IN (FROM go) AND version = top THEN 'Production'
                   WHEN model IN (FROM go) AND stage = 'Production' THEN 'Archived'
                   ELSE stage END AS stage
       FROM registry JOIN newest USING (model)""")
def stage_update(spark, folder):
    versions = registry(spark, folder)
    totals = versions.groupBy("model").agg(F.sum("value").alias("v"))
    mean = totals.agg(F.avg("v").alias("m")).scalar()
    decisions = totals.withColumn("promoted", (F.col("v") > mean).cast("int"))
    return select.apply_promotions(versions, decisions)


@query("metric_unpivot", "model:s metric:s value:4",
       f"""{SCORED}, {MODELS} => SELECT model, metric, value FROM
       (UNPIVOT models ON {", ".join(METRICS)} INTO NAME metric VALUE value)""")
def metric_unpivot(spark, folder):
    return select.long_metrics(model_metrics(spark, folder))


HORIZONS = (1, 3, 7, 14)
TABLE = f"""{DAY_SERIES}, {_folds_sql(14)}, {HORIZON_SQL},
horizons AS (SELECT model, horizon, {HORIZON_MEANS} FROM per_fold GROUP BY 1, 2)"""


@query("horizon_pivot", "model:s h1:2 h3:2 h7:2 h14:2",
       f"""{TABLE} => SELECT model, {", ".join(
           f"max(rmse) FILTER (WHERE horizon = {h}) AS h{h}" for h in HORIZONS)}
       FROM horizons GROUP BY 1""")
def horizon_pivot(spark, folder):
    return select.horizon_pivot(evaluate.multi_horizon(day_scores(spark, folder)), "rmse", HORIZONS)


def flat(spark, folder):
    """All flat metrics of a run: holdout, horizon and quality entries."""
    holdout = select.flat_metrics(model_metrics(spark, folder))
    horizons = select.flat_horizon_metrics(evaluate.multi_horizon(day_scores(spark, folder)))
    gate = quality.quality_metrics(checks(spark, folder))
    return holdout.unionByName(horizons).unionByName(gate)


@query("metric_keys", f"model:s {SIX}", f"{SCORED}, {MODELS} => SELECT * FROM models")
def metric_keys(spark, folder):
    return select.holdout_table(flat(spark, folder))


@query("horizon_keys", "model:s horizon:i metric:s value:2",
       f"""{TABLE} => SELECT model, horizon, metric, value FROM
       (UNPIVOT (SELECT model, horizon, rmse, mae, wape, mape, bias FROM horizons)
        ON rmse, mae, wape, mape, bias INTO NAME metric VALUE value)""")
def horizon_keys(spark, folder):
    return select.horizon_keys(flat(spark, folder))


@query("quality_keys", "model:s check:s status:s code:i",
       f"""{QUALITY} =>
       SELECT model, "check", ['PASS', 'WARNING', 'FAIL'][code + 1] AS status, code FROM checks
       UNION ALL SELECT model, 'model_summary', ['PASS', 'WARNING', 'FAIL'][code + 1], code
       FROM report""")
def quality_keys(spark, folder):
    return select.quality_keys(flat(spark, folder))
