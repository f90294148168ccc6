"""Forecast request queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.ensembles import MEMBERS
from demandloom.catalog.registry import query
from demandloom.catalog.tables import METRICS_SQL, PANEL, SCORED, panel, scored, table
from demandloom.config import LAGS, WINDOW_STATS, WINDOWS
from demandloom.operators import ensemble, metrics, scoring

LAG_COLUMNS = [f"sales_lag_{k}" for k in LAGS]
ROLLING_COLUMNS = [f"sales_rolling_{w}_{s}" for w in WINDOWS for s in WINDOW_STATS]
STAT_SQL = {
    "mean": "avg(sales)",
    "std": "stddev_pop(sales)",
    "min": "min(sales)",
    "max": "max(sales)",
    "median": "median(sales)",
}

LAST = f"""{PANEL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS back
           FROM panel),
last_window AS (
  SELECT store_id, max(date) AS last_date,
         {", ".join(f"max(sales) FILTER (WHERE back = {k}) AS sales_lag_{k}" for k in LAGS)},
         {", ".join(f"{STAT_SQL[s]} FILTER (WHERE back <= {w}) AS sales_rolling_{w}_{s}"
                    for w in WINDOWS for s in WINDOW_STATS)}
  FROM ranked GROUP BY 1)"""


@query("last_window", "store_id:s last_date:d " + " ".join(f"{c}:4" for c in LAG_COLUMNS + ROLLING_COLUMNS),
       f"{LAST} => SELECT * FROM last_window")
def last_window(spark, folder):
    return scoring.last_window(panel(spark, folder))


def week_ago(rows):
    """Stand-in for a fitted model: the level of the last week, lifted on weekends."""
    lift = F.when(F.col("is_weekend") == 1, 1.1).otherwise(1.0)
    return rows.withColumn("prediction", F.col("sales_rolling_7_mean") * lift)


FORECAST = f"""{LAST},
future AS (SELECT store_id, last_date + CAST(unnest(range(1, 31)) AS INTEGER) AS date,
                  sales_rolling_7_mean AS level FROM last_window),
forecast AS (SELECT store_id, date, level * CASE WHEN isodow(date) >= 6 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END
                    AS predicted_sales FROM future)"""


@query("future_scoring", "store_id:s date:d predicted_sales:2 lower_bound:2 upper_bound:2",
       f"""{FORECAST} => SELECT *, predicted_sales * 0.9::DOUBLE AS lower_bound,
       predicted_sales * 1.1::DOUBLE AS upper_bound FROM forecast""")
def future_scoring(spark, folder):
    return scoring.forecast_request(panel(spark, folder), week_ago)


@query("forecast_summary",
       "store_id:s total_predicted_sales:2 average_daily_sales:2 max_daily_sales:2"
       " min_daily_sales:2",
       f"""{FORECAST} => SELECT store_id, sum(predicted_sales) AS total_predicted_sales,
       avg(predicted_sales) AS average_daily_sales, max(predicted_sales) AS max_daily_sales,
       min(predicted_sales) AS min_daily_sales FROM forecast GROUP BY 1""")
def forecast_summary(spark, folder):
    forecast = scoring.forecast_request(panel(spark, folder), week_ago)
    return metrics.forecast_summary(forecast, ["store_id"])


@query("request_scoring", "request_id:i store_id:s date:d prediction:2",
       f"""{LAST}, requests AS (SELECT o_orderkey AS request_id, o_orderpriority AS store_id,
              CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date
              FROM orders) =>
       SELECT request_id, store_id, date, sales_rolling_7_mean
              * CASE WHEN isodow(date) >= 6 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS prediction
       FROM requests JOIN last_window USING (store_id) WHERE date IS NOT NULL""")
def request_scoring(spark, folder):
    return scoring.score_requests(requests(spark, folder), panel(spark, folder), week_ago)


def requests(spark, folder):
    """One request per order, with a malformed date in every tenth."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_orderpriority").alias("store_id"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("31/12/1999")).otherwise(day).alias("date"),
    )


@query("request_errors", "request_id:i error:s",
       """=> SELECT o_orderkey AS request_id, 'invalid date: 31/12/1999' AS error FROM orders
       WHERE o_orderkey % 10 = 0""")
def request_errors(spark, folder):
    return checked(spark, folder).where("error IS NOT NULL")


def checked(spark, folder):
    raw = requests(spark, folder)
    parsed = scoring.checked_requests(raw.withColumn("day", F.col("date")), "day")
    return parsed


@query("member_intervals",
       "date:d store_id:s prediction:2 ci_80_lower:2 ci_80_upper:2 ci_95_lower:2 ci_95_upper:2",
       f"""{SCORED}, m AS (SELECT date, store_id, avg(prediction) AS prediction,
              stddev_pop(prediction) * 0.1::DOUBLE AS sd FROM scored GROUP BY 1, 2) =>
       SELECT date, store_id, prediction, prediction - 1.28::DOUBLE * sd AS ci_80_lower,
              prediction + 1.28::DOUBLE * sd AS ci_80_upper, prediction - 1.96::DOUBLE * sd AS ci_95_lower,
              prediction + 1.96::DOUBLE * sd AS ci_95_upper FROM m""")
def member_intervals(spark, folder):
    wide = ensemble.member_columns(scored(spark, folder), ["date", "store_id"], MEMBERS)
    return scoring.member_intervals(wide, MEMBERS)


@query("holdout_validation", "model:s validation_rmse:4 validation_mae:4 validation_r2:4 validation_samples:i",
       f"""{SCORED}, m AS (SELECT model, count(*) AS n, {METRICS_SQL} FROM scored GROUP BY model) =>
       SELECT model, rmse AS validation_rmse, mae AS validation_mae, r2 AS validation_r2,
              n AS validation_samples FROM m""")
def holdout_validation(spark, folder):
    rows = scored(spark, folder)
    chosen = {f"validation_{n}": c for n, c in metrics.metric_columns().items() if n in ("rmse", "mae", "r2")}
    chosen["validation_samples"] = F.count(F.lit(1))
    return metrics.forecast_metrics(rows, ["model"], chosen)
