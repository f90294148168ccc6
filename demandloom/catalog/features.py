"""Feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandloom.catalog.registry import query
from demandloom.catalog.rollups import ROLLUP
from demandloom.catalog.tables import HOLIDAY_NAME, IS_HOLIDAY, PANEL, panel, sales, table
from demandloom.config import LAGS, WINDOW_STATS, WINDOWS, FeatureConfig
from demandloom.functions import calendar
from demandloom.operators import features, rollup, scoring
from demandloom.plans.tables import new_folder
from demandloom.sources.feature_store import FeatureStore

KEYS = ["store_id"]
SERIES = "PARTITION BY store_id ORDER BY date"
ROW = "date:d store_id:s"

LAG_COLUMNS = [f"sales_lag_{k}" for k in LAGS]
ROLLING_COLUMNS = [f"sales_rolling_{w}_{s}" for w in WINDOWS for s in WINDOW_STATS]

STAT_SQL = {
    "mean": "avg(sales)",
    "std": "stddev_samp(sales)",
    "min": "min(sales)",
    "max": "max(sales)",
    "median": "quantile_cont(sales, 0.5)",
}


def _digits(column: str) -> str:
    """Deviations agree to fewer places than sums of cents."""
    return f"{column}:{3 if column.endswith('_std') else 4}"


def _lags_sql(lags=LAGS) -> str:
    return ", ".join(f"lag(sales, {k}) OVER ({SERIES}) AS sales_lag_{k}" for k in lags)


def _rolling_sql(windows=WINDOWS, stats=WINDOW_STATS, shift: int = 0) -> str:
    end = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    return ", ".join(
        f"{STAT_SQL[s]} OVER ({SERIES} ROWS BETWEEN {w - 1 + shift} PRECEDING AND {end})"
        f" AS sales_rolling_{w}_{s}"
        for w in windows
        for s in stats
    )


@query("date_features",
       "o_orderkey:i year:i month:i day:i dayofweek:i quarter:i weekofyear:i is_weekend:i"
       " is_holiday:i",
       f"""days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders) =>
       SELECT o_orderkey, year(date) AS year, month(date) AS month, day(date) AS day,
              isodow(date) - 1 AS dayofweek, quarter(date) AS quarter, week(date) AS weekofyear,
              CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, {IS_HOLIDAY} AS is_holiday
       FROM days""")
def date_features(spark, folder):
    rows = table(spark, folder, "orders").withColumn("date", F.to_date("o_orderdate"))
    return features.date_features(rows)


@query("cyclical_features",
       "o_orderkey:i month_sin:6 month_cos:6 day_sin:6 day_cos:6 dayofweek_sin:6 dayofweek_cos:6",
       """days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders) =>
       SELECT o_orderkey, sin(2 * pi() * month(date) / 12) AS month_sin,
              cos(2 * pi() * month(date) / 12) AS month_cos,
              sin(2 * pi() * day(date) / 31) AS day_sin, cos(2 * pi() * day(date) / 31) AS day_cos,
              sin(2 * pi() * (isodow(date) - 1) / 7) AS dayofweek_sin,
              cos(2 * pi() * (isodow(date) - 1) / 7) AS dayofweek_cos
       FROM days""")
def cyclical_features(spark, folder):
    rows = table(spark, folder, "orders").withColumn("date", F.to_date("o_orderdate"))
    return features.cyclical_features(rows)


@query("calendar_flags",
       f"{ROW} is_month_start:i is_month_end:i week_of_month:i quarter_progress:i is_quarter_end:i"
       " days_since_month_start:i promotion_weekend:i",
       f"""{PANEL} =>
       SELECT date, store_id, CAST(day(date) <= 5 AS INTEGER) AS is_month_start,
              CAST(day(date) >= 25 AS INTEGER) AS is_month_end,
              (day(date) - 1) // 7 + 1 AS week_of_month,
              (month(date) - 1) % 3 + 1 AS quarter_progress,
              CAST((month(date) - 1) % 3 = 2 AS INTEGER) AS is_quarter_end,
              day(date) AS days_since_month_start,
              CAST(quantity_sold >= 3 AND isodow(date) >= 6 AS INTEGER) AS promotion_weekend
       FROM panel""")
def calendar_flags(spark, folder):
    rows = panel(spark, folder).withColumns(
        {
            "has_promotion": (F.col("quantity_sold") >= 3).cast("int"),
            "is_weekend": (F.weekday("date") >= 5).cast("int"),
        }
    )
    return features.month_position_features(rows)


@query("interaction_features",
       "o_orderkey:i o_orderstatus_o_orderpriority_interaction:s o_orderstatus_month_interaction:s"
       " o_orderpriority_month_interaction:s",
       """days AS (SELECT *, month(o_orderdate) AS month FROM orders) =>
       SELECT o_orderkey,
              o_orderstatus || '_' || o_orderpriority AS o_orderstatus_o_orderpriority_interaction,
              o_orderstatus || '_' || month AS o_orderstatus_month_interaction,
              o_orderpriority || '_' || month AS o_orderpriority_month_interaction
       FROM days""")
def interaction_features(spark, folder):
    rows = table(spark, folder, "orders").withColumn("month", F.month("o_orderdate"))
    return features.interaction_features(rows, ["o_orderstatus", "o_orderpriority", "month"])


@query("holiday_features", "date:d holiday_name:s is_holiday:i is_day_after:i",
       f"""days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
       named AS (SELECT date, {HOLIDAY_NAME} AS holiday_name FROM days),
       before AS (SELECT date + 1 AS day, {HOLIDAY_NAME} AS name_before
                  FROM (SELECT CAST(date - 1 AS DATE) AS date FROM days)) =>
       SELECT date, holiday_name, CAST(holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
              CAST(name_before IS NOT NULL AND holiday_name IS NULL AS INTEGER) AS is_day_after
       FROM named JOIN before ON named.date = before.day""")
def holiday_features(spark, folder):
    days = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return days.withColumns(
        {
            "holiday_name": calendar.holiday_name(F.col("date")),
            "is_holiday": calendar.is_holiday(F.col("date")).cast("int"),
            "is_day_after": calendar.is_day_after_holiday(F.col("date")).cast("int"),
        }
    )


@query("lag_features", f"{ROW} " + " ".join(f"{c}:2" for c in LAG_COLUMNS),
       f"{PANEL} => SELECT date, store_id, {_lags_sql()} FROM panel")
def lag_features(spark, folder):
    return features.lag_features(panel(spark, folder))


@query("rolling_features", f"{ROW} " + " ".join(_digits(c) for c in ROLLING_COLUMNS),
       f"{PANEL} => SELECT date, store_id, {_rolling_sql()} FROM panel")
def rolling_features(spark, folder):
    return features.rolling_features(panel(spark, folder))


@query("rolling_leak_free", f"{ROW} " + " ".join(_digits(c) for c in ROLLING_COLUMNS),
       f"{PANEL} => SELECT date, store_id, {_rolling_sql(shift=1)} FROM panel")
def rolling_leak_free(spark, folder):
    return features.rolling_features(panel(spark, folder), shift=1)


@query("rolling_full_window",
       f"{ROW} " + " ".join(_digits(c) for c in [*LAG_COLUMNS, *ROLLING_COLUMNS]),
       f"""{PANEL},
       means AS (SELECT *, avg(sales) OVER (PARTITION BY store_id) AS m FROM panel) =>
       SELECT date, store_id, """
       + ", ".join(f"coalesce(lag(sales, {k}) OVER ({SERIES}), m) AS sales_lag_{k}" for k in LAGS)
       + ", "
       + ", ".join(
           f"CASE WHEN row_number() OVER ({SERIES}) >= {w} THEN {STAT_SQL[s]} OVER ({SERIES} ROWS"
           f" BETWEEN {w - 1} PRECEDING AND CURRENT ROW) ELSE {'0.0' if s == 'std' else 'm'} END"
           f" AS sales_rolling_{w}_{s}"
           for w in WINDOWS
           for s in WINDOW_STATS
       )
       + " FROM means")
def rolling_full_window(spark, folder):
    return features.rolling_full_window(panel(spark, folder))


BLOCK_SERIES = "PARTITION BY store_id ORDER BY date, product_id"
BLOCK_COLUMNS = [f"quantity_sold_lag_{k}" for k in LAGS] + [
    f"quantity_sold_rolling_{w}_{s}" for w in WINDOWS for s in WINDOW_STATS
]


@query("blocked_features", f"{ROW} product_id:s " + " ".join(_digits(c) for c in BLOCK_COLUMNS),
       f"""{ROLLUP} =>
       SELECT date, store_id, product_id, """
       + ", ".join(
           [f"lag(quantity_sold, {k}) OVER ({BLOCK_SERIES}) AS quantity_sold_lag_{k}" for k in LAGS]
           + [
               f"{STAT_SQL[s].replace('sales', 'quantity_sold')} OVER ({BLOCK_SERIES} ROWS BETWEEN {w - 1} PRECEDING"
               f" AND CURRENT ROW) AS quantity_sold_rolling_{w}_{s}"
               for w in WINDOWS
               for s in WINDOW_STATS
           ]
       )
       + " FROM daily")
def blocked_features(spark, folder):
    rows = rollup.daily_product_rollup(sales(spark, folder))
    return features.blocked_features(rows, "quantity_sold", KEYS, "date", ["product_id"], block_rows=1000)


@query("trend_features",
       f"{ROW} trend:i trend_squared:i sales_velocity:2 sales_acceleration:2 sales_ratio_to_7d:6"
       " sales_ratio_to_30d:6",
       f"""{PANEL},
       first_step AS (SELECT *, row_number() OVER ({SERIES}) - 1 AS trend,
              sales - lag(sales) OVER ({SERIES}) AS sales_velocity,
              avg(sales) OVER ({SERIES} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
              avg(sales) OVER ({SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30
              FROM panel) =>
       SELECT date, store_id, trend, trend * trend AS trend_squared, sales_velocity,
              sales_velocity - lag(sales_velocity) OVER ({SERIES}) AS sales_acceleration,
              sales / (m7 + 1) AS sales_ratio_to_7d, sales / (m30 + 1) AS sales_ratio_to_30d
       FROM first_step""")
def trend_features(spark, folder):
    return features.trend_features(panel(spark, folder))


@query("ewm_features", f"{ROW} ewm_7_share:8 ewm_14_share:8",
       f"""{PANEL},
       so_far AS (SELECT date, store_id, sales, list(sales) OVER ({SERIES} ROWS BETWEEN UNBOUNDED
                  PRECEDING AND CURRENT ROW) AS x FROM panel) =>
       SELECT date, store_id,
              list_reduce(x, lambda a, b: 0.75::DOUBLE * a + 0.25::DOUBLE * b) / sales
                AS ewm_7_share,
              list_reduce(x, lambda a, b: (1 - 2.0::DOUBLE / 15) * a + (2.0::DOUBLE / 15) * b) / sales
                AS ewm_14_share
       FROM so_far""")
def ewm_features(spark, folder):
    smooth = features.ewm_features(panel(spark, folder))
    return smooth.withColumns({f"ewm_{s}_share": F.col(f"sales_ewm_{s}") / F.col("sales") for s in (7, 14)})


HOLED = f"""{PANEL},
holed AS (
  SELECT date, store_id,
         CASE WHEN day(date) % 4 = 0 OR store_id = '3-MEDIUM' THEN NULL ELSE sales END AS sales,
         CASE WHEN month(date) = 1 THEN NULL ELSE quantity_sold END AS quantity_sold
  FROM panel)"""


def holed(spark, folder):
    """The panel with holes, one series being empty."""
    gone = (F.dayofmonth("date") % 4 == 0) | (F.col("store_id") == "3-MEDIUM")
    return panel(spark, folder).withColumns(
        {
            "sales": F.when(~gone, F.col("sales")),
            "quantity_sold": F.when(F.month("date") != 1, F.col("quantity_sold")),
        }
    )


@query("fill_group", f"{ROW} sales:2 quantity_sold:6",
       f"""{HOLED} =>
       SELECT date, store_id,
              coalesce(last_value(sales IGNORE NULLS) OVER (
                         {SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       first_value(sales IGNORE NULLS) OVER (
                         {SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS sales,
              coalesce(quantity_sold, avg(quantity_sold) OVER ()) AS quantity_sold
       FROM holed""")
def fill_group(spark, folder):
    return features.fill_missing(holed(spark, folder), ["sales"], ["quantity_sold"])


@query("fill_panel", f"{ROW} sales:2",
       f"""{HOLED} =>
       SELECT date, store_id,
              coalesce(last_value(sales IGNORE NULLS) OVER (ORDER BY store_id, date
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       first_value(sales IGNORE NULLS) OVER (ORDER BY store_id, date
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS sales
       FROM holed""")
def fill_panel(spark, folder):
    return features.fill_missing(holed(spark, folder), ["sales"], [], scope="panel")


@query("fill_request_defaults",
       f"{ROW} quantity_sold:i profit:i has_promotion:i customer_traffic:i is_holiday:i",
       f"""{PANEL} => SELECT date, store_id, quantity_sold, 1000 AS profit, 0 AS has_promotion,
       500 AS customer_traffic, 0 AS is_holiday FROM panel""")
def fill_request_defaults(spark, folder):
    return scoring.with_defaults(panel(spark, folder))


@query("target_encoding", f"{ROW} store_id_target_encoded:4",
       f"""{HOLED}, overall AS (SELECT avg(sales) AS m FROM holed),
       category AS (SELECT store_id, count(*) AS n, avg(sales) AS mean FROM holed GROUP BY 1) =>
       SELECT date, store_id, coalesce((n * mean + m) / (n + 1), m) AS store_id_target_encoded
       FROM holed JOIN category USING (store_id), overall""")
def target_encoding(spark, folder):
    return features.target_encoding(holed(spark, folder), ["store_id"])


ALL = FeatureConfig()
#: Filled columns of the full feature set, with the digits compared.
FILLED = {f"sales_lag_{n}": 2 for n in ALL.lags} | {
    f"sales_rolling_{w}_{s}": 3 for w in ALL.windows for s in ALL.stats
}


@query("all_features",
       f"{ROW} sales:2 year:i weekofyear:i is_weekend:i is_holiday:i day_sin:6 quantity_sold:2 "
       + " ".join(f"{c}:{digits}" for c, digits in FILLED.items()),
       f"""{PANEL},
       raw AS (SELECT *, {_lags_sql(ALL.lags)}, {_rolling_sql(ALL.windows, ALL.stats)} FROM panel) =>
       SELECT date, store_id, sales, year(date) AS year, week(date) AS weekofyear,
              CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, {IS_HOLIDAY} AS is_holiday,
              sin(2 * pi() * day(date) / 31) AS day_sin, quantity_sold, """
       + ", ".join(
           f"coalesce({c}, first_value({c} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN CURRENT ROW"
           f" AND UNBOUNDED FOLLOWING)) AS {c}"
           for c in FILLED
       )
       + " FROM raw")
def all_features(spark, folder):
    return features.all_features(panel(spark, folder), config=ALL)


@query("incremental_features", f"{ROW} sales:2 " + " ".join(_digits(c) for c in [*LAG_COLUMNS, *ROLLING_COLUMNS]),
       f"{PANEL} => SELECT date, store_id, sales, {_lags_sql()}, {_rolling_sql()} FROM panel")
def incremental_features(spark, folder):
    """The panel in three batches by date, each with features from the tail that the one before left."""
    rows = panel(spark, folder).select("date", "store_id", "sales")
    place = new_folder(spark, "feature_store")
    name = place.rsplit("/", 1)[1].replace("-", "_")
    store = FeatureStore(spark, name, place, "date date, store_id string, sales double")
    ends = rows.agg(F.min("date").alias("first"), (F.date_diff(F.max("date"), F.min("date")) + 1).alias("days")).first()
    part = F.floor(F.date_diff("date", F.lit(ends["first"])) * 3 / F.lit(ends["days"]))
    for batch in range(3):
        store.append(rows.where(part == batch), f"batch-{batch}")
    return store.read()


@query("store_numbers", "s_suppkey:i number:i",
       """=> SELECT s_suppkey, s_nationkey AS number FROM supplier""")
def store_numbers(spark, folder):
    name = F.concat(F.lit("store_"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"))
    return table(spark, folder, "supplier").select(
        "s_suppkey", scoring.store_number(name).alias("number")
    )
