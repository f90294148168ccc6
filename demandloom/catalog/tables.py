"""The domain tables read from the given parquet tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.calendar import is_holiday
from demandloom.plans.tables import whole_series


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _store(key: str):
    return F.concat(F.lit("store_"), F.lpad(F.col(key).cast("string"), 3, "0"))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales fact: a line item shipped by a supplier; the supplier's nation is the store."""
    lines = table(spark, folder, "lineitem")
    stores = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), _store("s_nationkey").alias("store_id")
    )
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice"
    )
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = 0.7 * F.col("l_extendedprice")
    return lines.join(stores, "l_suppkey").join(products, "l_partkey").select(
        F.to_date("l_shipdate").alias("date"),
        "store_id",
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_brand").alias("category"),
        F.col("l_quantity").alias("quantity_sold"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_discount").alias("discount_percent"),
        revenue.alias("revenue"),
        cost.alias("cost"),
        (revenue - cost).alias("profit"),
    )


SALES = """
sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         'store_' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS store_id,
         CAST(l_partkey AS VARCHAR) AS product_id, p_brand AS category,
         l_quantity AS quantity_sold, p_retailprice AS unit_price,
         l_discount AS discount_percent,
         l_extendedprice * (1 - l_discount) AS revenue,
         0.7::DOUBLE * l_extendedprice AS cost,
         l_extendedprice * (1 - l_discount) - 0.7::DOUBLE * l_extendedprice AS profit
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


def promotions(spark: SparkSession, folder: str) -> DataFrame:
    """Promotions: products that shipped with a discount of 8% or more."""
    return (
        table(spark, folder, "lineitem")
        .where("l_discount >= 0.08")
        .select(
            F.col("l_shipdate").alias("date"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.lit("Flash Sale").alias("promotion_type"),
            F.col("l_discount").alias("discount_percent"),
        )
    )


PROMOTIONS = """
promotions AS (
  SELECT l_shipdate AS date, CAST(l_partkey AS VARCHAR) AS product_id,
         l_discount AS discount_percent
  FROM lineitem WHERE l_discount >= 0.08)"""

# Twin of functions.calendar.holiday_name, on a column named date.
HOLIDAY_NAME = """
CASE
  WHEN month(date) = 1 AND day(date) = 1 THEN 'New Year''s Day'
  WHEN month(date) = 6 AND day(date) = 19 AND year(date) >= 2021
    THEN 'Juneteenth National Independence Day'
  WHEN month(date) = 7 AND day(date) = 4 THEN 'Independence Day'
  WHEN month(date) = 11 AND day(date) = 11 THEN 'Veterans Day'
  WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas Day'
  WHEN month(date) = 1 AND isodow(date) = 1 AND day(date) BETWEEN 15 AND 21
    THEN 'Martin Luther King Jr. Day'
  WHEN month(date) = 2 AND isodow(date) = 1 AND day(date) BETWEEN 15 AND 21
    THEN 'Washington''s Birthday'
  WHEN month(date) = 5 AND isodow(date) = 1 AND day(date) >= 25 THEN 'Memorial Day'
  WHEN month(date) = 9 AND isodow(date) = 1 AND day(date) <= 7 THEN 'Labor Day'
  WHEN month(date) = 10 AND isodow(date) = 1 AND day(date) BETWEEN 8 AND 14 THEN 'Columbus Day'
  WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28
    THEN 'Thanksgiving Day'
  WHEN (isodow(date) = 5 AND month(date) = 12 AND day(date) = 31)
    OR (isodow(date) = 1 AND month(date) = 1 AND day(date) = 2) THEN 'New Year''s Day (observed)'
  WHEN year(date) >= 2021 AND month(date) = 6 AND ((isodow(date) = 5 AND day(date) = 18)
    OR (isodow(date) = 1 AND day(date) = 20))
    THEN 'Juneteenth National Independence Day (observed)'
  WHEN month(date) = 7 AND ((isodow(date) = 5 AND day(date) = 3)
    OR (isodow(date) = 1 AND day(date) = 5)) THEN 'Independence Day (observed)'
  WHEN month(date) = 11 AND ((isodow(date) = 5 AND day(date) = 10)
    OR (isodow(date) = 1 AND day(date) = 12)) THEN 'Veterans Day (observed)'
  WHEN month(date) = 12 AND ((isodow(date) = 5 AND day(date) = 24)
    OR (isodow(date) = 1 AND day(date) = 26)) THEN 'Christmas Day (observed)'
END"""

IS_HOLIDAY = f"CAST(({HOLIDAY_NAME}) IS NOT NULL AS INTEGER)"


def traffic(spark: SparkSession, folder: str) -> DataFrame:
    """Store traffic: each order is one visit to the store of the customer's nation."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), _store("c_nationkey").alias("store_id")
    )
    date = F.to_date("o_orderdate")
    return table(spark, folder, "orders").join(customers, "o_custkey").select(
        date.alias("date"),
        "store_id",
        F.lit(1).alias("customer_traffic"),
        is_holiday(date).alias("is_holiday"),
    )


TRAFFIC = f"""
visits AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         'store_' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS store_id,
         1 AS customer_traffic
  FROM orders JOIN customer ON o_custkey = c_custkey),
traffic AS (SELECT *, {IS_HOLIDAY} AS is_holiday FROM visits)"""


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Dense daily series: order value per day and priority, the priority being the store."""
    orders = table(spark, folder, "orders")
    return orders.groupBy(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("store_id")
    ).agg(
        F.sum("o_totalprice").alias("sales"), F.count(F.lit(1)).alias("quantity_sold")
    )


PANEL = """
panel AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS store_id,
         sum(o_totalprice) AS sales, count(*) AS quantity_sold
  FROM orders GROUP BY 1, 2)"""


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return panel(spark, folder).groupBy("date").agg(F.sum("sales").alias("sales"))


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Contacts: an event is one contact, its type the channel."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("channel"),
        (60 + F.col("value")).alias("handle_time"),
    )


CUBE = """
cube AS (
  SELECT date_trunc('hour', ts) AS timestamp, event_type AS channel, count(*) AS volume,
         avg(60 + value) AS average_handle_time
  FROM events GROUP BY 1, 2)"""


def scored(spark: SparkSession, folder: str, complete: bool = True) -> DataFrame:
    """Scored table of three members: value a week back, a row back, mean of the week before.

    ``complete`` keeps the rows that every member scored.
    """
    window = whole_series(["store_id"], "date")
    members = {
        "naive_7": F.lag("sales", 7).over(window),
        "naive_1": F.lag("sales", 1).over(window),
        "mean_7": F.avg("sales").over(window.rowsBetween(-7, -1)),
    }
    wide = panel(spark, folder).withColumns(members)
    if complete:
        wide = wide.where("naive_7 IS NOT NULL")
    rows = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in members]
    )
    return wide.select("date", "store_id", F.col("sales").alias("actual"), F.inline(rows))


def _scored_sql(where: str) -> str:
    return f"""{PANEL},
members AS (
  SELECT date, store_id, sales AS actual,
         lag(sales, 7) OVER w AS naive_7, lag(sales, 1) OVER w AS naive_1,
         avg(sales) OVER (PARTITION BY store_id ORDER BY date
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean_7
  FROM panel WINDOW w AS (PARTITION BY store_id ORDER BY date)),
scored AS (
  SELECT date, store_id, 'naive_7' AS model, actual, naive_7 AS prediction FROM members {where}
  UNION ALL SELECT date, store_id, 'naive_1', actual, naive_1 FROM members {where}
  UNION ALL SELECT date, store_id, 'mean_7', actual, mean_7 FROM members {where})"""


SCORED = _scored_sql("WHERE naive_7 IS NOT NULL")
SCORED_ALL = _scored_sql("")

METRICS_SQL = """
sqrt(avg((prediction - actual) ** 2)) AS rmse,
avg(abs(prediction - actual)) AS mae,
avg(CASE WHEN abs(actual) >= 1e-8 THEN abs((prediction - actual) / actual) END) * 100 AS mape,
CASE WHEN sum(abs(actual)) > 0
     THEN sum(abs(prediction - actual)) / sum(abs(actual)) * 100 END AS wape,
avg(prediction - actual) AS bias,
CASE WHEN count(*) < 2 THEN NULL
     WHEN var_pop(actual) = 0
     THEN CASE WHEN sum((prediction - actual) ** 2) = 0 THEN 1.0 ELSE 0.0 END
     ELSE 1 - sum((prediction - actual) ** 2) / (var_pop(actual) * count(*)) END AS r2"""

MODELS = f"""
models AS (SELECT model, {METRICS_SQL} FROM scored WHERE prediction IS NOT NULL GROUP BY model)"""
