"""Roll-ups of daily facts to the training panel, and the joins that enrich them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions import calendar

PRODUCT_DAY = ("date", "store_id", "product_id", "category")


def _total(column: str) -> Column:
    """Sum in which an all-null group counts as 0."""
    return F.coalesce(F.sum(column), F.lit(0.0)).alias(column)


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def daily_product_rollup(sales: DataFrame) -> DataFrame:
    """Sales per (date, store, product, category); rows with a null key are left out."""
    return (
        without_null_keys(sales, PRODUCT_DAY)
        .groupBy(*PRODUCT_DAY)
        .agg(
            F.coalesce(F.sum("quantity_sold"), F.lit(0.0)).alias("quantity_sold"),
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("sales"),
            _total("cost"),
            _total("profit"),
            F.avg("discount_percent").alias("discount_percent"),
            F.avg("unit_price").alias("unit_price"),
        )
    )


def promo_summary(promotions: DataFrame) -> DataFrame:
    """Best discount and a promotion flag per (date, product); times are cut to the day."""
    daily = promotions.withColumn("date", F.to_date("date"))
    return (
        without_null_keys(daily, ("date", "product_id"))
        .groupBy("date", "product_id")
        .agg(F.max("discount_percent").alias("max_discount"))
        .withColumn("has_promotion", F.lit(1))
    )


def traffic_summary(traffic: DataFrame) -> DataFrame:
    """Visitors and holiday flag per (date, store)."""
    return (
        without_null_keys(traffic, ("date", "store_id"))
        .groupBy("date", "store_id")
        .agg(
            F.coalesce(F.sum("customer_traffic"), F.lit(0)).alias("customer_traffic"),
            F.max(F.col("is_holiday").cast("int")).alias("is_holiday"),
        )
    )


def with_promotions(daily: DataFrame, summary: DataFrame) -> DataFrame:
    """Mark each product-day with whether a promotion ran."""
    flags = summary.select("date", "product_id", "has_promotion")
    return daily.join(flags, ["date", "product_id"], "left").withColumn(
        "has_promotion", F.coalesce("has_promotion", F.lit(0))
    )


def with_traffic(panel: DataFrame, summary: DataFrame) -> DataFrame:
    """Attach traffic and holiday of the store-day; both are constant within it."""
    return panel.join(summary, ["date", "store_id"], "left")


def store_day_panel(daily: DataFrame) -> DataFrame:
    """Totals and promotion share per (date, store)."""
    return (
        without_null_keys(daily, ("date", "store_id"))
        .groupBy("date", "store_id")
        .agg(
            _total("sales"),
            _total("quantity_sold"),
            _total("profit"),
            F.avg("has_promotion").alias("has_promotion"),
        )
    )


def training_panel(
    sales: DataFrame, promotions: DataFrame | None, traffic: DataFrame | None
) -> DataFrame:
    """Product roll-up, promotion join, store-day roll-up and traffic join, in one plan.

    Traffic joins after the store-day roll-up: both sides are then already partitioned by
    (date, store), and the product rows need not be shuffled for it.
    """
    daily = daily_product_rollup(sales)
    if promotions is not None:
        daily = with_promotions(daily, promo_summary(promotions))
    else:
        daily = daily.withColumn("has_promotion", F.lit(0))
    panel = store_day_panel(daily)
    if traffic is not None:
        return with_traffic(panel, traffic_summary(traffic))
    return panel.withColumns(
        {"customer_traffic": F.lit(None).cast("long"), "is_holiday": F.lit(None).cast("int")}
    )


def daily_series(panel: DataFrame, target: str = "sales", date: str = "date") -> DataFrame:
    """Collapse a panel to one row per day and add calendar columns."""
    parts = calendar.date_parts(F.col(date))
    names = ("dayofweek", "month", "day", "weekofyear", "quarter", "is_weekend")
    return (
        without_null_keys(panel, (date,))
        .groupBy(date)
        .agg(F.coalesce(F.sum(target), F.lit(0.0)).alias(target))
        .withColumns({n: parts[n] for n in names})
    )


def first_match(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], order: str, value: str, default
) -> DataFrame:
    """Attach the first lookup value per key, in ``order``; absent keys get ``default``."""
    first = lookup.groupBy(*on).agg(F.min_by(value, order).alias(value))
    return rows.join(first, list(on), "left").withColumn(value, F.coalesce(value, F.lit(default)))


def lookup_value(
    rows: DataFrame, dimension: DataFrame, on: Sequence[str], value: str, default=None
) -> DataFrame:
    """Map keys to an attribute of a dimension with one row per key."""
    out = rows.join(dimension.select(*on, value), list(on), "left")
    return out if default is None else out.withColumn(value, F.coalesce(value, F.lit(default)))


def unmatched(expected: DataFrame, observed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected keys that were never observed."""
    return expected.join(observed.select(*on), list(on), "left_anti")


def known_only(rows: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is one of the known ones."""
    return rows.join(known.select(*on), list(on), "left_semi")


def residuals(predictions: DataFrame, actuals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Predictions with their actuals, matched on the full key; residual = actual - prediction."""
    return predictions.join(actuals, list(on), "inner").withColumn(
        "residual", F.col("actual") - F.col("prediction")
    )


def aligned_scores(actuals: DataFrame, predictions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every actual row of every model; a row the model did not score has a null prediction.

    The model names are a handful, so they travel as one array from a scalar subquery and
    every actual row is repeated per model, instead of being paired through a join.
    """
    models = predictions.agg(F.collect_set("model").alias("models")).scalar()
    slots = actuals.withColumn("model", F.explode(models))
    return slots.join(predictions, [*on, "model"], "left")


def entity_spine(
    panel: DataFrame, keys: Sequence[str], date: str = "date", step: str = "1 day"
) -> DataFrame:
    """Every date of every entity, from its first to its last observation."""
    ends = panel.groupBy(*keys).agg(F.min(date).alias("__from"), F.max(date).alias("__to"))
    dates = F.sequence("__from", "__to", F.expr(f"interval {step}"))
    return ends.select(*keys, F.explode(dates).alias(date))
