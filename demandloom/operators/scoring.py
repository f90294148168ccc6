"""Forecast requests: last-window features, future dates, bounds, batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import REQUEST_DEFAULTS, FeatureConfig
from demandloom.functions import calendar
from demandloom.plans.tables import per_group

DEFAULTS = FeatureConfig()

# Normal quantile by two-sided confidence.
Z_SCORES = {80: 1.28, 95: 1.96}


def with_defaults(df: DataFrame, defaults: Mapping[str, Any] = REQUEST_DEFAULTS) -> DataFrame:
    """Add the request columns a table lacks."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def store_number(store: Column) -> Column:
    """Digits of a ``store_NNN`` name; 1 for any other name."""
    digits = F.regexp_extract(store, r"(\d+)", 1)
    return F.when(store.contains("store_") & (digits != ""), digits.try_cast("int")).otherwise(1)


def request_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Calendar and cyclical columns of a request plus its defaults."""
    parts = calendar.date_parts(F.col(date))
    parts.pop("is_holiday")
    return with_defaults(df.withColumns({**parts, **calendar.cyclical(F.col(date))}))


def last_window(
    history: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    config: FeatureConfig = DEFAULTS,
) -> DataFrame:
    """Lags and trailing statistics at the end of each series, one row per series.

    Deviations are population deviations. A lag or window longer than the series falls back to
    the mean of the series, a deviation to 0. Only the last rows of a series are shuffled.
    """
    depth = max([*config.lags, *config.windows])
    latest = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    recent = (
        history.select(*keys, date, target)
        .withColumn("__back", F.row_number().over(latest))
        .where(F.col("__back") <= depth)
    )
    value, back = F.col(target), F.col("__back")
    fns = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    aggs = [F.max("__back").alias("__n"), F.max(date).alias("last_date")]
    for k in config.lags:
        aggs.append(F.max(F.when(back == k, value)).alias(f"{target}_lag_{k}"))
    for w in config.windows:
        inside = F.when(back <= w, value)
        for stat in config.stats:
            column = F.percentile(inside, F.lit(0.5)) if stat == "median" else fns[stat](inside)
            aggs.append(column.alias(f"{target}_rolling_{w}_{stat}"))
    tails = recent.groupBy(*keys).agg(*aggs)
    means = history.groupBy(*keys).agg(F.avg(target).alias("__mean"))
    joined = per_group(tails, means, keys)
    out = {
        f"{target}_lag_{k}": F.when(F.col("__n") >= k, F.col(f"{target}_lag_{k}")).otherwise(
            F.col("__mean")
        )
        for k in config.lags
    }
    for w in config.windows:
        for stat in config.stats:
            name = f"{target}_rolling_{w}_{stat}"
            fallback = F.lit(0.0) if stat == "std" else F.col("__mean")
            out[name] = F.when(F.col("__n") >= w, F.col(name)).otherwise(fallback)
    return joined.withColumns(out).drop("__n", "__mean")


def future_rows(
    history: DataFrame,
    days: int = 30,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    config: FeatureConfig = DEFAULTS,
) -> DataFrame:
    """The next ``days`` of every series with all request features."""
    ends = last_window(history, keys, date, target, config)
    steps = F.explode(F.sequence(F.lit(1), F.lit(int(days)))).alias("step")
    dated = ends.select("*", steps).withColumn(date, F.date_add("last_date", F.col("step")))
    return request_features(dated.drop("last_date"), date)


def with_bounds(forecast: DataFrame, value: str = "predicted_sales", share: float = 0.1) -> DataFrame:
    """Bounds at a fixed share either side of the forecast."""
    return forecast.withColumns(
        {"lower_bound": F.col(value) * (1 - share), "upper_bound": F.col(value) * (1 + share)}
    )


def forecast_request(
    history: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    days: int = 30,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Forecast every series: ``keys, date, predicted_sales, lower_bound, upper_bound``.

    ``predict`` adds a ``prediction`` column, as a fitted model does.
    """
    rows = future_rows(history, days, keys, date, target)
    scored = predict(rows).withColumn("predicted_sales", F.col("prediction"))
    return with_bounds(scored).select(*keys, date, "predicted_sales", "lower_bound", "upper_bound")


def member_intervals(df: DataFrame, members: Sequence[str]) -> DataFrame:
    """Mean of the members with symmetric normal intervals from their spread.

    The deviation is a tenth of the population deviation of the members in the row.
    """
    values = F.array(*[F.col(m).cast("double") for m in members])
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / len(members)
    spread = F.aggregate(
        values, F.lit(0.0), lambda a, x: a + (x - F.col("prediction")) * (x - F.col("prediction"))
    )
    out = df.withColumn("prediction", mean).withColumn(
        "__sd", F.sqrt(spread / len(members)) * 0.1
    )
    bounds = {}
    for level, z in Z_SCORES.items():
        bounds[f"ci_{level}_lower"] = F.col("prediction") - z * F.col("__sd")
        bounds[f"ci_{level}_upper"] = F.col("prediction") + z * F.col("__sd")
    return out.withColumns(bounds).drop("__sd")


def checked_requests(requests: DataFrame, date: str = "date") -> DataFrame:
    """Parse the request date; a request with a bad date is kept with its ``error``."""
    parsed = F.try_to_date(F.col(date), "yyyy-MM-dd")
    error = F.when(parsed.isNull(), F.concat(F.lit("invalid date: "), F.coalesce(date, F.lit("null"))))
    return requests.withColumn("error", error).withColumn(date, parsed)


def score_requests(
    requests: DataFrame,
    history: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    extras: Sequence[str] = (),
) -> DataFrame:
    """Score valid requests with the latest features of their series.

    ``extras`` names entries of the map column ``additional_features`` that become columns, in
    place of the request defaults.
    """
    good = checked_requests(requests, date).where(F.col("error").isNull()).drop("error")
    if extras:
        given = {e: F.element_at("additional_features", F.lit(e)).try_cast("double") for e in extras}
        good = good.withColumns(
            {e: F.coalesce(v, F.lit(REQUEST_DEFAULTS.get(e)).cast("double")) for e, v in given.items()}
        )
    state = last_window(history, keys, date, target).drop("last_date")
    return predict(request_features(per_group(good, state, keys), date))


def deterministic_sample(df: DataFrame, size: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``size`` rows, chosen by a hash of the key: the same rows on every run."""
    place = F.xxhash64(F.lit(seed), *[F.col(k).cast("string") for k in keys])
    return df.orderBy(place, *keys).limit(size)
