"""Forecast accuracy, fold and horizon aggregates, residual statistics."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import METRICS
from demandloom.operators.quantiles import quartile_bounds
from demandloom.plans.tables import finite, range_slices, scalar_stats


def _residual() -> Column:
    return F.col("actual") - F.col("prediction")


def metric_columns(
    actual: str = "actual", prediction: str = "prediction"
) -> dict[str, Column]:
    """The six accuracy metrics as aggregate expressions.

    R2 uses the merged central moments of the actuals, never a difference of large squares.
    Actuals next to zero do not enter the MAPE.
    """
    pair = F.col(prediction).isNotNull() & F.col(actual).isNotNull()
    y, p = F.when(pair, F.col(actual)), F.when(pair, F.col(prediction))
    error = p - y
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    size = F.sum(F.abs(y))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(F.when(F.abs(y) >= 1e-8, F.abs(error / y))) * 100,
        "wape": F.when(size > 0, F.sum(F.abs(error)) / size * 100),
        "bias": F.avg(error),
        "r2": F.when(F.count(y) < 2, None)
        .when(spread == 0, F.when(squares == 0, 1.0).otherwise(0.0))
        .otherwise(1 - squares / spread),
    }


def predicted_only(scored: DataFrame) -> DataFrame:
    """Rows without a prediction stay, so that their model does, but no metric counts them."""
    return scored.withColumn("actual", F.when(F.col("prediction").isNotNull(), F.col("actual")))


def forecast_metrics(
    scored: DataFrame,
    by: Sequence[str] = ("model",),
    metrics: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Metrics per group of a long scored table ``actual, prediction``, in one aggregation."""
    chosen = metrics if metrics is not None else metric_columns()
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in chosen.items()])


def fold_aggregates(
    folds: DataFrame, by: Sequence[str] = ("model",), metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Mean, population deviation, minimum and maximum over folds, plus ``n_folds``.

    A metric missing in any fold leaves that metric's aggregates null.
    """
    whole = {m: F.count(m) == F.count(F.lit(1)) for m in metrics}
    parts = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    return folds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_folds"),
        *[F.when(whole[m], fn(m)).alias(f"{m}_{p}") for m in metrics for p, fn in parts.items()],
    )


def by_horizon(
    steps: DataFrame, horizons: Sequence[int], by: Sequence[str] = ("model", "fold_id")
) -> DataFrame:
    """Metrics of every forecast prefix: a row at ``step`` counts for each horizon >= step."""
    wanted = F.array(*[F.lit(int(h)) for h in sorted({int(h) for h in horizons})])
    reach = F.filter(wanted, lambda h: h >= F.col("step"))
    return forecast_metrics(steps.withColumn("horizon", F.explode(reach)), [*by, "horizon"])


def horizon_table(per_fold: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Model by horizon: mean of each metric over the folds, deviations, number of folds."""
    agg = fold_aggregates(per_fold, [*by, "horizon"])
    means = [F.col(f"{m}_mean").alias(m) for m in ("rmse", "mae", "wape", "mape", "bias")]
    stds = [f"{m}_std" for m in ("rmse", "mae", "wape", "bias")]
    return agg.select(*by, "horizon", "n_folds", *means, *stds)


def prediction_diagnostics(scored: DataFrame) -> DataFrame:
    """Spread of predictions and residuals per model, with counts of extreme predictions."""
    ends = scalar_stats(scored, low=F.min("actual"), high=F.max("actual"))
    residual, prediction = _residual(), F.col("prediction")
    metric = metric_columns()
    return (
        scored.withColumn("__ends", ends)
        .groupBy("model")
        .agg(
            F.avg(prediction).alias("pred_mean"),
            F.stddev_pop(prediction).alias("pred_std"),
            F.count_if(prediction < F.col("__ends.low") * 0.5).alias("extreme_low_count"),
            F.count_if(prediction > F.col("__ends.high") * 1.5).alias("extreme_high_count"),
            F.avg(residual).alias("residual_mean"),
            F.stddev_samp(residual).alias("residual_std"),
            *[metric[m].alias(m) for m in ("mape", "wape", "bias")],
        )
    )


def error_histogram(
    df: DataFrame, value: Column, bins: int = 50, by: Sequence[str] = ("model",)
) -> DataFrame:
    """Equal-width histogram per group: ``bin, left, right, n, density``.

    The bins of a group span its own minimum to maximum; the maximum falls in the last bin.
    """
    data = df.select(*by, value.cast("double").alias("__v")).where(finite(F.col("__v")))
    ends = data.groupBy(*by).agg(
        F.min("__v").alias("__a"), F.max("__v").alias("__b"), F.count(F.lit(1)).alias("__n")
    )
    ends = ends.withColumns(
        {
            "__a": F.when(F.col("__a") == F.col("__b"), F.col("__a") - 0.5).otherwise(F.col("__a")),
            "__b": F.when(F.col("__a") == F.col("__b"), F.col("__b") + 0.5).otherwise(F.col("__b")),
        }
    )
    tagged = data.join(ends, list(by))
    width = (F.col("__b") - F.col("__a")) / bins
    place = F.floor((F.col("__v") - F.col("__a")) / width)
    counted = (
        tagged.withColumn("bin", F.least(F.lit(bins - 1).cast("long"), place))
        .groupBy(*by, "__a", "__b", "__n", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        *by,
        "bin",
        (F.col("__a") + F.col("bin") * width).alias("left"),
        (F.col("__a") + (F.col("bin") + 1) * width).alias("right"),
        "n",
        (F.col("n") / (F.col("__n") * width)).alias("density"),
    )


def residual_box(scored: DataFrame) -> DataFrame:
    """Box-plot statistics of the residuals per model."""
    data = scored.select("model", _residual().alias("residual")).where(finite(F.col("residual")))
    bounds = quartile_bounds(data, "residual", ["model"], few_keys=True)
    # One row per model.
    tagged = data.join(F.broadcast(bounds), "model")
    inside = F.col("residual").between(F.col("lower_bound"), F.col("upper_bound"))
    return tagged.groupBy("model", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("residual"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("residual"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


# Coefficients of the rational approximations of the normal quantile in the published
# algorithm AS 241 (PPND16), numerator and denominator from the constant upwards.
QUANTILE_CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
QUANTILE_FLANK = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
QUANTILE_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(x: Column, pair: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    top, bottom = (functools.reduce(lambda acc, c: acc * x + c, reversed(p[:-1]), F.lit(p[-1])) for p in pair)
    return top / bottom


def normal_quantile(share: Column) -> Column:
    """Inverse of the standard normal distribution function; null outside (0, 1)."""
    q = share - 0.5
    centre = q * _ratio(F.lit(0.180625) - q * q, QUANTILE_CENTRE)
    # ln(0) and ln of what is negative are null.
    r = F.sqrt(-F.ln(F.least(share, 1 - share)))
    outer = F.when(r <= 5, _ratio(r - 1.6, QUANTILE_FLANK)).otherwise(_ratio(r - 5.0, QUANTILE_TAIL))
    inside = (share > 0) & (share < 1)
    return F.when(inside, F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer))


#: Equal residuals that one task writes out at a time.
EQUAL_ROWS = 1_000_000


def qq_points(scored: DataFrame) -> DataFrame:
    """Normal quantile-quantile points of the residuals per model: ``theoretical, ordered``.

    Residuals are counted per value first. Ranks come from range slices of the values, so neither a
    model's residuals nor many equal ones are sorted in one task; equal ones take successive ranks.
    """
    data = scored.select("model", _residual().alias("ordered")).where(finite(F.col("ordered")))
    values = data.groupBy("model", "ordered").agg(F.count(F.lit(1)).alias("__c"))
    sliced = range_slices(values, ["model", "ordered"])
    sizes = sliced.groupBy("model", "__slice").agg(F.sum("__c").alias("__s"))
    slices = Window.partitionBy("model").orderBy("__slice")
    earlier = F.coalesce(F.sum("__s").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(
        "model", "__slice", earlier.alias("__skip"), F.sum("__s").over(Window.partitionBy("model")).alias("__n")
    )
    inside = Window.partitionBy("model", "__slice").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)
    begun = sliced.withColumn("__i", F.coalesce(F.sum("__c").over(inside), F.lit(0))).join(sizes, ["model", "__slice"])
    last = F.col("__c") - 1
    parts = begun.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(EQUAL_ROWS).cast("long"))))
    upto = F.least(last, F.col("__from") + EQUAL_ROWS - 1)
    each = parts.hint("rebalance").withColumn("__at", F.explode(F.sequence("__from", upto)))
    rank, n = F.col("__skip") + F.col("__i") + F.col("__at") + 1, F.col("__n")
    top = F.pow(F.lit(0.5), 1.0 / n)
    share = (
        F.when(rank == n, top).when(rank == 1, 1 - top).otherwise((rank - 0.3175) / (n + 0.365))
    )
    return each.select("model", normal_quantile(share).alias("theoretical"), "ordered")


def split_shift(parts: DataFrame, target: str = "sales", limit: float = 0.2) -> DataFrame:
    """Mean and deviation of the target per split, and its shift against the training mean."""
    stats = parts.groupBy("split").agg(
        F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.count(target).alias("n")
    )
    base = scalar_stats(parts.where("split = 'train'"), mean=F.avg(target))
    shift = F.try_divide(F.abs(F.col("mean") - F.col("__base.mean")), F.col("__base.mean"))
    return (
        stats.withColumn("__base", base)
        .withColumn("mean_shift", shift)
        .withColumn("shifted", (F.col("mean_shift") > limit).cast("int"))
        .drop("__base")
    )


def leakage(
    df: DataFrame, features: Sequence[str], target: str = "sales", limit: float = 0.95
) -> DataFrame:
    """Correlation of every feature with the target; above ``limit`` it is flagged."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target)).alias(c) for c in features])
    return wide.unpivot([], list(features), "feature", "correlation").withColumn(
        "leaks", (F.abs("correlation") > limit).cast("int")
    )


def regressor_choice(
    df: DataFrame, columns: Sequence[str], top: int = 5
) -> DataFrame:
    """The columns with the largest variance, constant ones left out."""
    wide = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column", "variance").where("variance > 0")
    return long.orderBy(F.desc("variance"), "column").limit(top)


def recommendations(
    parts: DataFrame, features: Sequence[str], target: str = "sales"
) -> DataFrame:
    """Findings worth acting on, as rows ``topic, value``."""
    train = parts.where("split = 'train'")
    n_leaks = scalar_stats(leakage(train, features, target), n=F.sum("leaks"))
    sizes = train.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(target) == 0).alias("zeros")
    ).withColumn("leaks", n_leaks.getField("n"))
    rules = [
        ("small_training_set", F.col("rows"), F.col("rows") < 1000),
        ("many_features", F.lit(len(features)), F.lit(len(features) > 50)),
        ("many_zero_targets", F.col("zeros"), F.col("zeros") > F.col("rows") * 0.1),
        ("possible_leakage", F.col("leaks"), F.col("leaks") > 0),
    ]
    structs = [
        F.struct(F.lit(t).alias("topic"), v.cast("double").alias("value"), hit.alias("hit"))
        for t, v, hit in rules
    ]
    direct = sizes.select(F.inline(F.array(*structs))).where("hit").drop("hit")
    shifts = split_shift(parts, target).where("shifted = 1 and split <> 'train'")
    moved = shifts.select(
        F.concat(F.lit("distribution_shift_"), "split").alias("topic"),
        F.col("mean_shift").alias("value"),
    )
    return direct.unionByName(moved)


def forecast_summary(
    forecast: DataFrame, by: Sequence[str] = (), value: str = "predicted_sales"
) -> DataFrame:
    return forecast.groupBy(*by).agg(
        F.sum(value).alias("total_predicted_sales"),
        F.avg(value).alias("average_daily_sales"),
        F.max(value).alias("max_daily_sales"),
        F.min(value).alias("min_daily_sales"),
    )


def metric_alerts(metrics: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Metrics above their alert limit: ``model, metric, value, limit``."""
    checks = [
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(float(v)).alias("limit"))
        for m, v in limits.items()
    ]
    long = metrics.select("model", F.inline(F.array(*checks)))
    return long.where(F.col("value") > F.col("limit"))
