"""Rolling-origin and multi-horizon evaluation over many series at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.config import CvConfig, HorizonConfig
from demandloom.operators.forecast import SEASON, forecast_origins
from demandloom.operators.learn import boosted_trees, predict
from demandloom.operators.metrics import by_horizon, fold_aggregates, forecast_metrics, horizon_table
from demandloom.operators.split import (
    fold_rows,
    fold_sizes,
    panel_positions,
    rolling_origin_folds,
    series_positions,
    unfolded_series,
)
from demandloom.plans.tables import durable, per_group, whole_series


def _clean(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def _with_unfolded(
    scores: DataFrame, unfolded: DataFrame, keys: Sequence[str], models: Sequence[str]
) -> DataFrame:
    """The scores and, per model, one row with ``error`` for each series without a fold."""
    named = unfolded.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return scores.unionByName(named.select(*keys, "model", "error"), allowMissingColumns=True)


def naive_fold_scores(
    df: DataFrame,
    config: CvConfig | HorizonConfig,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    season: int = SEASON,
    unfolded: bool = False,
) -> DataFrame:
    """Seasonal-naive predictions of every test row of every fold.

    Step ``j`` of a fold repeats the value ``season * ceil(j / season)`` rows back, so all
    predictions are lags on the window that numbers the rows. No training row is copied. A fold with
    less than a season before it has its test rows with ``error`` and no prediction. With ``unfolded``
    a series too short for a fold has one row with ``error``; without, it has none.
    """
    longest = config.longest if isinstance(config, HorizonConfig) else config.horizon
    window = whole_series(keys, date)
    cycles = range(1, -(-longest // season) + 1)
    back = F.array(*[F.lag(target, season * c).over(window) for c in cycles])
    rows = series_positions(_clean(df, target), keys, date).withColumn("__back", back)
    sizes = fold_sizes(df, keys, target)
    folds = rolling_origin_folds(sizes, config, keys)
    step = (F.col("position") - F.col("test_start") + 1).cast("int")
    test = fold_rows(rows, folds, keys).withColumn("step", step)
    value = F.get("__back", F.floor((F.col("step") - 1) / season).cast("int"))
    enough = F.col("train_end") >= season
    short = F.format_string(f"Need at least {season} observations, got %d", F.col("train_end"))
    scores = test.select(
        *keys,
        F.lit("seasonal_naive").alias("model"),
        "fold_id",
        "train_end",
        "step",
        date,
        F.col(target).alias("actual"),
        F.when(enough, value).alias("prediction"),
        F.when(~enough, short).alias("error"),
    )
    if not unfolded:
        return scores
    return _with_unfolded(scores, unfolded_series(sizes, config, keys), keys, ["seasonal_naive"])


def panel_row_naive_scores(
    df: DataFrame,
    config: CvConfig,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    season: int = SEASON,
) -> DataFrame:
    """The same with folds that index the rows of the whole panel, sorted by (date, keys).

    Only the tail that the folds and their last season reach into is put in order; its length
    is set by the configuration, not by the data.
    """
    rows = _clean(df, target)
    folds = rolling_origin_folds(rows.agg(F.count(F.lit(1)).alias("n")), config, [])
    first = folds.agg(F.min("test_start").alias("first")).scalar()
    tail = panel_positions(rows, keys, date, first - season)
    ahead = folds.withColumns(
        {"test_start": F.col("train_end") - season, "test_end": F.col("train_end")}
    )
    pattern = fold_rows(tail, ahead, []).select(
        "fold_id",
        (F.col("position") - F.col("test_start")).alias("__slot"),
        F.col(target).alias("prediction"),
    )
    test = fold_rows(tail, folds, []).withColumn(
        "step", (F.col("position") - F.col("test_start") + 1).cast("int")
    )
    slotted = test.withColumn("__slot", ((F.col("step") - 1) % season).cast("long"))
    enough = F.col("train_end") >= season
    short = F.format_string(f"Need at least {season} observations, got %d", F.col("train_end"))
    return slotted.join(pattern, ["fold_id", "__slot"], "left").select(
        *keys, F.lit("seasonal_naive").alias("model"), "fold_id", "train_end", "step", date,
        F.col(target).alias("actual"), F.when(enough, F.col("prediction")).alias("prediction"),
        F.when(~enough, short).alias("error"),
    )


def classical_fold_scores(
    df: DataFrame,
    config: CvConfig | HorizonConfig,
    models: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Predictions of the fitted forecasters for every test row, with fit errors kept.

    A series too short for a fold has one row per model with ``error``.
    """
    rows = series_positions(_clean(df, target), keys, date)
    sizes = fold_sizes(df, keys, target)
    folds = rolling_origin_folds(sizes, config, keys)
    predicted = forecast_origins(df, folds, models, keys, date, target)
    actual = rows.select(*keys, "position", date, F.col(target).alias("actual"))
    ends = F.col("position") - F.col("step") + 1
    scores = predicted.join(actual, [*keys, "position"]).select(
        *keys, "model", "fold_id", ends.alias("train_end"), "step", date, "actual", "prediction",
        "error",
    )
    return _with_unfolded(scores, unfolded_series(sizes, config, keys), keys, list(models))


def learner_fold_scores(
    df: DataFrame,
    features: Sequence[str],
    config: CvConfig | HorizonConfig,
    presets: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    seed: int = 42,
) -> DataFrame:
    """Predictions of the boosted learners on folds of the panel sorted by (date, keys).

    One model covers all series, so the folds are a short loop of distributed fits over rows
    that are numbered and checkpointed once. The last tenth of each fold's training rows stops
    the boosting.
    """
    numbered = durable(
        panel_positions(_clean(df, target), keys, date).select(
            *keys, date, target, *[f for f in features if f not in keys], "position"
        )
    )
    sizes = numbered.agg(F.count(F.lit(1)).alias("n"))
    parts = []
    for fold in rolling_origin_folds(sizes, config, []).collect():
        end, stop = fold["train_end"], fold["test_end"]
        held = max(1, end // 10)
        late = F.col("position") >= (end - held if end > held + 5 else end)
        train = numbered.where(F.col("position") < end).withColumn("is_validation", late)
        test = numbered.where((F.col("position") >= end) & (F.col("position") < stop))
        for name, params in presets.items():
            model = boosted_trees(train, features, target, params, "is_validation", seed)
            parts.append(
                predict(model, test).select(
                    *keys,
                    F.lit(name).alias("model"),
                    F.lit(fold["fold_id"]).alias("fold_id"),
                    F.lit(end).alias("train_end"),
                    (F.col("position") - end + 1).cast("int").alias("step"),
                    date,
                    F.col(target).alias("actual"),
                    "prediction",
                )
            )
    if not parts:
        raise ValueError("Not enough rows for a fold")
    return reduce(DataFrame.unionByName, parts)


def fold_metrics(
    scores: DataFrame, by: Sequence[str] = ("store_id", "model", "fold_id")
) -> DataFrame:
    """Metrics per fold; a fold without predictions is left out, the others stay."""
    return forecast_metrics(scores.where(F.col("prediction").isNotNull()), by)


def cross_validate(
    scores: DataFrame, keys: Sequence[str] = ("store_id",)
) -> DataFrame:
    """Mean, deviation, minimum and maximum of each metric over the folds of a series.

    A series without a scored fold stays with ``n_folds`` 0 and no metrics. ``error`` has one of the
    messages of the folds left out, if any.
    """
    by = [*keys, "model"]
    means = fold_aggregates(fold_metrics(scores, [*by, "fold_id"]), by)
    errors = _errors(scores, by)
    return per_group(errors, means, by).withColumn("n_folds", F.coalesce("n_folds", F.lit(0)))


def _errors(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, error`` for every group, with or without predictions."""
    error = F.col("error") if "error" in scores.columns else F.lit(None).cast("string")
    # Fresh aliases, because the other side descends from the same scores.
    return scores.groupBy(*[F.col(c).alias(c) for c in by]).agg(F.max(error).alias("error"))


def multi_horizon(
    scores: DataFrame, config: HorizonConfig = HorizonConfig(), keys: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and bias per model and horizon, averaged over the folds.

    A group without predictions stays at every horizon with ``n_folds`` 0. ``error`` has one of the
    messages of the series and folds left out, if any.
    """
    by = [*keys, "model"]
    known = scores.where(F.col("prediction").isNotNull())
    table = horizon_table(by_horizon(known, config.horizons, [*by, "fold_id"]), by)
    horizons = F.array(*[F.lit(int(h)) for h in sorted(set(config.horizons))])
    groups = _errors(scores, by).withColumn("horizon", F.explode(horizons))
    return per_group(groups, table, [*by, "horizon"]).withColumn("n_folds", F.coalesce("n_folds", F.lit(0)))


def holdout_scores(
    parts: DataFrame,
    models: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Forecast the validation rows from training, and the test rows from both.

    ``parts`` carries ``split``. Adds ``stage`` (``val`` or ``test``) to the scores.
    """
    rows = series_positions(_clean(parts, target), keys, date)
    sizes = rows.groupBy(*keys).agg(
        *[F.count_if(F.col("split") == s).cast("int").alias(s) for s in ("train", "val", "test")]
    )
    stages = F.array(
        F.struct(
            F.lit(0).alias("fold_id"),
            F.col("train").cast("long").alias("train_end"),
            F.col("val").alias("horizon"),
        ),
        F.struct(
            F.lit(1).alias("fold_id"),
            (F.col("train") + F.col("val")).cast("long").alias("train_end"),
            F.col("test").alias("horizon"),
        ),
    )
    origins = sizes.select(*keys, F.inline(stages)).where("horizon > 0")
    predicted = forecast_origins(parts, origins, models, keys, date, target)
    actual = rows.select(*keys, "position", date, F.col(target).alias("actual"))
    stage = F.when(F.col("fold_id") == 0, "val").otherwise("test")
    return predicted.join(actual, [*keys, "position"]).select(
        *keys, stage.alias("stage"), "model", "step", date, "actual", "prediction", "error"
    )
