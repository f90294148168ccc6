"""End-to-end flows: training review, forecast request, staffing plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.config import (
    CvConfig,
    FeatureConfig,
    HorizonConfig,
    QualityThresholds,
    SplitConfig,
    StaffingAssumptions,
    enabled_models,
)
from demandloom.operators import (
    ensemble,
    evaluate,
    features,
    learn,
    metrics,
    quality,
    scoring,
    select,
    split,
    staffing,
)
from demandloom.sources import panel as files


def prepared_panel(
    panel: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    feature_config: FeatureConfig = FeatureConfig(),
    split_config: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Features and chronological split of a training panel.

    The result is read by every later stage: write it or persist it once.
    """
    built = features.all_features(panel, target, keys, date, list(keys), feature_config)
    parts = split.chronological_split(built, keys, date, split_config)
    return parts.where(F.col(target).isNotNull())


def scored_members(
    parts: DataFrame,
    inputs: Sequence[str],
    presets: Mapping[str, Mapping[str, Any]] = learn.PRESETS,
    models: Mapping[str, Mapping[str, Any]] | None = None,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Validation and test predictions of every member, as one long table.

    Boosted members are fitted on the training rows and stopped by the validation rows.
    Classical members forecast the validation rows from training and the test rows from both.
    Columns: ``stage, keys, date, model, actual, prediction, error``; rows of a failed fit have
    ``error`` and no prediction.
    """
    columns = ["stage", *keys, date, "model", "actual", "prediction", "error"]
    fit = parts.where("split <> 'test'").withColumn("is_validation", F.col("split") == "val")
    held = parts.where("split <> 'train'")
    tables = []
    for name, params in presets.items():
        model = learn.boosted_trees(fit, inputs, target, params)
        tables.append(
            learn.predict(model, held).select(
                F.col("split").alias("stage"), *keys, date, F.lit(name).alias("model"),
                F.col(target).alias("actual"), "prediction", F.lit(None).cast("string").alias("error"),
            )
        )
    chosen = enabled_models() if models is None else models
    if chosen:
        classical = evaluate.holdout_scores(parts, chosen, keys, date, target)
        tables.append(classical.select(*columns))
    return reduce(DataFrame.unionByName, tables)


def with_ensemble(
    scored: DataFrame, keys: Sequence[str] = ("store_id",), date: str = "date"
) -> DataFrame:
    """Test rows of every member and of their ensemble, weighted by validation R2."""
    weights = ensemble.score_weights(metrics.predicted_only(scored.where("stage = 'val'")))
    test = scored.where("stage = 'test'").drop("stage")
    blended = ensemble.weighted_prediction(test, [*keys, date], weights)
    return test.unionByName(blended.withColumn("model", F.lit("ensemble")), allowMissingColumns=True)


def review_tables(
    parts: DataFrame,
    scored: DataFrame,
    models: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    cv: CvConfig = CvConfig(),
    horizons: HorizonConfig = HorizonConfig(),
    thresholds: QualityThresholds = QualityThresholds(),
) -> dict[str, DataFrame]:
    """The report tables of a training run, from its split panel and its scored holdout rows.

    ``scored`` is the long table ``date, keys, model, actual, prediction``. Cross-validation
    sees training and validation rows only.
    """
    seen = parts.where("split <> 'test'")
    folds = evaluate.classical_fold_scores(seen, cv, models, keys, date, target)
    ahead = evaluate.classical_fold_scores(seen, horizons, models, keys, date, target)
    holdout = metrics.forecast_metrics(metrics.predicted_only(scored))
    checks = quality.quality_checks(scored, date, keys, thresholds)
    return {
        "holdout": select.leaderboard(holdout),
        "fold_metrics": evaluate.fold_metrics(folds, [*keys, "model", "fold_id"]),
        "aggregated_metrics": evaluate.cross_validate(folds, keys),
        "horizon_summary": evaluate.multi_horizon(ahead, horizons),
        "diagnostics": metrics.prediction_diagnostics(scored),
        "split_shift": metrics.split_shift(parts, target),
        "quality_summary": quality.quality_summary(checks),
    }


def write_review(tables: Mapping[str, DataFrame], checks: DataFrame, path: str) -> None:
    """Write the report tables as CSV, all of them as JSON, and the quality text."""
    for name, table in tables.items():
        files.write_csv(table, f"{path}/{name}")
    files.write_report(dict(tables), f"{path}/report")
    lines = quality.quality_text(checks).orderBy("model", "place")
    files.write_lines(lines, f"{path}/quality_text")


def forecast_to_staffing(
    history: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    contacts_per_thousand: float,
    handle_time: float,
    days: int = 30,
    keys: Sequence[str] = ("store_id",),
    cfg: StaffingAssumptions = StaffingAssumptions(interval_seconds=86_400),
) -> DataFrame:
    """Forecast sales, turn them into contacts, and staff every forecast day."""
    forecast = scoring.forecast_request(history, predict, days, keys)
    demand = forecast.select(
        *keys,
        F.col("date").alias("timestamp"),
        staffing.contact_volume(F.col("predicted_sales"), contacts_per_thousand).alias("volume"),
        F.lit(float(handle_time)).alias("average_handle_time"),
        F.col("lower_bound").alias("forecast_lower"),
        F.col("upper_bound").alias("forecast_upper"),
        F.col("predicted_sales").alias("forecasted_demand"),
    )
    plan = staffing.staffing_gap(staffing.staffing_plan(demand, cfg))
    return staffing.volume_bounds(plan)


def forecast_review(spark: SparkSession, folder: str) -> DataFrame:
    """Seasonal-naive accuracy per store and horizon with the quality status of its forecasts."""
    from demandloom.catalog.tables import panel

    rows = panel(spark, folder)
    config = HorizonConfig()
    scores = evaluate.naive_fold_scores(rows, config, unfolded=True)
    table = evaluate.multi_horizon(scores, config, ["store_id"])
    gate = quality.quality_report(
        quality.quality_checks(
            scores.where("fold_id IS NOT NULL").withColumn("model", F.col("store_id")), entity=["fold_id"]
        )
    )
    status = gate.select(F.col("model").alias("store_id"), F.col("status").alias("quality"))
    return table.join(status, "store_id", "left").orderBy("store_id", "horizon")
