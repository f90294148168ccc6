"""Forecast quality gate: seven checks per model, graded PASS, WARNING or FAIL.

Input is one long scored table ``date [, entity], model, actual, prediction``; all models are
checked in the same pass. A status is kept as its code 0, 1 or 2 and named at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.config import CHECKS, QualityThresholds
from demandloom.functions.calendar import wall_seconds
from demandloom.plans.tables import finite

# Status names by code.
STATUSES = ("PASS", "WARNING", "FAIL")

# Length of a calendar step in seconds.
STEP_SECONDS = {"D": 86_400, "W": 604_800, "h": 3_600, "15min": 900}


def status_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATUSES]), code + 1)


def grade(value: Column, warn: float, fail: float) -> Column:
    """2 at or above ``fail``, 1 at or above ``warn``, else 0."""
    return F.when(value >= fail, 2).when(value >= warn, 1).otherwise(0)


def _time_measures(
    scored: DataFrame, time: str, entity: Sequence[str], step: int
) -> DataFrame:
    """Per model: rows, null times, surplus (time, entity) rows, holes in the calendar."""
    cells = scored.groupBy("model", F.col(time).alias("__t"), *entity).agg(
        F.count(F.lit(1)).alias("__n")
    )
    times = cells.groupBy("model", "__t").agg(
        F.sum("__n").alias("__rows"), F.sum(F.col("__n") - 1).alias("__extra")
    )
    seconds = wall_seconds(F.col("__t"))
    starts = times.groupBy("model").agg(F.min(seconds).alias("__start"))
    placed = times.join(starts, "model")
    on_grid = (seconds - F.col("__start")) % step == 0
    return placed.groupBy("model").agg(
        F.sum("__rows").alias("n_rows"),
        F.sum("__extra").alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("__t").isNull(), F.col("__rows"))), F.lit(0)).alias("null_times"),
        F.count("__t").alias("n_times"),
        (
            F.floor((F.max(seconds) - F.min(seconds)) / step) + 1 - F.count_if(on_grid)
        ).alias("holes"),
    )


def _value_measures(scored: DataFrame) -> DataFrame:
    if "prediction" not in scored.columns:
        scored = scored.withColumn("prediction", F.lit(None).cast("double"))
    y, p = F.col("actual").try_cast("double"), F.col("prediction").try_cast("double")
    pair = finite(y) & finite(p)
    error = F.when(pair, p - y)
    size = F.when(pair, F.abs(y))
    return scored.groupBy("model").agg(
        F.count_if(y < 0).alias("negative_actuals"),
        F.count_if(p < 0).alias("negative_predictions"),
        (F.count_if(~finite(p)) / F.count(F.lit(1))).alias("missing_share"),
        F.count_if(pair).alias("n_points"),
        F.avg(error).alias("bias"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(F.abs(error)).alias("__abs_error"),
        F.sum(size).alias("__size"),
        F.avg(size).alias("__mean_size"),
    )


def quality_measures(
    scored: DataFrame,
    time: str = "date",
    entity: Sequence[str] = (),
    thresholds: QualityThresholds = QualityThresholds(),
) -> DataFrame:
    """The numbers behind the checks, one row per model."""
    step = STEP_SECONDS[thresholds.expected_freq or "D"]
    values = _value_measures(scored)
    scale = F.when(F.col("__mean_size") == 0, 1.0).otherwise(F.col("__mean_size"))
    values = values.withColumns(
        {
            "relative_bias": F.abs("bias") / scale,
            "relative_rmse": F.col("rmse") / scale,
            "wape": F.when(F.col("__size") > 0, F.col("__abs_error") / F.col("__size") * 100),
        }
    ).drop("__abs_error", "__size", "__mean_size")
    return _time_measures(scored, time, entity, step).join(values, "model")


def quality_checks(
    scored: DataFrame,
    time: str = "date",
    entity: Sequence[str] = (),
    thresholds: QualityThresholds = QualityThresholds(),
    models: Sequence[str] = (),
) -> DataFrame:
    """One row per model and check: ``model, check, code, status, metric_value, message``.

    A table without a ``prediction`` column is one of missing predictions. ``models`` names those
    that must be there: one without any row fails instead of having no report.
    """
    t = thresholds
    m = quality_measures(scored, time, entity, t)
    if models:
        named = scored.sparkSession.createDataFrame([(n,) for n in models], "model string")
        counts = [n for n in m.columns if m.schema[n].dataType.typeName() == "long"]
        m = named.join(m, "model", "full").na.fill(0, [*counts]).na.fill({"missing_share": 1.0})
    c = F.col
    few = c("n_times") < 2
    missing = F.when(few, c("null_times")).otherwise(c("holes") + c("null_times"))
    missing_code = F.when(c("n_rows") == 0, 2).when(few, F.when(c("null_times") > 0, 1).otherwise(0)).otherwise(
        grade(missing, t.missing_timestamp_warn, t.missing_timestamp_fail)
    )
    none = c("n_points") == 0
    bias_code = F.when(none, 2).otherwise(
        F.greatest(
            grade(F.abs("bias"), t.bias_warn, t.bias_fail),
            grade(c("relative_bias"), t.relative_bias_warn, t.relative_bias_fail),
        )
    )
    error_code = F.when(none, 2).otherwise(
        F.greatest(
            grade(c("rmse"), t.rmse_warn, t.rmse_fail),
            grade(c("mae"), t.mae_warn, t.mae_fail),
            grade(F.coalesce("wape", F.lit(0.0)), t.wape_warn, t.wape_fail),
            grade(c("relative_rmse"), t.relative_rmse_warn, t.relative_rmse_fail),
        )
    )
    no_pairs = F.lit("No finite actual/prediction pairs")
    bias_text = F.format_string("Forecast bias=%.4f (relative=%.4f)", "bias", "relative_bias")
    error_text = F.format_string(
        "Errors RMSE=%.4f, MAE=%.4f, WAPE=%.2f%%, rel_RMSE=%.4f",
        "rmse", "mae", F.coalesce("wape", F.lit(float("nan"))), "relative_rmse",
    )
    results = {
        "missing_timestamps": (
            missing_code,
            missing,
            F.when(few, F.lit("Not enough timestamps to detect gaps")).otherwise(
                F.format_string("Found %d missing timestamps", missing)
            ),
        ),
        "duplicate_timestamps": (
            grade(c("duplicates"), t.duplicate_timestamp_warn, t.duplicate_timestamp_fail),
            c("duplicates"),
            F.format_string("Found %d duplicate timestamps", "duplicates"),
        ),
        "negative_volumes": (
            grade(c("negative_actuals"), t.negative_volume_warn, t.negative_volume_fail),
            c("negative_actuals"),
            F.format_string("Found %d negative actual volumes", "negative_actuals"),
        ),
        "negative_predictions": (
            grade(c("negative_predictions"), t.negative_prediction_warn, t.negative_prediction_fail),
            c("negative_predictions"),
            F.format_string("Found %d negative predictions", "negative_predictions"),
        ),
        "missing_predictions": (
            grade(c("missing_share"), t.missing_prediction_warn, t.missing_prediction_fail),
            c("missing_share"),
            F.format_string("Missing/non-finite predictions: share %.4f", "missing_share"),
        ),
        "excessive_bias": (bias_code, c("bias"), F.when(none, no_pairs).otherwise(bias_text)),
        "abnormal_errors": (error_code, c("rmse"), F.when(none, no_pairs).otherwise(error_text)),
    }
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            code.cast("int").alias("code"),
            status_name(code).alias("status"),
            value.cast("double").alias("metric_value"),
            text.alias("message"),
        )
        for name, (code, value, text) in ((n, results[n]) for n in CHECKS)
    ]
    return m.select("model", F.inline(F.array(*rows)))


def quality_report(checks: DataFrame) -> DataFrame:
    """Worst status and number of checks per status, per model."""
    counts = [
        F.count_if(F.col("code") == code).alias(f"n_{name.lower()}")
        for code, name in enumerate(STATUSES)
    ]
    per_model = checks.groupBy("model").agg(F.max("code").alias("code"), *counts)
    return per_model.withColumn("status", status_name(F.col("code")))


def quality_summary(checks: DataFrame) -> DataFrame:
    """Check rows, a SUMMARY row per model and one OVERALL row."""
    report = quality_report(checks)
    detail = checks.select("model", "check", "status", "message", "metric_value").join(
        report.select("model", F.col("status").alias("model_summary")), "model"
    )
    nothing = F.lit(None).cast("double").alias("metric_value")
    per_model = report.select(
        "model",
        F.lit("SUMMARY").alias("check"),
        "status",
        F.format_string("pass=%d, warn=%d, fail=%d", "n_pass", "n_warning", "n_fail").alias("message"),
        nothing,
        F.col("status").alias("model_summary"),
    )
    worst = report.agg(F.max("code").alias("code"), F.count(F.lit(1)).alias("n"))
    overall = worst.select(
        F.lit("ALL").alias("model"),
        F.lit("OVERALL").alias("check"),
        status_name(F.coalesce("code", F.lit(0))).alias("status"),
        F.format_string("n_models=%d", "n").alias("message"),
        nothing,
        status_name(F.coalesce("code", F.lit(0))).alias("model_summary"),
    )
    return detail.unionByName(per_model).unionByName(overall)


def quality_metrics(checks: DataFrame, prefix: str = "fq") -> DataFrame:
    """Flat ``key, value`` metrics: status codes, counts and finite check values."""
    report = quality_report(checks)
    head = F.concat_ws("_", F.lit(prefix), "model")

    def pair(suffix: Column | str, value: Column) -> Column:
        tail = F.lit(suffix) if isinstance(suffix, str) else suffix
        return F.struct(
            F.concat_ws("_", head, tail).alias("key"), value.cast("double").alias("value")
        )

    counts = [pair(n, F.col(n)) for n in ("n_pass", "n_warning", "n_fail")]
    totals = report.select(F.inline(F.array(pair("status", F.col("code")), *counts)))
    name = F.col("check")
    single = checks.select(
        F.inline(
            F.array(
                pair(F.concat(name, F.lit("_status")), F.col("code")),
                pair(F.concat(name, F.lit("_value")), F.col("metric_value")),
            )
        )
    ).where(finite(F.col("value")))
    overall = report.agg(F.max("code").cast("double").alias("value")).select(
        F.lit(f"{prefix}_overall_status").alias("key"), "value"
    )
    return totals.unionByName(single).unionByName(overall)


def quality_text(checks: DataFrame) -> DataFrame:
    """The summary as text lines in reading order: ``model, place, line``."""
    report = quality_report(checks)
    order = F.create_map(*[x for i, n in enumerate(CHECKS) for x in (F.lit(n), F.lit(i + 1))])
    heads = report.select(
        "model", F.lit(0).alias("place"), F.format_string("[%s] %s", "status", "model").alias("line")
    )
    lines = checks.select(
        "model",
        F.element_at(order, F.col("check")).alias("place"),
        F.format_string("  - %s: %s - %s", "status", "check", "message").alias("line"),
    )
    return heads.unionByName(lines)
