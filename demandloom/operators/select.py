"""Model ranking, comparison, promotion, and tables built from flat metric names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.config import CHECKS, METRICS

# Compared metrics with the direction that counts as better.
COMPARED = {"rmse": "lower", "mae": "lower", "r2": "higher"}

# Metrics that all have to improve for a promotion.
DECISIVE = ("rmse", "mae")


def leaderboard(
    metrics: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("mae", "rmse", "wape")
) -> DataFrame:
    """Rank the models by MAE, then RMSE, then WAPE, missing values last."""
    groups = list(by) or [F.lit(0)]
    ranking = Window.partitionBy(*groups).orderBy(*[F.asc_nulls_last(c) for c in order], "model")
    return metrics.withColumn("rank", F.row_number().over(ranking))


def best_by_metric(
    metrics: DataFrame, names: Sequence[str] = ("mae", "rmse", "wape", "bias")
) -> DataFrame:
    """Best model per metric; for the bias the one closest to zero."""

    def distance(name: str) -> Column:
        return F.abs(name) if name == "bias" else F.col(name)

    wide = metrics.agg(*[F.min_by("model", distance(n)).alias(n) for n in names])
    return wide.unpivot([], list(names), "metric", "model")


def best_model(metrics: DataFrame, metric: str = "rmse") -> DataFrame:
    return metrics.agg(
        F.min_by("model", metric).alias("model"), F.min(metric).alias(metric)
    )


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most important features of each model."""
    order = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return importances.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def latest_run(runs: DataFrame, by: Sequence[str] = (), status: str = "FINISHED") -> DataFrame:
    """Newest finished run."""
    return (
        runs.where(F.col("status") == status)
        .groupBy(*by)
        .agg(F.max_by("run_id", "start_time").alias("run_id"), F.max("start_time").alias("start_time"))
    )


def best_run(run_metrics: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    """Run with the best value of a fully named metric, from ``run_id, key, value``."""
    rows = run_metrics.where(F.col("key") == metric)
    pick, edge = (F.min_by, F.min) if ascending else (F.max_by, F.max)
    return rows.agg(pick("run_id", "value").alias("run_id"), edge("value").alias("value"))


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Highest version number per model, within a stage when given."""
    rows = versions if stage is None else versions.where(F.col("stage") == stage)
    number = F.col("version").cast("int")
    return rows.groupBy("model").agg(
        F.max(number).alias("version"),
        F.max_by("run_id", number).alias("run_id"),
        F.max_by("stage", number).alias("stage"),
    )


def compare_metrics(
    production: DataFrame,
    candidate: DataFrame,
    compared: Mapping[str, str] = COMPARED,
    threshold: float = 0.01,
) -> DataFrame:
    """Candidate against production per shared metric, from long ``model, metric, value`` tables.

    ``improvement`` is in percent; ``improved`` also needs it to reach ``threshold``.
    """
    direction = F.create_map(*[F.lit(x) for pair in compared.items() for x in pair])
    both = (
        production.select("model", "metric", F.col("value").alias("production"))
        .join(candidate.select("model", "metric", F.col("value").alias("candidate")), ["model", "metric"])
        .where(F.col("metric").isin(*compared))
        .withColumn("direction", F.element_at(direction, F.col("metric")))
    )
    old, new = F.col("production"), F.col("candidate")
    lower = F.col("direction") == "lower"
    gain = F.when(lower, F.try_divide(old - new, old)).otherwise(F.try_divide(new - old, F.abs(old)))
    better = F.when(lower, new < old).otherwise(new > old)
    return both.withColumns(
        {
            "improvement": gain * 100,
            "is_better": better.cast("int"),
            "improved": (better & (F.abs(gain) >= threshold)).cast("int"),
        }
    )


def promotion_decisions(
    candidates: DataFrame,
    production: DataFrame,
    comparison: DataFrame,
    first_deployment: bool = False,
    allow_uncompared: bool = False,
) -> DataFrame:
    """Promote where every decisive metric that both sides report has improved.

    A model without production version is promoted only with ``first_deployment``. Without any
    shared decisive metric there is no promotion, unless ``allow_uncompared``.
    """
    decisive = F.col("metric").isin(*DECISIVE)
    verdict = comparison.groupBy("model").agg(
        F.count_if(decisive).alias("__compared"),
        F.count_if(decisive & (F.col("improved") == 1)).alias("__improved"),
        F.sum("improved").alias("n_improved"),
        F.count(F.lit(1)).alias("n_compared"),
    )
    existing = production.select("model").distinct().withColumn("__exists", F.lit(True))
    names = candidates.select("model").distinct()
    joined = names.join(existing, "model", "left").join(verdict, "model", "left")
    compared = F.coalesce("__compared", F.lit(0))
    all_better = compared == F.coalesce("__improved", F.lit(0))
    better = all_better if allow_uncompared else all_better & (compared > 0)
    known = F.coalesce("__exists", F.lit(False))
    reason = (
        F.when(~known & F.lit(first_deployment), "First deployment")
        .when(~known, "No production model to compare against")
        .when(better, "Performance improved")
        .otherwise("Performance not improved sufficiently")
    )
    return joined.select(
        "model",
        F.when(known, better).otherwise(F.lit(first_deployment)).cast("int").alias("promoted"),
        reason.alias("reason"),
        F.coalesce("n_improved", F.lit(0)).alias("n_improved"),
        F.coalesce("n_compared", F.lit(0)).alias("n_compared"),
    )


def apply_promotions(versions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Versions with the newest one of each promoted model in production, its forerunner archived."""
    newest = versions.groupBy("model").agg(F.max(F.col("version").cast("int")).alias("__newest"))
    chosen = decisions.where("promoted = 1").select("model", F.lit(True).alias("__go"))
    joined = versions.join(newest, "model").join(chosen, "model", "left")
    go = F.coalesce("__go", F.lit(False))
    stage = (
        F.when(go & (F.col("version").cast("int") == F.col("__newest")), "Production")
        .when(go & (F.col("stage") == "Production"), "Archived")
        .otherwise(F.col("stage"))
    )
    return joined.withColumn("stage", stage).select(*versions.columns)


def long_metrics(
    metrics: DataFrame, ids: Sequence[str] = ("model",), names: Sequence[str] = METRICS
) -> DataFrame:
    return metrics.select(*ids, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        list(ids), list(names), "metric", "value"
    )


def horizon_pivot(table: DataFrame, metric: str, horizons: Sequence[int]) -> DataFrame:
    """Model by horizon for one metric."""
    pivoted = table.groupBy("model").pivot("horizon", [int(h) for h in horizons])
    return pivoted.agg(F.max(metric)).withColumnsRenamed({str(int(h)): f"h{int(h)}" for h in horizons})


HORIZON_KEY = r"^(.*)_h(\d+)_([a-z0-9]+)$"


def _metric_key() -> str:
    return rf"^(.+)_({'|'.join(METRICS)})$"


def holdout_keys(flat: DataFrame) -> DataFrame:
    """``{model}_{metric}`` entries as ``model, metric, value``.

    Quality, cross-validation and horizon entries are left out.
    """
    key = F.col("key")
    model = F.regexp_extract(key, _metric_key(), 1)
    plain = (
        ~key.startswith("fq_")
        & ~key.contains("_cv_")
        & ~key.rlike(r"_h\d+_[^_]*$")
        & key.rlike(_metric_key())
        & ~model.rlike(r"(_mean|_std)$")
    )
    return flat.where(plain).select(
        model.alias("model"), F.regexp_extract(key, _metric_key(), 2).alias("metric"), "value"
    )


def holdout_table(flat: DataFrame) -> DataFrame:
    """One row per model with its holdout metrics as columns."""
    rows = holdout_keys(flat)
    return rows.groupBy("model").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in METRICS]
    )


def horizon_keys(flat: DataFrame) -> DataFrame:
    """``{model}_h{N}_{metric}`` entries as ``model, horizon, metric, value``."""
    key = F.col("key")
    rows = flat.where(key.rlike(HORIZON_KEY)).select(
        F.regexp_extract(key, HORIZON_KEY, 1).alias("model"),
        F.regexp_extract(key, HORIZON_KEY, 2).cast("int").alias("horizon"),
        F.regexp_extract(key, HORIZON_KEY, 3).alias("metric"),
        "value",
    )
    return rows.where(F.col("metric").isin("rmse", "mae", "wape", "bias", "mape"))


def quality_keys(flat: DataFrame, prefix: str = "fq") -> DataFrame:
    """``fq_{model}[_{check}]_status`` entries as ``model, check, status, code``."""
    key = F.col("key")
    body = F.regexp_extract(key, rf"^{prefix}_(.+)_status$", 1)
    names = "|".join(CHECKS)
    check = F.regexp_extract(body, rf"_({names})$", 1)
    rows = flat.where(key.rlike(rf"^{prefix}_.+_status$") & (key != f"{prefix}_overall_status"))
    model = F.when(check == "", body).otherwise(F.regexp_replace(body, rf"_({names})$", ""))
    label = F.when(F.col("value") == 0, "PASS").when(F.col("value") == 1, "WARNING")
    return rows.select(
        model.alias("model"),
        F.when(check == "", "model_summary").otherwise(check).alias("check"),
        label.when(F.col("value") == 2, "FAIL").otherwise("?").alias("status"),
        F.col("value").alias("code"),
    )


def flat_metrics(metrics: DataFrame, names: Sequence[str] = METRICS) -> DataFrame:
    """``model`` rows as ``{model}_{metric}`` entries."""
    rows = long_metrics(metrics, ("model",), names).where(F.col("value").isNotNull())
    return rows.select(F.concat_ws("_", "model", "metric").alias("key"), "value")


def flat_horizon_metrics(
    table: DataFrame, names: Sequence[str] = ("rmse", "mae", "wape", "mape", "bias")
) -> DataFrame:
    """Horizon rows as ``{model}_h{N}_{metric}`` entries."""
    rows = long_metrics(table, ("model", "horizon"), names).where(F.col("value").isNotNull())
    key = F.concat(F.col("model"), F.lit("_h"), F.col("horizon"), F.lit("_"), F.col("metric"))
    return rows.select(key.alias("key"), "value")
