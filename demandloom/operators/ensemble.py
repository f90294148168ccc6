"""Ensembles over a long scored table ``keys, model, actual, prediction``."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.operators.metrics import forecast_metrics

# Fixed value: penalty of the lasso and elastic-net meta-models.
PENALTY = 0.01


def score_weights(validation: DataFrame, floor: float = 0.05) -> DataFrame:
    """Weights from validation R2, each at least ``floor`` before they are made to sum to 1."""
    everything = Window.partitionBy(F.lit(0))  # one row per model
    scores = forecast_metrics(validation).select("model", "r2")
    shifted = scores.withColumn("__s", F.greatest(F.lit(0.0), F.col("r2")) + 1e-6)
    share = F.greatest(F.lit(floor), F.col("__s") / F.sum("__s").over(everything))
    floored = shifted.withColumn("__w", share)
    return floored.select(
        "model", "r2", (F.col("__w") / F.sum("__w").over(everything)).alias("weight")
    )


def deployable_weights(weights: DataFrame, members: Sequence[str]) -> DataFrame:
    """Keep the named members and make their weights sum to 1 again."""
    kept = weights.where(F.col("model").isin(*members))
    total = F.sum("weight").over(Window.partitionBy(F.lit(0)))
    return kept.withColumn("weight", F.col("weight") / F.when(total == 0, 1.0).otherwise(total))


def weighted_prediction(
    scored: DataFrame, keys: Sequence[str], weights: DataFrame | None = None
) -> DataFrame:
    """Weighted mean over the members of each row; a member without weight is left out."""
    if weights is None:
        tagged = scored.withColumn("weight", F.lit(1.0))
    else:
        # One row per model, a number set by the run's settings.
        tagged = scored.join(F.broadcast(weights.select("model", "weight")), "model")
    used = tagged.where((F.col("weight") > 0) & F.col("prediction").isNotNull())
    return used.groupBy(*keys).agg(
        F.max("actual").alias("actual"),
        (F.sum(F.col("weight") * F.col("prediction")) / F.sum("weight")).alias("prediction"),
    )


def mean_prediction(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain mean of the members that made a prediction."""
    return scored.groupBy(*keys).agg(
        F.max("actual").alias("actual"), F.avg("prediction").alias("prediction")
    )


def dynamic_prediction(
    scored: DataFrame,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    reach: int = 30,
    fewest: int = 10,
) -> DataFrame:
    """Weights from the error in the rows around each row: inverse local mean absolute error.

    Where fewer than ``fewest`` errors are near, all members count the same. A member without a
    prediction has no weight in that row; without any member the prediction is null.
    """
    near = Window.partitionBy(*keys, "model").orderBy(date).rowsBetween(-reach, reach - 1)
    error = F.abs(F.col("prediction") - F.col("actual"))
    weight = F.when(F.count(error).over(near) < fewest, 1.0).otherwise(
        1.0 / (F.avg(error).over(near) + 1e-6)
    )
    tagged = scored.withColumn("__w", F.when(F.col("prediction").isNotNull(), weight))
    return tagged.groupBy(*keys, date).agg(
        F.max("actual").alias("actual"),
        (F.sum(F.col("__w") * F.col("prediction")) / F.sum("__w")).alias("prediction"),
    )


def member_columns(scored: DataFrame, keys: Sequence[str], members: Sequence[str]) -> DataFrame:
    """One column per member, rows with every member present."""
    return _wide(scored, keys, members).na.drop(subset=["actual", *members])


def _wide(scored: DataFrame, keys: Sequence[str], members: Sequence[str]) -> DataFrame:
    """One column per member, every row."""
    return scored.groupBy(*keys).agg(
        F.max("actual").alias("actual"),
        *[F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(m) for m in members],
    )


def _absent(members: Sequence[str]) -> Column:
    """The names of the members that a wide row lacks; null where none is."""
    names = F.concat_ws(", ", *[F.when(F.col(m).isNull() | F.isnan(m), F.lit(m)) for m in members])
    return F.when(names != "", F.concat(F.lit("Absent: "), names))


def _gram(wide: DataFrame, inputs: Sequence[Column]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centred second moments of the inputs and the actual: one aggregate row.

    Covariances are merged from partial aggregates, so nothing cancels. The row has
    ``(k + 1)(k + 4) / 2`` numbers for ``k`` inputs, independent of the data size.
    """
    cols = [*inputs, F.col("actual")]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = wide.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    k = len(cols)
    cov = np.zeros((k, k))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"]
    means = np.array([row[f"m{i}"] for i in range(k)])
    return cov, means, cov[: k - 1, k - 1], float(row["n"])


def _simplex(v: np.ndarray) -> np.ndarray:
    """Nearest point with non-negative parts that sum to 1."""
    u = np.sort(v)[::-1]
    excess = (np.cumsum(u) - 1) / np.arange(1, len(v) + 1)
    return np.maximum(v - excess[np.flatnonzero(u > excess)[-1]], 0)


def _least_on_simplex(quad: np.ndarray, rounds: int = 20_000) -> np.ndarray:
    """Minimise ``w' quad w`` over the simplex by accelerated projected gradient steps."""
    w = ahead = np.full(len(quad), 1.0 / len(quad))
    rate = 1.0 / max(np.linalg.eigvalsh(quad)[-1], 1e-300)
    pace = 1.0
    for _ in range(rounds):
        moved = _simplex(ahead - rate * (quad @ ahead))
        if (ahead - moved) @ (moved - w) > 0:
            pace = 1.0
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / quicker * (moved - w)
        settled, w, pace = np.abs(moved - w).max() < 1e-13, moved, quicker
        if settled:
            break
    return w


def _least_absolute(wide: DataFrame, errors: Sequence[Column], steps: int = 30) -> np.ndarray:
    """Weights on the simplex with the least mean absolute error of the blend, by reweighting.

    A step is one aggregate row: the error of the weights so far, and the second moments with rows
    weighted by one over their error there. The best weights that were measured are returned.
    """
    k = len(errors)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    w, least, best, weight = np.full(k, 1.0 / k), np.inf, np.full(k, 1.0 / k), F.lit(1.0)
    rows = wide.persist()
    for step in range(steps):
        error = F.abs(sum(e * float(x) for e, x in zip(errors, w)))
        if np.isfinite(least):
            weight = 1 / F.greatest(error, F.lit(1e-4 * least))
        row = rows.agg(
            F.avg(error).alias("mae"), *[F.avg(errors[i] * errors[j] * weight).alias(f"q{i}_{j}") for i, j in pairs]
        ).first()
        if not row["mae"]:  # no rows, or no error left
            best = w
            break
        if row["mae"] < least:
            least, best = row["mae"], w
        quad = np.zeros((k, k))
        for i, j in pairs:
            quad[i, j] = quad[j, i] = row[f"q{i}_{j}"]
        moved = _least_on_simplex(quad)
        if step and np.abs(moved - w).max() < 1e-6:
            break
        w = moved
    rows.unpersist()
    return best


def blend_weights(
    scored: DataFrame, keys: Sequence[str], members: Sequence[str], metric: str = "rmse"
) -> DataFrame:
    """Weights in [0, 1] with sum 1 that minimise the error of the blend: ``model, weight, n_left_out``.

    Rows that lack a member or the actual cannot be fitted on; ``n_left_out`` counts them.

    RMSE (and R2, which has the same optimum) needs the second moments only. MAE takes them
    again with rows weighted by one over their error, a few aggregations for any number of members.
    """
    wide = member_columns(scored, keys, members)
    k = len(members)
    if metric in ("rmse", "r2"):
        # With weights that sum to 1 the error of the blend is the blend of the errors.
        cov, means, _, _ = _gram(wide, [F.col(m) - F.col("actual") for m in members])
        w = _least_on_simplex((cov + np.outer(means, means))[:k, :k])
    elif metric == "mae":
        w = _least_absolute(wide, [F.col(m) - F.col("actual") for m in members])
    else:
        raise ValueError("metric must be 'rmse', 'r2' or 'mae'")
    left_out = _wide(scored, keys, members).where(_absent(members).isNotNull() | F.col("actual").isNull()).count()
    rows = [(m, float(x), left_out) for m, x in zip(members, w / w.sum())]
    return scored.sparkSession.createDataFrame(rows, "model string, weight double, n_left_out long")


def elastic_net(
    cov: np.ndarray, cross: np.ndarray, alpha: float, l1_ratio: float, rounds: int = 200_000, tolerance: float = 1e-10
) -> np.ndarray:
    """Minimise ``w'cov w / 2 - cross'w + alpha (l1_ratio |w|_1 + (1 - l1_ratio) |w|_2^2 / 2)``.

    With centred second moments per row this is least squares with a penalty on the mean squared
    error over two. Coordinates are solved in turn until the optimality conditions hold to
    ``tolerance`` of the largest moment.
    """
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros(len(cross))
    slope = cross.astype(float).copy()  # cross - cov w
    curve = np.diag(cov) + l2
    limit = tolerance * max(float(np.abs(cross).max(initial=0.0)), l1, 1e-300)
    for _ in range(rounds):
        for i in np.flatnonzero(curve > 0):
            pull = slope[i] + cov[i, i] * w[i]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / curve[i]
            if new != w[i]:
                slope -= cov[:, i] * (new - w[i])
                w[i] = new
        slope = cross - cov @ w
        left = slope - l2 * w
        if np.where(w != 0, np.abs(left - l1 * np.sign(w)), np.maximum(np.abs(left) - l1, 0)).max(initial=0.0) <= limit:
            break
    return w


def stacking_inputs(members: Sequence[str]) -> dict[str, Column]:
    """Member predictions and the difference of every pair."""
    out = {m: F.col(m) for m in members}
    for a, b in itertools.combinations(members, 2):
        out[f"{a}_minus_{b}"] = F.col(a) - F.col(b)
    return out


def stacked_prediction(
    train: DataFrame,
    score: DataFrame,
    keys: Sequence[str],
    members: Sequence[str],
    meta: str = "ridge",
    seed: int = 42,
) -> DataFrame:
    """Fit a meta-model on member predictions and apply it: ``keys, actual, prediction, error``.

    A scored row that lacks a member has no prediction, and ``error`` names the member.
    """
    inputs = stacking_inputs(members)
    fit = member_columns(train, keys, members)
    every = _wide(score, keys, members).withColumn("error", _absent(members))
    use = every.where("error IS NULL")
    lacking = every.where("error IS NOT NULL").select(
        *keys, "actual", F.lit(None).cast("double").alias("prediction"), "error"
    )
    if meta in ("ridge", "lasso", "elastic"):
        cov, means, cross, n = _gram(fit, list(inputs.values()))
        k = len(inputs)
        if meta == "ridge":
            coef = np.linalg.solve(cov[:k, :k] * n + np.eye(k), cross * n)
        else:
            coef = elastic_net(cov[:k, :k], cross, PENALTY, 1.0 if meta == "lasso" else 0.5)
        base = float(means[k] - means[:k] @ coef)
        value = sum((c * float(x) for c, x in zip(inputs.values(), coef)), F.lit(base))
        return use.select(*keys, "actual", value.alias("prediction"), "error").unionByName(lacking)
    if meta == "rf":
        learner = RandomForestRegressor(
            featuresCol="__x", labelCol="actual", numTrees=100, maxDepth=5, seed=seed
        )
    else:
        raise ValueError("meta must be 'ridge', 'lasso', 'elastic' or 'rf'")
    fit, use = fit.withColumns(inputs), use.withColumns(inputs)
    model = Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="__x"), learner]).fit(fit)
    return model.transform(use).select(*keys, "actual", "prediction", "error").unionByName(lacking)
