"""Classical forecasters per series.

Seasonal naive is plain DataFrame work. Holt-Winters and the seasonal ARIMA are sequential
recurrences, so each series is one group of ``applyInPandas``; a series at date grain is
bounded by the calendar, and the series themselves are spread by Spark.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


SEASON = 7


def seasonal_naive(
    history: DataFrame,
    horizon: int,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
    season: int = SEASON,
) -> DataFrame:
    """Repeat the last ``season`` values of each series: ``keys, date, step, prediction``.

    Only the last rows of a series leave the map side. A series shorter than the season gives
    no forecast.
    """
    latest = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    last = (
        history.where(F.col(target).isNotNull())
        .select(*keys, date, target)
        .withColumn("__back", F.row_number().over(latest))
        .where(F.col("__back") <= season)
    )
    everything = Window.partitionBy(*keys)
    known = last.withColumns(
        {"__size": F.count(F.lit(1)).over(everything), "__end": F.max(date).over(everything)}
    ).where(F.col("__size") == season)
    first_step = (F.lit(season + 1) - F.col("__back")).cast("int")
    steps = F.when(
        first_step <= horizon, F.sequence(first_step, F.lit(int(horizon)), F.lit(int(season)))
    )
    return known.withColumn("step", F.explode(steps)).select(
        *keys,
        F.date_add("__end", F.col("step")).alias(date),
        "step",
        F.col(target).alias("prediction"),
    )


def naive_forecast(y: np.ndarray, horizon: int, season_length: int = SEASON) -> np.ndarray:
    """The same rule for the grouped evaluation of one series."""
    if len(y) < season_length:
        raise ValueError(f"Need at least {season_length} observations, got {len(y)}")
    return np.resize(y[-season_length:], horizon)


def _smooth(y, season, mult, trend, phi, a, b, g):
    """Run all parameter combinations at once; returns squared error and final states."""
    n = a.size
    first, second = y[:season].mean(), y[season : 2 * season].mean()
    level = np.full(n, first)
    slope = np.full(n, (second - first) / season if trend else 0.0)
    start = y[:season] / first if mult else y[:season] - first
    cycle = np.repeat(start[:, None], n, axis=1)
    loss = np.zeros(n)
    for t, value in enumerate(y):
        s = cycle[t % season]
        base = level + phi * slope
        guess = base * s if mult else base + s
        loss += (value - guess) ** 2
        fresh = a * (value / s if mult else value - s) + (1 - a) * base
        if trend:
            slope = b * (fresh - level) + (1 - b) * phi * slope
        level = fresh
        cycle[t % season] = g * (value / fresh if mult else value - fresh) + (1 - g) * s
    return loss, level, slope, cycle


def holt_winters(
    y: np.ndarray,
    horizon: int,
    seasonal: str = "add",
    seasonal_periods: int = SEASON,
    trend: str | None = "add",
    damped_trend: bool = False,
    use_boxcox: bool = False,
    **_: Any,
) -> np.ndarray:
    """Exponential smoothing with level, trend and season.

    The three weights minimise the one-step squared error over a grid that is refined twice
    around its best point.
    """
    m = int(seasonal_periods)
    if len(y) < max(2 * m, m + 2):
        raise ValueError(f"Need at least {max(2 * m, m + 2)} observations, got {len(y)}")
    positive = bool(np.all(y > 0))
    if seasonal == "mul" and not positive:
        raise ValueError("A multiplicative season needs positive values")
    logged = use_boxcox and positive
    data = np.log(y) if logged else np.asarray(y, dtype=float)
    mult, phi = seasonal == "mul", 0.98 if damped_trend else 1.0
    axes = [np.array([0.05, 0.2, 0.4, 0.6, 0.8])] * 3
    if not trend:
        axes[1] = np.array([0.0])
    width = 0.1
    for _round in range(3):
        grid = np.array(list(itertools.product(*axes)))
        loss, level, slope, cycle = _smooth(data, m, mult, bool(trend), phi, *grid.T)
        best = int(np.nanargmin(loss))
        axes = [np.unique(np.clip(x + width * np.array([-1, 0, 1]), 0.01, 0.99)) for x in grid[best]]
        if not trend:
            axes[1] = np.array([0.0])
        width /= 2.5
    steps = np.arange(1, horizon + 1)
    reach = np.cumsum(phi**steps) if trend else np.zeros(horizon)
    season = cycle[(len(data) + steps - 1) % m, best]
    base = level[best] + reach * slope[best]
    out = base * season if mult else base + season
    return np.exp(out) if logged else out


def _lag_matrix(x: np.ndarray, lags: Sequence[int], start: int) -> np.ndarray:
    cols = [x[start - k : len(x) - k] for k in lags]
    return np.column_stack(cols) if cols else np.empty((len(x) - start, 0))


def seasonal_arima(
    y: np.ndarray,
    horizon: int,
    order: Sequence[int] = (1, 1, 1),
    seasonal_order: Sequence[int] = (1, 1, 1, SEASON),
    exog: np.ndarray | None = None,
    exog_future: np.ndarray | None = None,
    **_: Any,
) -> np.ndarray:
    """Seasonal ARIMA by two-stage least squares (Hannan and Rissanen, 1982).

    A long autoregression gives residuals; the differenced series is then regressed on its
    own lags and theirs, forecast step by step, and integrated. Regressors enter through a
    first least-squares fit on the level.
    """
    (p, d, q), (sp, sd, sq, s) = order, seasonal_order
    if len(y) < max(2 * max(s, 1), 10):
        raise ValueError(f"Need at least {max(2 * max(s, 1), 10)} observations, got {len(y)}")
    w = np.asarray(y, dtype=float)
    lift = np.zeros(horizon)
    if exog is not None:
        design = np.column_stack([np.ones(len(w)), exog])
        beta = np.linalg.lstsq(design, w, rcond=None)[0]
        w = w - design @ beta
        lift = np.column_stack([np.ones(horizon), exog_future]) @ beta
    stages = []
    for gap in [s] * sd + [1] * d:
        stages.append((gap, w[-gap:]))
        w = w[gap:] - w[:-gap]
    ar = sorted({i + s * j for i in range(p + 1) for j in range(sp + 1)} - {0})
    ma = sorted({i + s * j for i in range(q + 1) for j in range(sq + 1)} - {0})
    mean = w.mean()
    w = w - mean
    deepest = max([*ar, *ma, 1])
    long = list(range(1, min(max(deepest, 2 * s), len(w) // 3) + 1))
    resid = np.zeros(len(w))
    if ma and long:
        x = _lag_matrix(w, long, len(long))
        resid[len(long) :] = w[len(long) :] - x @ np.linalg.lstsq(x, w[len(long) :], rcond=None)[0]
    if len(w) - deepest > len(ar) + len(ma):
        x = np.hstack([_lag_matrix(w, ar, deepest), _lag_matrix(resid, ma, deepest)])
        ridge = 1e-6 * np.trace(x.T @ x) / max(x.shape[1], 1) * np.eye(x.shape[1])
        coef = np.linalg.solve(x.T @ x + ridge, x.T @ w[deepest:]) if x.any() else np.zeros(x.shape[1])
    else:
        coef = np.zeros(len(ar) + len(ma))
    shrink = min(1.0, 0.98 / max(np.abs(coef[: len(ar)]).sum(), 1e-12))
    coef[: len(ar)] *= shrink
    wave, shock = list(w), list(resid)
    for _step in range(horizon):
        value = sum(c * wave[-k] for c, k in zip(coef, ar) if k <= len(wave))
        value += sum(c * shock[-k] for c, k in zip(coef[len(ar) :], ma) if k <= len(shock))
        wave.append(value)
        shock.append(0.0)
    out = np.array(wave[-horizon:]) + mean
    for gap, tail in reversed(stages):
        full = np.concatenate([tail, np.zeros(horizon)])
        for i in range(horizon):
            full[gap + i] = full[i] + out[i]
        out = full[gap:]
    return out + lift


Forecaster = Callable[..., np.ndarray]

FORECASTERS: dict[str, Forecaster] = {
    "seasonal_naive": naive_forecast,
    "holt_winters": holt_winters,
    "exponential_smoothing": holt_winters,
    "sarimax": seasonal_arima,
}


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(k, df.schema[k].dataType) for k in keys]


def forecast_origins(
    history: DataFrame,
    origins: DataFrame,
    models: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Forecast every series from each of its origins.

    ``origins`` holds ``keys, fold_id, train_end, horizon``. The history of a series is read
    once and its origins are looped inside the group, so no history is repeated in a shuffle.
    Result: ``keys, model, fold_id, step, position, prediction, error``; a failed fit has its
    message in ``error`` and no prediction.
    """
    # Fresh aliases, because origins usually descend from the history itself.
    folds = origins.select(*[F.col(c).alias(c) for c in origins.columns]).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("fold_id", "train_end", "horizon"))).alias("__folds")
    )
    clean = history.where(F.col(target).isNotNull()).select(
        *keys, F.col(date).alias("__t"), F.col(target).cast("double").alias("__y")
    )
    chosen = {name: (FORECASTERS[name], dict(params)) for name, params in models.items()}
    names = list(keys)

    def run(history_rows: pd.DataFrame, fold_rows: pd.DataFrame) -> pd.DataFrame:
        y = history_rows.sort_values("__t")["__y"].to_numpy(dtype=float)
        rows = []
        for fold_row in fold_rows.itertuples(index=False):
            key = [getattr(fold_row, k) for k in names]
            for fold in fold_row[len(names)]:
                end, steps = int(fold["train_end"]), int(fold["horizon"])
                for model, (fit, params) in chosen.items():
                    try:
                        values, error = fit(y[:end], steps, **params), None
                    except Exception as exc:
                        values, error = [None] * steps, str(exc)
                    rows += [
                        [*key, model, int(fold["fold_id"]), i + 1, end + i, v, error]
                        for i, v in enumerate(values)
                    ]
        return pd.DataFrame(rows, columns=[f.name for f in fields])

    fields = [
        *_key_fields(history, keys),
        T.StructField("model", T.StringType()),
        T.StructField("fold_id", T.IntegerType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("position", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
    grouped = clean.groupBy(*keys).cogroup(folds.groupBy(*keys))
    return grouped.applyInPandas(run, T.StructType(fields))


def forecast_ahead(
    history: DataFrame,
    horizon: int,
    models: Mapping[str, Mapping[str, Any]],
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    target: str = "sales",
) -> DataFrame:
    """Forecast every series from its end: ``keys, date, model, step, prediction, error``."""
    ends = history.where(F.col(target).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("train_end"), F.max(date).alias("__end")
    )
    origins = ends.select(
        *keys, F.lit(0).alias("fold_id"), "train_end", F.lit(int(horizon)).alias("horizon")
    )
    out = forecast_origins(history, origins, models, keys, date, target)
    dated = out.join(ends.select(*keys, "__end"), list(keys))
    return dated.select(
        *keys, F.date_add("__end", F.col("step")).alias(date), "model", "step", "prediction", "error"
    )
