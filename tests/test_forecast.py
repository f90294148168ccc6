import datetime as dt

import numpy as np
import pytest

from demandloom.config import CvConfig, HorizonConfig
from demandloom.operators import evaluate, forecast, metrics, split

DAY = dt.date(2024, 1, 1)
CLASSICAL = {"seasonal_naive": {}, "holt_winters": {}, "sarimax": {}}


def wavy(n, slope=0.5, noise=1.0, seed=0):
    t = np.arange(n)
    season = np.array([10, 5, 0, -5, -10, 20, -20])
    return 100 + slope * t + season[t % 7] + np.random.default_rng(seed).normal(0, noise, n)


def panel(spark, series):
    rows = [(k, DAY + dt.timedelta(days=i), float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


@pytest.mark.parametrize("horizon", [1, 6, 7, 8, 30])
def test_seasonal_naive_repeats_last_week(spark, horizon):
    y = wavy(20)
    got = forecast.seasonal_naive(panel(spark, {"a": y, "short": y[:6]}), horizon).orderBy("step").collect()
    assert [r["prediction"] for r in got] == pytest.approx(list(np.resize(y[-7:], horizon)))
    assert got[0]["date"] == DAY + dt.timedelta(days=20) and {r["store_id"] for r in got} == {"a"}


@pytest.mark.parametrize("fit", [forecast.holt_winters, forecast.seasonal_arima])
def test_learners_beat_naive_on_trend(fit):
    y = wavy(150)
    truth = wavy(164, noise=0.0)[150:]
    error = np.abs(fit(y[:150], 14) - truth).mean()
    naive = np.abs(forecast.naive_forecast(y[:150], 14) - truth).mean()
    assert error < naive / 2


@pytest.mark.parametrize("fit", [forecast.naive_forecast, forecast.holt_winters, forecast.seasonal_arima])
def test_constant_series_forecasts_itself(fit):
    np.testing.assert_allclose(fit(np.full(40, 12.5), 10), 12.5, atol=1e-6)


@pytest.mark.parametrize("fit, fewest", [
    (forecast.naive_forecast, 7), (forecast.holt_winters, 14), (forecast.seasonal_arima, 14)])
def test_shortest_history(fit, fewest):
    y = wavy(fewest)
    assert np.isfinite(fit(y, 3)).all()
    with pytest.raises(ValueError):
        fit(y[:-1], 3)


def test_holt_winters_options():
    y = wavy(80)
    for options in ({"trend": None}, {"damped_trend": True}, {"seasonal": "mul"}, {"use_boxcox": True}):
        assert np.isfinite(forecast.holt_winters(y, 10, **options)).all()
    assert np.isfinite(forecast.holt_winters(y - 200, 5, use_boxcox=True)).all()


def test_arima_with_regressor():
    rng = np.random.default_rng(1)
    x = rng.normal(size=120)
    y = wavy(120, slope=0.0, noise=0.1) + 30 * x
    ahead = rng.normal(size=7)
    got = forecast.seasonal_arima(y, 7, exog=x[:, None], exog_future=ahead[:, None])
    plain = forecast.seasonal_arima(y, 7)
    truth = wavy(127, slope=0.0, noise=0.0)[120:] + 30 * ahead
    assert np.abs(got - truth).mean() < np.abs(plain - truth).mean() / 3


def test_failed_fit_keeps_the_others(spark):
    df = panel(spark, {"long": wavy(100), "short": wavy(10)})
    rows = forecast.forecast_ahead(df, 3, CLASSICAL).collect()
    bad = {(r["store_id"], r["model"]) for r in rows if r["error"]}
    assert bad == {("short", "holt_winters"), ("short", "sarimax")}
    assert all(r["prediction"] is None for r in rows if r["error"])
    assert len(rows) == 18


def test_native_and_grouped_naive_agree(spark):
    df = panel(spark, {"a": wavy(200), "b": wavy(170, seed=2)})
    config = CvConfig(n_splits=3, horizon=30)
    one = evaluate.naive_fold_scores(df, config)
    two = evaluate.classical_fold_scores(df, config, {"seasonal_naive": {}})
    columns = ["store_id", "fold_id", "train_end", "step", "date", "actual", "prediction"]
    assert one.count() == 180
    assert one.select(*columns).exceptAll(two.select(*columns)).count() == 0


def test_short_series_are_left_out(spark):
    df = panel(spark, {"a": wavy(200), "short": wavy(20)})
    scores = evaluate.naive_fold_scores(df, CvConfig(n_splits=2, horizon=10))
    assert {r["store_id"] for r in scores.select("store_id").distinct().collect()} == {"a"}


def test_multi_horizon_table(spark):
    df = panel(spark, {"a": wavy(200)})
    config = HorizonConfig(n_splits=3)
    table = evaluate.multi_horizon(evaluate.classical_fold_scores(df, config, CLASSICAL), config)
    rows = {(r["model"], r["horizon"]): r for r in table.collect()}
    assert len(rows) == 12 and {r["n_folds"] for r in rows.values()} == {3}
    assert rows[("holt_winters", 14)]["rmse"] < rows[("seasonal_naive", 14)]["rmse"]


def test_holdout_stages(spark):
    parts = split.chronological_split(panel(spark, {"a": wavy(100)}))
    scores = evaluate.holdout_scores(parts, CLASSICAL)
    sizes = {(r["stage"], r["model"]): r["count"] for r in scores.groupBy("stage", "model").count().collect()}
    assert sizes[("val", "sarimax")] == 10 and sizes[("test", "holt_winters")] == 20
    assert metrics.forecast_metrics(scores, ["stage", "model"]).where("rmse IS NULL").count() == 0
