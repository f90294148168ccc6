import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import metrics


def scored(spark, pairs, model="m"):
    rows = [(model, None if y is None else float(y), None if p is None else float(p)) for y, p in pairs]
    return spark.createDataFrame(rows, "model string, actual double, prediction double")


def only(df):
    return df.collect()[0].asDict()


def test_against_formulas(spark):
    rng = np.random.default_rng(2)
    y, p = rng.normal(100, 20, 50), rng.normal(100, 20, 50)
    got = only(metrics.forecast_metrics(scored(spark, zip(y, p))))
    assert got["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got["mae"] == pytest.approx(np.abs(y - p).mean())
    assert got["mape"] == pytest.approx(np.abs((y - p) / y).mean() * 100)
    assert got["wape"] == pytest.approx(np.abs(y - p).sum() / np.abs(y).sum() * 100)
    assert got["bias"] == pytest.approx((p - y).mean())
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_zero_actuals(spark):
    got = only(metrics.forecast_metrics(scored(spark, [(0, 1), (0, -1)])))
    assert got["wape"] is None and got["mape"] is None and got["r2"] == 0.0
    mixed = only(metrics.forecast_metrics(scored(spark, [(0, 1), (10, 5)])))
    assert mixed["mape"] == pytest.approx(50.0)


def test_constant_and_single(spark):
    assert only(metrics.forecast_metrics(scored(spark, [(5, 5), (5, 5)])))["r2"] == 1.0
    assert only(metrics.forecast_metrics(scored(spark, [(5, 5)])))["r2"] is None


def test_r2_with_large_offset(spark):
    y = 1e9 + np.arange(10)
    got = only(metrics.forecast_metrics(scored(spark, zip(y, y + 0.5))))
    assert got["r2"] == pytest.approx(1 - 2.5 / 82.5)


def test_fold_aggregate_with_missing_metric(spark):
    rows = [("m", 1.0, None), ("m", 3.0, 2.0)]
    df = spark.createDataFrame(rows, "model string, rmse double, wape double")
    got = only(metrics.fold_aggregates(df, metrics=("rmse", "wape")))
    assert got["n_folds"] == 2 and got["rmse_mean"] == 2.0 and got["rmse_std"] == 1.0
    assert got["wape_mean"] is None


def test_horizon_prefixes(spark):
    rows = [("m", 0, s, float(s), 0.0) for s in range(1, 8)]
    df = spark.createDataFrame(rows, "model string, fold_id int, step int, actual double, prediction double")
    got = {r["horizon"]: r["mae"] for r in metrics.by_horizon(df, (1, 3, 7)).collect()}
    assert got == {1: 1.0, 3: 2.0, 7: 4.0}


def test_histogram_counts_every_value(spark):
    values = np.random.default_rng(4).normal(size=500)
    df = spark.createDataFrame([("m", float(v)) for v in values], "model string, v double")
    rows = metrics.error_histogram(df, F.col("v"), 50).orderBy("bin").collect()
    counts, edges = np.histogram(values, 50)
    got = np.zeros(50, dtype=int)
    for r in rows:
        got[r["bin"]] = r["n"]
    assert (got == counts).all()
    assert sum(r["density"] for r in rows) * (edges[1] - edges[0]) == pytest.approx(1.0)


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([("m", 2.0)] * 4, "model string, v double")
    row = metrics.error_histogram(df, F.col("v"), 10).collect()
    assert len(row) == 1 and row[0]["n"] == 4 and row[0]["left"] <= 2.0 <= row[0]["right"]


def test_qq_points(spark):
    values = [3.0, -1.0, 2.0, 10.0]
    rows = metrics.qq_points(scored(spark, [(v, 0) for v in values])).orderBy("ordered").collect()
    n = len(values)
    top = 0.5 ** (1 / n)
    shares = [1 - top, (2 - 0.3175) / (n + 0.365), (3 - 0.3175) / (n + 0.365), top]
    assert [r["ordered"] for r in rows] == sorted(values)
    for r, s in zip(rows, shares):
        assert r["theoretical"] == pytest.approx(NormalDist().inv_cdf(s))


def test_recommendations(spark):
    rows = [("train", 0.0, 0.0)] * 3 + [("train", 10.0, 10.0)] * 3 + [("val", 5.0, 1.0), ("test", 9.0, 1.0)]
    df = spark.createDataFrame(rows, "split string, sales double, copy double")
    topics = {r["topic"] for r in metrics.recommendations(df, ["copy"]).collect()}
    assert topics == {"small_training_set", "many_zero_targets", "possible_leakage", "distribution_shift_test"}


def test_alerts(spark):
    df = spark.createDataFrame([("m", 999.0, 0.3)], "model string, rmse double, mape double")
    got = metrics.metric_alerts(df, {"rmse": 1000, "mape": 0.2}).collect()
    assert [(r["metric"], r["value"]) for r in got] == [("mape", 0.3)]
    assert not math.isnan(got[0]["limit"])
