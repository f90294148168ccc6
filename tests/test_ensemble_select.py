import datetime as dt
import itertools

import numpy as np
import pytest

from demandloom.operators import ensemble, select

DAY = dt.date(2024, 1, 1)
KEYS = ["store_id", "date"]


def members(spark, n=80, seed=0):
    """Three members of different skill around one series."""
    rng = np.random.default_rng(seed)
    y = 100 + 10 * np.sin(np.arange(n) / 3) + rng.normal(0, 1, n)
    preds = {"good": y + rng.normal(0, 1, n), "fair": y + rng.normal(2, 3, n), "poor": y + rng.normal(0, 30, n)}
    rows = [("a", DAY + dt.timedelta(days=i), m, float(y[i]), float(p[i])) for m, p in preds.items() for i in range(n)]
    df = spark.createDataFrame(rows, "store_id string, date date, model string, actual double, prediction double")
    return df, y, preds


def test_score_weights(spark):
    df, y, preds = members(spark)
    got = {r["model"]: r["weight"] for r in ensemble.score_weights(df).collect()}
    r2 = {m: 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum() for m, p in preds.items()}
    s = {m: max(0, v) + 1e-6 for m, v in r2.items()}
    w = {m: max(0.05, v / sum(s.values())) for m, v in s.items()}
    for m in w:
        assert got[m] == pytest.approx(w[m] / sum(w.values()))
    kept = ensemble.deployable_weights(ensemble.score_weights(df), ["good", "fair"]).collect()
    assert sum(r["weight"] for r in kept) == pytest.approx(1.0) and len(kept) == 2


def test_weighted_prediction_skips_zero_weight(spark):
    df, y, preds = members(spark)
    weights = spark.createDataFrame([("good", 3.0), ("fair", 1.0), ("poor", 0.0)], "model string, weight double")
    rows = ensemble.weighted_prediction(df, KEYS, weights).orderBy("date").collect()
    np.testing.assert_allclose([r["prediction"] for r in rows], 0.75 * preds["good"] + 0.25 * preds["fair"])
    plain = ensemble.weighted_prediction(df, KEYS).orderBy("date").collect()
    np.testing.assert_allclose([r["prediction"] for r in plain], sum(preds.values()) / 3)


@pytest.mark.parametrize("n", [8, 80])
def test_dynamic_weights(spark, n):
    df, y, preds = members(spark, n)
    got = [r["prediction"] for r in ensemble.dynamic_prediction(df).orderBy("date").collect()]
    for i in range(n):
        a, b = max(0, i - 30), min(n, i + 30)
        w = {m: 1.0 if b - a < 10 else 1 / (np.abs(p[a:b] - y[a:b]).mean() + 1e-6) for m, p in preds.items()}
        assert got[i] == pytest.approx(sum(w[m] * preds[m][i] for m in w) / sum(w.values()))


@pytest.mark.parametrize("metric", ["rmse", "mae"])
def test_blend_is_near_the_best_simplex_point(spark, metric):
    df, y, preds = members(spark)
    names = ["good", "fair", "poor"]
    got = {r["model"]: r["weight"] for r in ensemble.blend_weights(df, KEYS, names, metric).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and min(got.values()) >= 0

    def loss(w):
        e = sum(x * preds[m] for m, x in zip(names, w)) - y
        return np.sqrt((e**2).mean()) if metric == "rmse" else np.abs(e).mean()

    grid = [(i / 20, j / 20, 1 - (i + j) / 20) for i, j in itertools.product(range(21), repeat=2) if i + j <= 20]
    assert loss([got[m] for m in names]) <= min(map(loss, grid)) + 0.02


def test_ridge_stacking_matches_closed_form(spark):
    df, y, preds = members(spark)
    names = ["good", "fair", "poor"]
    got = [r["prediction"] for r in ensemble.stacked_prediction(df, df, KEYS, names).orderBy("date").collect()]
    cols = [preds[m] for m in names] + [preds[a] - preds[b] for a, b in itertools.combinations(names, 2)]
    x = np.column_stack(cols)
    xc, yc = x - x.mean(0), y - y.mean()
    coef = np.linalg.solve(xc.T @ xc + np.eye(6), xc.T @ yc)
    np.testing.assert_allclose(got, y.mean() + xc @ coef, rtol=1e-8)


@pytest.mark.parametrize("meta", ["lasso", "elastic", "rf"])
def test_other_meta_models(spark, meta):
    df, y, preds = members(spark)
    rows = ensemble.stacked_prediction(df, df, KEYS, ["good", "fair", "poor"], meta).collect()
    error = np.mean([abs(r["prediction"] - r["actual"]) for r in rows])
    assert error < np.abs(preds["poor"] - y).mean() / 3


def long(spark, rows):
    return spark.createDataFrame(rows, "model string, metric string, value double")


def decide(spark, old, new, **kwargs):
    production, candidate = long(spark, old), long(spark, new)
    comparison = select.compare_metrics(production, candidate)
    rows = select.promotion_decisions(candidate, production, comparison, **kwargs).collect()
    return {r["model"]: (r["promoted"], r["reason"]) for r in rows}


def test_promotion_rules(spark):
    old = [("better", "rmse", 10.0), ("better", "mae", 8.0), ("tiny", "rmse", 10.0), ("mixed", "rmse", 10.0),
           ("mixed", "mae", 5.0), ("apart", "wape", 3.0)]
    new = [("better", "rmse", 9.0), ("better", "mae", 7.0), ("tiny", "rmse", 9.95), ("mixed", "rmse", 9.0),
           ("mixed", "mae", 6.0), ("apart", "rmse", 3.0), ("fresh", "rmse", 1.0)]
    got = decide(spark, old, new)
    assert {m: p for m, (p, _) in got.items()} == {"better": 1, "tiny": 0, "mixed": 0, "apart": 0, "fresh": 0}
    assert decide(spark, old, new, first_deployment=True)["fresh"] == (1, "First deployment")
    assert decide(spark, old, new, allow_uncompared=True)["apart"][0] == 1


def test_comparison_directions(spark):
    rows = select.compare_metrics(
        long(spark, [("m", "r2", -0.5), ("m", "rmse", 0.0)]), long(spark, [("m", "r2", 0.5), ("m", "rmse", 1.0)])).collect()
    got = {r["metric"]: r for r in rows}
    assert got["r2"]["improvement"] == pytest.approx(200.0) and got["r2"]["improved"] == 1
    assert got["rmse"]["is_better"] == 0 and got["rmse"]["improvement"] is None


def test_stage_update(spark):
    versions = spark.createDataFrame(
        [("m", "1", "Production"), ("m", "10", "None"), ("k", "1", "Production")], "model string, version string, stage string")
    decisions = spark.createDataFrame([("m", 1), ("k", 0)], "model string, promoted int")
    got = {(r["model"], r["version"]): r["stage"] for r in select.apply_promotions(versions, decisions).collect()}
    assert got == {("m", "1"): "Archived", ("m", "10"): "Production", ("k", "1"): "Production"}


def test_leaderboard_puts_missing_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0, 1.0), ("b", 2.0, 9.0, 1.0), ("c", 2.0, 3.0, 1.0)], "model string, mae double, rmse double, wape double")
    assert [r["model"] for r in select.leaderboard(df).orderBy("rank").collect()] == ["c", "b", "a"]


def test_metric_names(spark):
    keys = ["xgboost_rmse", "holt_winters_mae", "xgboost_cv_rmse_mean", "xgboost_h7_rmse", "fq_xgboost_status",
            "fq_xgboost_excessive_bias_status", "fq_overall_status", "ensemble_weight_x", "a_rmse_mean"]
    flat = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "key string, value double")
    assert sorted((r["model"], r["metric"]) for r in select.holdout_keys(flat).collect()) == [
        ("holt_winters", "mae"), ("xgboost", "rmse")]
    horizon = select.horizon_keys(flat).collect()
    assert [(r["model"], r["horizon"], r["metric"]) for r in horizon] == [("xgboost", 7, "rmse")]
    quality = sorted((r["model"], r["check"]) for r in select.quality_keys(flat).collect())
    assert quality == [("xgboost", "excessive_bias"), ("xgboost", "model_summary")]


def test_top_features(spark):
    df = spark.createDataFrame([("m", f"f{i}", float(i)) for i in range(30)], "model string, feature string, importance double")
    rows = select.top_features(df, 20).orderBy("rank").collect()
    assert len(rows) == 20 and rows[0]["feature"] == "f29"
