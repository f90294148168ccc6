"""The normal quantile as an expression, Q-Q points with equal residuals, and the elastic net."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import ensemble, metrics


def test_normal_quantile_is_exact_to_nine_places(spark):
    shares = [10.0**-k for k in (1, 2, 5, 9, 12, 30, 100, 300)] + [i / 997 for i in range(1, 997)] + [1 - 1e-9, 0.925, 0.075]
    got = spark.createDataFrame([(s,) for s in shares], "s double").select("s", metrics.normal_quantile(F.col("s")).alias("q")).collect()
    assert all(r["q"] == pytest.approx(NormalDist().inv_cdf(r["s"]), abs=1e-9, rel=1e-9) for r in got)
    edge = spark.createDataFrame([(0.0,), (1.0,), (-1.0,), (2.0,), (None,)], "s double")
    assert all(r["q"] is None for r in edge.select(metrics.normal_quantile(F.col("s")).alias("q")).collect())


def test_equal_residuals_take_successive_ranks(spark, monkeypatch):
    monkeypatch.setattr(metrics, "EQUAL_ROWS", 7)
    residuals = [0.0] * 40 + [1.0, 2.0, -3.0, 1.0]
    rows = [("m", r, 0.0) for r in residuals] + [("one", 5.0, 0.0), ("m", float("nan"), 0.0), ("m", None, 0.0)]
    got = metrics.qq_points(spark.createDataFrame(rows, "model string, actual double, prediction double")).collect()
    n = len(residuals)
    share = lambda i: 0.5 ** (1 / n) if i == n else 1 - 0.5 ** (1 / n) if i == 1 else (i - 0.3175) / (n + 0.365)
    want = sorted((NormalDist().inv_cdf(share(i)), r) for i, r in enumerate(sorted(residuals), 1))
    mine = sorted((r["theoretical"], r["ordered"]) for r in got if r["model"] == "m")
    assert np.allclose(mine, want, atol=1e-9)
    assert [r["theoretical"] for r in got if r["model"] == "one"] == [pytest.approx(0.0, abs=1e-12)]


@pytest.mark.parametrize("alpha,share", [(0.01, 1.0), (0.5, 1.0), (0.3, 0.5), (5.0, 1.0), (0.2, 0.0)])
def test_elastic_net_meets_the_optimality_conditions(alpha, share):
    pick = np.random.default_rng(3)
    x = pick.normal(size=(400, 3)) * [1, 5, 0.2]
    x = np.column_stack([x, x[:, 0] - x[:, 1], x[:, 0] - x[:, 2], np.zeros(400)])
    y = x @ [1, 0, 2, 0.3, 0, 0] + pick.normal(size=400)
    x, y = x - x.mean(axis=0), y - y.mean()
    cov, cross = x.T @ x / 400, x.T @ y / 400
    w = ensemble.elastic_net(cov, cross, alpha, share)
    slope = cross - cov @ w - alpha * (1 - share) * w
    on = w != 0
    assert np.allclose(slope[on], alpha * share * np.sign(w[on]), atol=1e-8)
    assert (np.abs(slope[~on]) <= alpha * share + 1e-8).all()
    assert w[5] == 0


def test_lasso_stacking_uses_the_stated_objective(spark):
    pick = np.random.default_rng(1)
    rows = []
    for i in range(200):
        truth = float(pick.normal())
        rows += [(i, "a", truth, truth + 0.3 * float(pick.normal())), (i, "b", truth, 0.5 * truth + float(pick.normal()))]
    scored = spark.createDataFrame(rows, "k int, model string, actual double, prediction double")
    for meta, share in (("lasso", 1.0), ("elastic", 0.5)):
        got = {r["k"]: r["prediction"] for r in ensemble.stacked_prediction(scored, scored, ["k"], ["a", "b"], meta).collect()}
        x = np.array([[rows[2 * i][3], rows[2 * i + 1][3], rows[2 * i][3] - rows[2 * i + 1][3]] for i in range(200)])
        y = np.array([rows[2 * i][2] for i in range(200)])
        residual = y - np.array([got[i] for i in range(200)])
        assert abs(residual.mean()) < 1e-9
        pull = np.abs((x - x.mean(axis=0)).T @ residual / 200)
        assert pull.max() <= 0.01 * 1.5 and (share < 1 or pull.max() == pytest.approx(0.01, abs=1e-7))
