import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from demandloom.config import CvConfig, FeatureConfig, HorizonConfig, enabled_models
from demandloom.operators import quality, scoring
from demandloom.plans import flows
from demandloom.sources import audit

DAY = dt.date(2024, 1, 1)
CONFIG = FeatureConfig(lags=(1, 7), windows=(7,), stats=("mean",))


def panel(spark, days=150):
    rng = np.random.default_rng(0)
    rows = []
    for k, base in (("a", 100), ("b", 300)):
        for i in range(days):
            rows.append((k, DAY + dt.timedelta(days=i), float(base + 20 * (i % 7) + rng.normal(0, 2))))
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


def test_training_run(spark, tmp_path):
    parts = flows.prepared_panel(panel(spark), feature_config=CONFIG).persist()
    assert {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()} == {
        "train": 210, "val": 30, "test": 60}
    inputs = ["dayofweek", "sales_lag_7", "is_weekend"]
    models = enabled_models()
    presets = {"boosted": {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3}}
    scored = flows.scored_members(parts, inputs, presets, models).persist()
    final = flows.with_ensemble(scored)
    sizes = {r["model"]: r["count"] for r in final.groupBy("model").count().collect()}
    assert sizes == dict.fromkeys(["boosted", *models, "ensemble"], 60)
    tables = flows.review_tables(
        parts, final, models, cv=CvConfig(n_splits=2, horizon=14), horizons=HorizonConfig(n_splits=2))
    board = {r["model"]: r["rmse"] for r in tables["holdout"].collect()}
    assert board["ensemble"] <= max(board.values())
    assert tables["horizon_summary"].count() == 12
    assert tables["aggregated_metrics"].count() == 6
    checks = quality.quality_checks(final, entity=["store_id"])
    flows.write_review({k: tables[k] for k in ("holdout", "quality_summary")}, checks, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out" / "holdout"), header=True).count() == 5
    assert spark.read.text(str(tmp_path / "out" / "quality_text")).count() == 5 * 8


def test_forecast_to_staffing(spark):
    predict = lambda df: df.withColumn("prediction", F.col("sales_lag_7") * 100)
    plan = flows.forecast_to_staffing(panel(spark), predict, 5.0, 300.0, days=7)
    rows = plan.collect()
    assert len(rows) == 14 and all(r["staffing_gap"] == 0 for r in rows)
    assert all(r["required_agents"] > 0 and r["volume_lower"] < r["volume_upper"] for r in rows)


def test_request_extras(spark):
    requests = spark.createDataFrame(
        [("a", "2024-06-01", {"has_promotion": "1"}), ("b", "2024-06-02", {})],
        "store_id string, date string, additional_features map<string,string>")
    out = scoring.score_requests(
        requests, panel(spark), lambda d: d.withColumn("prediction", F.col("sales_lag_1")), extras=["has_promotion"])
    got = {r["store_id"]: (r["has_promotion"], r["customer_traffic"]) for r in out.collect()}
    assert got == {"a": (1.0, 500), "b": (0.0, 500)}


def test_model_switches():
    assert set(enabled_models()) == {"seasonal_naive", "holt_winters", "sarimax"}
    some = enabled_models({"holt_winters": {"enabled": True, "params": {"trend": None}}, "sarimax": {"enabled": False}})
    assert list(some) == ["holt_winters"] and some["holt_winters"]["trend"] is None


def test_artifact_summary(spark):
    listing = spark.createDataFrame([("run/models/xgboost/model.pkl",), ("run/scalers.pkl",)], "path string")
    row = audit.artifact_summary(listing, ["models/xgboost", "scalers", "encoders"]).first()
    assert (row["n_files"], row["missing"], row["success"]) == (2, ["encoders"], False)
    assert audit.artifact_summary(listing, ["scalers"]).first()["success"]
    assert not audit.artifact_summary(listing.limit(0), []).first()["success"]
