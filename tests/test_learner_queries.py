"""The learner queries use every row of the panel and the settings as configured."""

from pyspark.sql import functions as F

from demandloom.catalog import learners
from demandloom.catalog.tables import panel
from demandloom.config import CvConfig, FeatureConfig
from demandloom.operators import learn

FOLDER = "/root/testdata/sf0.001"


def test_every_row_is_trained_on_or_predicted(spark):
    rows = learners.training_rows(spark, FOLDER)
    stores = rows.select("store_id").distinct().count()
    assert rows.count() == panel(spark, FOLDER).count()
    assert rows.where("split = 'train' AND sales_lag_30 IS NULL").count() == 30 * stores
    held = rows.where("split = 'test'")
    holed = held.withColumn("sales_lag_1", F.when(F.dayofmonth("date") > 9, F.col("sales_lag_1")))
    model = learners.fitted(rows, {"maxIter": 2, "maxDepth": 2})
    assert learn.predict(model, holed).where("prediction IS NOT NULL").count() == held.count() > 0


def test_configured_features_presets_and_folds(spark, monkeypatch):
    settings = FeatureConfig()
    names = {f"sales_lag_{k}" for k in settings.lags}
    names |= {f"sales_shifted_{w}_{s}" for w in settings.windows for s in settings.stats}
    assert names <= set(learners.FEATURES)
    seen = []
    small = {"maxIter": 1, "maxDepth": 1}

    def noted(rows, features, target="sales", params=None, *rest, fit=learn.boosted_trees, **more):
        seen.append(dict(params))
        return fit(rows, features, target, small, *rest, **more)

    monkeypatch.setattr(learn, "boosted_trees", noted)
    monkeypatch.setattr(learners.evaluate, "boosted_trees", noted)
    scores = learners.boosted_cv(spark, FOLDER)
    assert seen == list(learn.PRESETS.values()) * CvConfig().n_splits
    assert scores.count() == len(seen)
    seen.clear()
    learners.feature_importance(spark, FOLDER)
    learners.gbt_forecast(spark, FOLDER)
    assert seen == [*learn.PRESETS.values(), learn.PRESETS["xgboost"]]
