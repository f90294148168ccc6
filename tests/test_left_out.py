"""Series and rows that cannot be scored stay in the results with an error."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.config import CvConfig, HorizonConfig
from demandloom.operators import ensemble, evaluate, split
from demandloom.plans import flows

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    sizes = {"long": 100, "short": 20, "one": 1, None: 30}
    rows = [(k, DAY + dt.timedelta(days=i), 10.0 + i % 7) for k, n in sizes.items() for i in range(n)]
    rows += [("blank", DAY, None)]
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


@pytest.mark.parametrize("kind", ["naive", "classical"])
def test_short_series_stay(panel, kind):
    def scores(config):
        if kind == "naive":
            return evaluate.naive_fold_scores(panel, config, unfolded=True)
        return evaluate.classical_fold_scores(panel, config, {"seasonal_naive": {}})

    table = {r["store_id"]: r for r in evaluate.cross_validate(scores(CvConfig(2, 20))).collect()}
    assert set(table) == {"long", "short", "one", None, "blank"}
    assert table["long"]["n_folds"] == 2 and table["long"]["error"] is None
    for k, n in (("short", 20), ("one", 1), ("blank", 0), (None, 30)):
        assert table[k]["n_folds"] == 0 and table[k]["rmse_mean"] is None and f" {n} rows" in table[k]["error"]
    config = HorizonConfig(horizons=(1, 14), n_splits=2)
    ahead = evaluate.multi_horizon(scores(config), config, ["store_id"]).collect()
    assert {(r["store_id"], r["horizon"]) for r in ahead} == {(k, h) for k in table for h in (1, 14)}
    assert all((r["n_folds"] == 0) == (r["error"] is not None) for r in ahead)
    whole = evaluate.multi_horizon(scores(config), config).collect()
    assert len(whole) == 2 and all(r["n_folds"] > 0 and r["error"] for r in whole)


def test_folds_with_less_than_a_season_stay(panel):
    config = CvConfig(n_splits=1, horizon=3, min_train_size=2)
    rows = evaluate.naive_fold_scores(panel.where("store_id = 'short' AND date < '2024-01-08'"), config).collect()
    assert len(rows) == 3 and all(r["prediction"] is None and "got 4" in r["error"] for r in rows)


def test_rows_of_failed_fits_and_absent_members_stay(spark, panel):
    parts = split.chronological_split(panel.where("store_id IN ('long', 'short')"))
    scored = flows.scored_members(parts, [], {}, {"seasonal_naive": {}, "holt_winters": {"seasonal_periods": 30}})
    held = parts.where("split <> 'train'").count()
    assert {r["count"] for r in scored.groupBy("model").count().collect()} == {held}
    assert scored.where("prediction IS NULL").where("error IS NULL").count() == 0

    rows = [(i, m, float(i), i + e) for i in range(30) for m, e in (("a", 0.5), ("b", -1.0 + i % 3)) if (i, m) != (4, "b")]
    members = spark.createDataFrame(rows, "id int, model string, actual double, prediction double")
    for meta in ("ridge", "lasso"):
        out = {r["id"]: r for r in ensemble.stacked_prediction(members, members, ["id"], ["a", "b"], meta).collect()}
        assert len(out) == 30 and out[4]["prediction"] is None and out[4]["error"] == "Absent: b"
        assert all(r["prediction"] is not None and r["error"] is None for i, r in out.items() if i != 4)
    weights = ensemble.blend_weights(members, ["id"], ["a", "b"])
    assert {r["n_left_out"] for r in weights.collect()} == {1}
