import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandloom.config import FeatureConfig
from demandloom.operators import features

CONFIG = FeatureConfig(lags=(1, 2, 7), windows=(3, 7), stats=("mean", "std", "min", "max", "median"))


def make_panel(stores=("a", "b"), days=90, seed=1):
    rng = np.random.default_rng(seed)
    start = dt.date(2023, 1, 1)
    rows = [
        (start + dt.timedelta(days=i), s, p, float(rng.uniform(500, 1500)), float(rng.uniform(10, 100)))
        for i in range(days)
        for s in stores
        for p in ("x", "y")
    ]
    return pd.DataFrame(rows, columns=["date", "store_id", "product_id", "sales", "price"])


@pytest.fixture(scope="module")
def frame():
    return make_panel()


@pytest.fixture(scope="module")
def panel(spark, frame):
    return spark.createDataFrame(frame, "date date, store_id string, product_id string, sales double, price double")


KEYS = ["store_id", "product_id"]


def sorted_pandas(df):
    return df.toPandas().sort_values([*KEYS, "date"]).reset_index(drop=True)


def test_lags_and_rolling_match_pandas(panel, frame):
    got = sorted_pandas(features.rolling_features(
        features.lag_features(panel, keys=KEYS, lags=CONFIG.lags), keys=KEYS, windows=CONFIG.windows))
    want = frame.sort_values([*KEYS, "date"]).reset_index(drop=True)
    groups = want.groupby(KEYS)["sales"]
    for k in CONFIG.lags:
        np.testing.assert_allclose(got[f"sales_lag_{k}"], groups.shift(k))
    for w in CONFIG.windows:
        for stat in CONFIG.stats:
            ref = groups.transform(lambda x: x.rolling(w, min_periods=1).agg(stat))
            np.testing.assert_allclose(got[f"sales_rolling_{w}_{stat}"], ref, rtol=1e-9, atol=1e-9)


def test_pipeline_keeps_rows_and_fills(panel, frame):
    out = features.all_features(panel, keys=KEYS, categorical=KEYS, config=CONFIG)
    got = out.toPandas()
    assert len(got) == len(frame)
    assert got[[c for c in got.columns if "lag" in c or "rolling" in c]].notna().all().all()
    assert {"year", "month", "day", "dayofweek", "quarter", "weekofyear", "is_weekend", "is_holiday"} <= set(got)
    assert got[["month_sin", "day_cos", "dayofweek_sin"]].abs().max().max() <= 1
    assert "store_id_product_id_interaction" in got


@pytest.mark.parametrize("scope", ["group", "panel"])
def test_fill_matches_pandas(spark, scope):
    frame = make_panel(stores=("a", "b", "c", "d"), days=12).query("product_id == 'x'").copy()
    rng = np.random.default_rng(3)
    frame.loc[rng.random(len(frame)) < 0.5, "sales"] = np.nan
    frame.loc[frame["store_id"].isin(["a", "c"]), "sales"] = np.nan
    schema = "date date, store_id string, product_id string, sales double, price double"
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), schema)
    got = features.fill_missing(df, ["sales"], ["price"], scope=scope).toPandas()
    got = got.sort_values(["store_id", "date"])["sales"].to_numpy(dtype=float)
    ordered = frame.sort_values(["store_id", "date"])
    if scope == "panel":
        want = ordered["sales"].ffill().bfill()
    else:
        want = ordered.groupby("store_id")["sales"].transform(lambda x: x.ffill().bfill())
    np.testing.assert_allclose(got, want.to_numpy(dtype=float))


def test_mean_fill_leaves_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "x double, y double")
    got = features.fill_mean(df, ["x", "y"]).toPandas()
    assert sorted(got["x"]) == [1.0, 2.0, 3.0] and got["y"].isna().all()


@pytest.mark.parametrize("block, span", [(5, 2), (5, 14), (64, 7), (64, 365), (None, 2), (None, 365)])
def test_ewm_matches_pandas(spark, block, span):
    frame = make_panel(stores=("a", "b"), days=400).query("product_id == 'x'")
    df = spark.createDataFrame(frame, "date date, store_id string, product_id string, sales double, price double")
    got = features.ewm_features(df, spans=(span,), block=block).toPandas().sort_values(["store_id", "date"])
    want = frame.sort_values(["store_id", "date"]).groupby("store_id")["sales"].transform(
        lambda x: x.ewm(span=span, adjust=False).mean())
    np.testing.assert_allclose(got[f"sales_ewm_{span}"], want, rtol=1e-10)


def test_blocked_equals_whole_window_with_hot_key(spark):
    """One store holds two thirds of the rows; blocks must not change any value."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 7)).otherwise(F.lit("hot")).alias("store_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"),
        F.col("id").alias("line"),
        F.rand(5).alias("sales"),
    )
    frame = rows.toPandas()
    df = spark.createDataFrame(frame, rows.schema)
    got = features.blocked_features(df, "sales", ["store_id"], "date", ["line"], CONFIG, block_rows=50)
    got = got.toPandas().sort_values(["store_id", "date", "line"]).reset_index(drop=True)
    want = frame.sort_values(["store_id", "date", "line"]).reset_index(drop=True)
    groups = want.groupby("store_id")["sales"]
    assert len(got) == len(want)
    np.testing.assert_allclose(got["sales_lag_7"], groups.shift(7))
    np.testing.assert_allclose(
        got["sales_rolling_7_std"], groups.transform(lambda x: x.rolling(7, min_periods=1).std()), rtol=1e-9)


def test_trend_and_ratio(panel, frame):
    got = sorted_pandas(features.trend_features(panel, keys=KEYS))
    want = frame.sort_values([*KEYS, "date"]).reset_index(drop=True)
    groups = want.groupby(KEYS)
    assert (got["trend"] == groups.cumcount()).all()
    velocity = groups["sales"].diff()
    np.testing.assert_allclose(got["sales_velocity"], velocity)
    np.testing.assert_allclose(got["sales_acceleration"], velocity.groupby([want[k] for k in KEYS]).diff(), atol=1e-9)


def test_target_encoding_counts_rows_without_target(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 4.0), (None, 7.0)], "store_id string, sales double")
    got = {r["store_id"]: r["store_id_target_encoded"] for r in features.target_encoding(df, ["store_id"]).collect()}
    assert got["a"] == pytest.approx((2 * 1.0 + 4.0) / 3)
    assert got["b"] == pytest.approx((4.0 + 4.0) / 2)
    assert got[None] == pytest.approx(4.0)


def test_interaction_null(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    got = [r[0] for r in features.interaction_features(df, ["x", "y"]).select("x_y_interaction").collect()]
    assert got == [None, "b_c"]


def test_ewm_follows_pandas_over_nulls(spark):
    draw = np.random.default_rng(1)
    parts = []
    for k, holes in enumerate((0.0, 0.1, 0.9, 1.0)):
        values = draw.normal(10, 3, 700)
        values[draw.random(700) < holes] = np.nan
        if k == 1:
            values[200:500] = np.nan
        days = pd.date_range("2020-01-01", periods=700)
        parts.append(pd.DataFrame({"store_id": str(k), "date": days, "sales": values}))
    frame = pd.concat(parts)
    rows = spark.createDataFrame(frame).withColumn("sales", F.nanvl("sales", F.lit(None).cast("double")))
    got = features.ewm_features(rows, spans=(7, 14)).toPandas().sort_values(["store_id", "date"])
    for span in (7, 14):
        smooth = frame.groupby("store_id")["sales"].transform(lambda v: v.ewm(span=span, adjust=False).mean())
        np.testing.assert_allclose(got[f"sales_ewm_{span}"].to_numpy(float), smooth.to_numpy(), rtol=1e-9)
