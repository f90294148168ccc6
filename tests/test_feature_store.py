"""The bucketed feature store: appended features against the full run, refusals, retries, a new session, the plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandloom.config import FeatureConfig
from demandloom.operators import ensemble, features, validate
from demandloom.sources.feature_store import FeatureStore

SMALL = FeatureConfig(lags=(1, 4), windows=(2, 5))
KIND = "store_id string, date date, note string, sales double"
DAY0 = dt.date(2024, 3, 1)


def rows(days, seed=4, stores=("a", "b", None)):
    pick = random.Random(seed)
    return [
        (s, DAY0 + dt.timedelta(days=d), f"{s}-{d}", None if pick.random() < 0.1 else round(pick.uniform(0, 50), 3))
        for s in stores
        for d in days
        if pick.random() < 0.8
    ]


@pytest.fixture
def store(spark, tmp_path):
    name = "store_" + tmp_path.name.replace("-", "_")
    return FeatureStore(spark, name, str(tmp_path), KIND, config=SMALL, buckets=4)


def frame(spark, data):
    return spark.createDataFrame(data, KIND)


def shown(df, names):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=str)


def check_features(spark, store, data):
    full = features.with_series_columns(
        frame(spark, data), "sales", SMALL.lags, SMALL.windows, SMALL.stats, features.whole_series(["store_id"], "date")
    )
    assert shown(store.read(), full.columns) == shown(full, full.columns)


def test_appended_features_equal_the_full_run(spark, store):
    data = rows(range(40))
    cuts = [10, 11, 25, 40]
    for at, (low, high) in enumerate(zip([0, *cuts], cuts)):
        store.append(frame(spark, [r for r in data if low <= (r[1] - DAY0).days < high]), f"b{at}")
    # A series that begins late and one that pauses.
    more = rows(range(60, 64), 5, ("a", "new"))
    store.append(frame(spark, more), "b4")
    store.append(frame(spark, []), "b5")
    check_features(spark, store, data + more)
    assert shown(store.read("rows"), ["note"]) == shown(frame(spark, data + more), ["note"])
    assert {r["series"] for r in store.tail().collect()} == {'{"store_id":"a"}', '{"store_id":"b"}', "{}", '{"store_id":"new"}'}
    assert max(r["n"] for r in store.tail().select(F.size("recent").alias("n")).collect()) == store.lookback


def test_late_rows_are_refused_and_repeats_do_nothing(spark, store):
    first, second = rows(range(10)), rows(range(10, 15), 6)
    store.append(frame(spark, first), "b0")
    late = [("a", DAY0, "late", 1.0), ("b", None, "undated", 2.0)]
    store.append(frame(spark, second + late), "b1")
    store.append(frame(spark, second), "b1")
    assert {r["note"] for r in store.read("refused").collect()} == {"late", "undated"}
    check_features(spark, store, first + second)
    with pytest.raises(ValueError):
        store.append(frame(spark, second), "b00")


def test_a_broken_batch_is_replaced_and_a_new_session_goes_on(spark, store, tmp_path):
    data = rows(range(20))
    early = [r for r in data if (r[1] - DAY0).days < 12]
    store.append(frame(spark, early), "b0")
    # A run that wrote features and was lost before its tail.
    store._write("features", store.featured(store.met(frame(spark, data[-2:]))), "b1")
    check_features(spark, store, early)
    again = FeatureStore(spark, store.name + "_again", str(tmp_path), KIND, config=SMALL, buckets=4)
    again.append(frame(spark, [r for r in data if r not in early]), "b1")
    check_features(spark, again, data)
    again.forget_old_tails()
    assert again.batches() == ["b0", "b1"]
    again.append(frame(spark, rows(range(30, 33), 9)), "b2")
    check_features(spark, again, data + rows(range(30, 33), 9))


def test_an_append_does_not_shuffle_the_tail(spark, store):
    store.append(frame(spark, rows(range(10))), "b0")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.featured(store.met(frame(spark, rows(range(10, 12)))))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert "_tail[" in plan and "_rows[" not in plan and "_features[" not in plan


def test_an_absent_member_has_no_weight(spark):
    days = [(dt.date(2024, 1, d), "s", m, 100.0, None if m == "y" and d == 3 else 100.0) for d in range(1, 20) for m in "xy"]
    days += [(dt.date(2024, 1, 25), "s", m, 100.0, None) for m in "xy"]
    scored = spark.createDataFrame(days, "date date, store_id string, model string, actual double, prediction double")
    got = {r["date"].day: r["prediction"] for r in ensemble.dynamic_prediction(scored).collect()}
    assert got[3] == pytest.approx(100.0) and got[4] == pytest.approx(100.0) and got[25] is None


def test_file_checks_count_empty_files(spark):
    sales = spark.createDataFrame([("f1", 1.0, -2.0), ("f1", -1.0, 2.0)], "file string, quantity_sold double, revenue double")
    listing = spark.createDataFrame([("f1",), ("f2",)], "path string")
    checks = {r["source"]: r for r in validate.file_checks(sales, (), F.col("file"), listing).collect()}
    assert checks["f1"]["n_rows"] == 2 and checks["f1"]["negative_revenue"] == 1
    assert checks["f2"]["n_rows"] == 0 and checks["f2"]["negative_quantity_sold"] == 0
