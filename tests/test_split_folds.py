import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandloom.config import CvConfig
from demandloom.operators import prep, split

DAY = dt.date(2024, 1, 1)


def panel(spark, stores, days):
    rows = [(f"s{s}", DAY + dt.timedelta(days=d), float(s + d)) for d in range(days) for s in range(stores)]
    return spark.createDataFrame(rows, "store_id string, date date, sales double")


@pytest.mark.parametrize("stores, days", [(1, 10), (3, 7), (3, 11), (7, 13), (1, 1)])
def test_split_sizes_and_order(spark, stores, days):
    df = panel(spark, stores, days)
    rows = split.chronological_split(df).orderBy("date", "store_id").collect()
    n = stores * days
    n_train, n_val = int(n * (1 - 0.2 - 0.1)), int(n * 0.1)
    want = ["train"] * n_train + ["val"] * n_val + ["test"] * (n - n_train - n_val)
    assert [r["split"] for r in rows] == want


def test_split_by_date_keeps_days_whole(spark):
    df = split.chronological_split(panel(spark, 3, 11), by="date")
    assert df.groupBy("date").agg(F.count_distinct("split").alias("k")).where("k > 1").count() == 0
    assert df.count() == 33


def folds_by_hand(n, k, h, step, smallest):
    step = h if step is None else step
    if smallest is None:
        smallest = max(2 * h, n - (h + (k - 1) * step), int(n * 0.4))
    origins = [n - h - (k - 1 - i) * step for i in range(k)]
    return [o for o in origins if o >= smallest]


@pytest.mark.parametrize("h", [1, 7, 30])
@pytest.mark.parametrize("k, step, smallest", [(1, None, None), (5, None, None), (6, 3, None), (4, None, 10)])
def test_fold_arithmetic(spark, h, k, step, smallest):
    sizes = spark.createDataFrame([(f"n{n}", n) for n in range(2, 201, 9)], "store_id string, n long")
    config = CvConfig(n_splits=k, horizon=h, step=step, min_train_size=smallest)
    got = {}
    for r in split.rolling_origin_folds(sizes, config).orderBy("store_id", "fold_id").collect():
        got.setdefault(r["store_id"], []).append(r["train_end"])
        assert r["test_end"] - r["test_start"] == h and r["test_start"] == r["train_end"]
    want = {f"n{n}": folds_by_hand(n, k, h, step, smallest) for n in range(2, 201, 9)}
    assert got == {key: v for key, v in want.items() if v}


def test_folds_never_train_on_the_future(spark):
    rows = split.series_positions(panel(spark, 2, 60))
    folds = split.rolling_origin_folds(split.fold_sizes(rows, ["store_id"]), CvConfig(3, 7))
    train = split.fold_rows(rows, folds, ["store_id"], "train").groupBy("store_id", "fold_id").agg(F.max("date").alias("a"))
    test = split.fold_rows(rows, folds, ["store_id"]).groupBy("store_id", "fold_id").agg(
        F.min("date").alias("b"), F.count("*").alias("n"))
    both = train.join(test, ["store_id", "fold_id"])
    assert both.count() == 6 and both.where("a >= b OR n <> 7").count() == 0


def test_bad_fold_settings():
    for bad in ({"n_splits": 0}, {"horizon": 0}, {"step": 0}):
        with pytest.raises(ValueError):
            CvConfig(**bad)


@pytest.mark.parametrize("days, held", [(40, 4), (7, 1), (5, 0)])
def test_early_stopping_slice(spark, days, held):
    out = split.early_stopping_slice(panel(spark, 1, days))
    late = out.where("is_validation").agg(F.count("*"), F.min("date")).first()
    assert late[0] == held
    if held:
        assert late[1] == DAY + dt.timedelta(days=days - held)


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    state = prep.scaler_state(df, ["x", "y"])
    got = sorted((r["x"], r["y"]) for r in prep.scale(df, state, ["x", "y"]).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_unseen_labels(spark):
    train = spark.createDataFrame([("b",), ("a",)], "k string")
    fresh = spark.createDataFrame([("b",), ("z",)], "k string")
    codes = prep.label_codes(train, "k")
    assert sorted(r["k"] for r in prep.encode_labels(fresh, codes, "k", "zero").collect()) == [0, 1]
    with pytest.raises(Exception, match="unseen label"):
        prep.encode_labels(fresh, codes, "k").collect()
    assert sorted(r["k"] for r in prep.encode_labels(train, codes, "k").collect()) == [0, 1]


def test_global_index_over_many_slices(spark):
    from demandloom.plans.tables import global_index

    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"))
    rows = global_index(df.repartition(6), ["k"]).orderBy("k").collect()
    assert [r["index"] for r in rows] == list(range(5000))


def test_checkpoint_folder_is_the_session_setting(spark):
    from demandloom.plans.tables import durable

    assert durable(spark.range(3)).count() == 3
    configured = spark.conf.get("spark.checkpoint.dir", None)
    used = spark.sparkContext.getCheckpointDir()
    assert used is not None and (configured is None or configured.rstrip("/") in used)
