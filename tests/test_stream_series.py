"""Stateful features on a stream against their batch form: order, late rows, restarts, silence, the gate."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandloom.config import FeatureConfig
from demandloom.operators import quality
from demandloom.streaming import demand, series

SMALL = FeatureConfig(lags=(1, 3), windows=(2, 4))
DAY0 = dt.date(2024, 1, 1)
KIND = "store_id string, date date, sales double, note string"


def sales_rows(days=range(60), seed=1):
    pick = random.Random(seed)
    rows = []
    for store in ("a", "b", None):
        for d in days:
            if pick.random() < 0.85:
                value = None if pick.random() < 0.1 else round(pick.uniform(0, 100), 2)
                rows.append((store, DAY0 + dt.timedelta(days=d), value, f"{store}{d}"))
    return rows


def deliver(spark, path, rows):
    spark.createDataFrame(rows, KIND).write.mode("append").parquet(f"{path}/in")


def drain(spark, path, **options):
    """One run over what has been delivered since the last one."""
    schema = spark.createDataFrame([], KIND).schema
    stream = demand.read_stream(spark, f"{path}/in", schema)
    featured = series.stream_features(stream, config=SMALL, **options)
    gate = lambda rows: quality.quality_checks(
        rows.select("date", "store_id", F.col("sales").alias("actual"),
                    F.col("sales_lag_1").alias("prediction"), F.lit("lag").alias("model")),
        entity=["store_id"],
    )
    run = series.gated_batches(featured, lambda b: b, gate, f"{path}/out", f"{path}/checkpoint").start()
    run.awaitTermination(180)
    return spark.read.parquet(f"{path}/out/scores").drop("batch")


def same(got, want):
    names = sorted(want.columns)
    shown = lambda df: sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()), key=str
    )
    assert sorted(got.columns) == names
    assert shown(got) == shown(want)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    path, rows = str(tmp_path), sales_rows()
    random.Random(2).shuffle(rows)
    early = [r for r in rows if r[1] < DAY0 + dt.timedelta(days=30)]
    late = [r for r in rows if r not in early]
    # The first rows of the second delivery are older than the last of the first, within the delay.
    held = [r for r in early if r[1] > DAY0 + dt.timedelta(days=27)][:4]
    deliver(spark, path, [r for r in early if r not in held])
    first = drain(spark, path, delay="6 days")
    assert 0 < first.count() < len(early)
    deliver(spark, path, [*late, *held])
    deliver(spark, path, [("end", DAY0 + dt.timedelta(days=400), None, "end")])
    got = drain(spark, path, delay="6 days")
    same(got, series.history_features(spark.createDataFrame(rows, KIND), config=SMALL))
    checks = spark.read.parquet(f"{path}/out/checks")
    assert {r["status"] for r in checks.select("status").distinct().collect()} <= {"PASS", "WARNING", "FAIL"}
    assert checks.count()


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    path = str(tmp_path)
    deliver(spark, path, [("a", DAY0 + dt.timedelta(days=d), float(d), "") for d in range(20)])
    drain(spark, path)
    deliver(spark, path, [("a", DAY0, 99.0, "late"), ("a", DAY0 + dt.timedelta(days=20), 5.0, ""), (None, DAY0 + dt.timedelta(days=300), None, "end")])
    got = drain(spark, path)
    assert got.where("note = 'late'").count() == 0 and got.count() == 21


def test_a_silent_series_starts_anew(spark, tmp_path):
    path = str(tmp_path)
    days = [0, 1, 2, 3, 4, 40, 41, 42]
    deliver(spark, path, [("a", DAY0 + dt.timedelta(days=d), float(d), str(d)) for d in days[:5]])
    drain(spark, path, forget_days=10)
    deliver(spark, path, [("a", DAY0 + dt.timedelta(days=d), float(d), str(d)) for d in days[5:]] + [("end", DAY0 + dt.timedelta(days=300), None, "end")])
    got = {r["note"]: r["sales_lag_1"] for r in drain(spark, path, forget_days=10).collect()}
    assert got["4"] == 3.0 and got["40"] is None and got["41"] == 40.0


def test_features_of_an_empty_and_a_null_past():
    past = series.Past([])
    import numpy as np

    found = past.features(np.array([np.nan, np.nan, 5.0, 7.0]), SMALL)
    names = series.feature_names("x", SMALL)
    assert np.isnan(found[0]).all()
    assert np.isnan(found[1][names.index("x_lag_1")]) and found[1][names.index("x_rolling_2_std")] == 0
    assert found[3][names.index("x_rolling_2_mean")] == 5.0 and found[3][names.index("x_lag_3")] != found[3][names.index("x_lag_1")]
    assert past.n == 4 and past.known == 2 and past.total == 12.0
