import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.config import TableContract
from demandloom.operators import quantiles, validate

DAY = dt.date(2024, 1, 1)


def days(spark, offsets, store="a"):
    return spark.createDataFrame(
        [(store, DAY + dt.timedelta(days=o)) for o in offsets], "store_id string, date date")


@pytest.mark.parametrize("small", [0, 10**6])
@pytest.mark.parametrize("n", [1, 2, 3, 6, 101, 25_000])
def test_exact_quantiles_match_numpy(spark, monkeypatch, small, n):
    """Both the bracketed and the whole-group path, with ties and a heavy tail."""
    monkeypatch.setattr(quantiles, "SMALL_GROUP", small if n > 20_000 else 10**6)
    values = np.round(np.random.default_rng(n).pareto(1.5, n) * 100) / 10
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    shares = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {r["share"]: r["quantile"] for r in quantiles.exact_quantiles(df, "x", shares).collect()}
    for s in shares:
        assert got[s] == pytest.approx(np.quantile(values, s))


def test_quantiles_with_one_dominant_value(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).cast("double").alias("x"))
    values = np.array([r[0] for r in df.collect()])
    got = {r["share"]: r["quantile"] for r in quantiles.exact_quantiles(df, "x", (0.25, 0.5, 0.75, 0.95)).collect()}
    for s, v in got.items():
        assert v == pytest.approx(np.quantile(values, s))


def test_ks_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    a, b = np.round(rng.normal(0, 1, 700), 1), np.round(rng.normal(0.3, 1, 500), 1)
    old = spark.createDataFrame([(float(v),) for v in a], "x double")
    new = spark.createDataFrame([(float(v),) for v in b], "x double")
    got = quantiles.two_sample_ks(old, new, ["x"]).first()["ks"]
    grid = np.union1d(a, b)
    want = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert got == pytest.approx(want)


def test_gaps_and_calendar(spark):
    df = days(spark, [0, 1, 1, 4, 9])
    rows = validate.date_gaps(df, ["store_id"]).orderBy("gap_start").collect()
    assert [(r["gap_start"], r["gap_days"]) for r in rows] == [
        (DAY + dt.timedelta(days=1), 3), (DAY + dt.timedelta(days=4), 5)]
    summary = validate.gap_summary(df, ["store_id"]).first()
    assert (summary["gap_count"], summary["max_gap_days"]) == (2, 5)
    assert validate.calendar_gaps(df).count() == 6
    assert validate.duplicate_times(df, "date").first()[0] == 1


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "store_id string, date int")
    assert validate.duplicate_times(df, "date", ["store_id"]).first()[0] == 1
    assert validate.duplicate_rows(df).first()["duplicate_rows"] == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "store_id string, date date, sales double")
    assert validate.duplicate_rows(df).first()["duplicate_rows"] == 0
    assert validate.date_gaps(df, ["store_id"]).count() == 0
    assert validate.calendar_gaps(df).count() == 0


def test_schema_and_ranges(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "5", "a"), ("x", "-1", "b"), (None, "y", None)], "date string, sales string, store_id string")
    contract = TableContract()
    found = {(r["column"], r["rule"]): r["violations"] for r in validate.schema_violations(df, contract).collect()}
    assert found == {("product_id", "required"): 1, ("date", "type"): 1, ("sales", "type"): 1}
    clean = validate.conform(df, contract)
    assert dict(clean.dtypes)["date"] == "date" and clean.where("sales IS NULL").count() == 1
    ranges = validate.range_violations(clean, contract).collect()
    assert [(r["rule"], r["violations"], r["extreme"]) for r in ranges] == [("minimum", 1, -1.0)]


def test_column_profile(spark):
    df = spark.createDataFrame([(float(v), None, "k") for v in [1, 2, 3, 4, 100]], "x double, y double, z string")
    rows = {r["column"]: r for r in validate.column_profile(df).collect()}
    assert rows["x"]["outliers"] == 1 and rows["x"]["unique_values"] == 5
    assert rows["y"]["null_percentage"] == 100.0 and rows["y"]["mean"] is None
    assert rows["z"]["unique_values"] == 1 and rows["z"]["mean"] is None


@pytest.mark.parametrize("minutes", [[0, 60, 120, 180], [0, 15, 30, 45, 24 * 60], [0, 0, 0, 60, 120]])
def test_interval_seconds(spark, minutes):
    start = dt.datetime(2024, 1, 1, 22)
    times = [start + dt.timedelta(minutes=m) for m in minutes]
    df = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz")
    want = int(np.median(np.diff(np.array(minutes) * 60)))
    assert validate.interval_seconds(df).first()[0] == want


def test_mean_drift(spark):
    old = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    new = spark.createDataFrame([(100.0,)], "x double")
    assert validate.mean_drift(old, new, ["x"]).first()["drifted"] == 1
    assert validate.mean_drift(old, old, ["x"]).first()["drifted"] == 0


def test_zscore_of_constant_column(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "x double")
    assert validate.zscore_outliers(df, ["x"]).first()["n_outliers"] == 0
