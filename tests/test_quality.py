import datetime as dt

import pytest

from demandloom.config import CHECKS, QualityThresholds
from demandloom.operators import quality

DAY = dt.date(2024, 1, 1)
SCHEMA = "date date, store_id string, model string, actual double, prediction double"


def frame(spark, rows):
    full = [(None if o is None else DAY + dt.timedelta(days=o), s, "m", y, p) for o, s, y, p in rows]
    return spark.createDataFrame(full, SCHEMA)


def statuses(df, **kwargs):
    return {r["check"]: (r["status"], r["metric_value"]) for r in quality.quality_checks(df, **kwargs).collect()}


def test_clean_forecast_passes(spark):
    got = statuses(frame(spark, [(i, "a", 100.0, 100.0) for i in range(10)]))
    assert set(got) == set(CHECKS) and {s for s, _ in got.values()} == {"PASS"}


@pytest.mark.parametrize("missing, status", [(0, "PASS"), (1, "WARNING"), (4, "WARNING"), (5, "FAIL")])
def test_missing_days(spark, missing, status):
    offsets = [0, *range(missing + 1, missing + 4)]
    got = statuses(frame(spark, [(i, "a", 100.0, 100.0) for i in offsets]))
    assert got["missing_timestamps"] == (status, float(missing))


def test_clock_changes_leave_no_holes(spark):
    """Daily and hourly calendars are complete across a change to summer time."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = frame(spark, [(i, "a", 100.0, 100.0) for i in range(60, 90)])
        assert statuses(days)["missing_timestamps"] == ("PASS", 0.0)
        hours = [(dt.datetime(2024, 3, 9) + dt.timedelta(hours=i), "a", "m", 1.0, 1.0) for i in range(72)]
        df = spark.createDataFrame(hours, SCHEMA.replace("date date", "date timestamp_ntz"))
        got = statuses(df, thresholds=QualityThresholds(expected_freq="h"))
        assert got["missing_timestamps"] == ("PASS", 0.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_times(spark):
    got = statuses(frame(spark, [(0, "a", 1.0, 1.0), (None, "a", 1.0, 1.0)]))
    assert got["missing_timestamps"] == ("WARNING", 1.0)
    got = statuses(frame(spark, [(0, "a", 1.0, 1.0), (1, "a", 1.0, 1.0), (None, "a", 1.0, 1.0)]))
    assert got["missing_timestamps"] == ("WARNING", 1.0)


def test_duplicates_per_entity(spark):
    rows = [(i, s, 100.0, 100.0) for i in range(3) for s in "ab"]
    assert statuses(frame(spark, rows))["duplicate_timestamps"] == ("WARNING", 3.0)
    assert statuses(frame(spark, rows), entity=["store_id"])["duplicate_timestamps"] == ("PASS", 0.0)


@pytest.mark.parametrize("n, status", [(0, "PASS"), (1, "WARNING"), (9, "WARNING"), (10, "FAIL")])
def test_negative_values(spark, n, status):
    rows = [(i, "a", -1.0 if i < n else 1.0, -1.0 if i < n else 1.0) for i in range(20)]
    got = statuses(frame(spark, rows))
    assert got["negative_volumes"] == (status, float(n))
    assert got["negative_predictions"] == (status, float(n))


@pytest.mark.parametrize("n, status", [(0, "PASS"), (1, "WARNING"), (5, "FAIL")])
def test_missing_predictions(spark, n, status):
    bad = [None, float("nan"), float("inf"), float("-inf"), None]
    rows = [(i, "a", 100.0, bad[i % 5] if i < n else 100.0) for i in range(100)]
    assert statuses(frame(spark, rows))["missing_predictions"][0] == status


def test_no_finite_pairs_fails(spark):
    got = statuses(frame(spark, [(0, "a", float("nan"), 1.0), (1, "a", 1.0, None)]))
    assert got["excessive_bias"] == ("FAIL", None) and got["abnormal_errors"] == ("FAIL", None)


@pytest.mark.parametrize("shift, status", [(49.0, "PASS"), (50.0, "WARNING"), (199.0, "WARNING"), (200.0, "FAIL")])
def test_bias_limits(spark, shift, status):
    got = statuses(frame(spark, [(i, "a", 1e6, 1e6 + shift) for i in range(4)]))
    assert got["excessive_bias"][0] == status


@pytest.mark.parametrize("share, status", [(0.05, "PASS"), (0.15, "WARNING"), (0.5, "FAIL")])
def test_relative_error_limits(spark, share, status):
    got = statuses(frame(spark, [(i, "a", 10.0, 10.0 * (1 + (-1) ** i * share)) for i in range(4)]))
    assert got["abnormal_errors"][0] == status


def test_zero_actuals_use_unit_scale(spark):
    got = statuses(frame(spark, [(i, "a", 0.0, 0.3) for i in range(4)]))
    assert got["excessive_bias"][0] == "FAIL"


def test_report_and_summary(spark):
    good = frame(spark, [(i, "a", 100.0, 100.0) for i in range(10)])
    bad = frame(spark, [(i, "a", 100.0, 300.0) for i in range(10)]).replace("m", "worse", "model")
    checks = quality.quality_checks(good.unionByName(bad))
    report = {r["model"]: r for r in quality.quality_report(checks).collect()}
    assert report["m"]["status"] == "PASS" and report["worse"]["status"] == "FAIL"
    assert report["m"]["n_pass"] == 7 and report["worse"]["n_fail"] == 2
    summary = quality.quality_summary(checks).collect()
    assert len(summary) == 2 * 8 + 1
    overall = [r for r in summary if r["check"] == "OVERALL"][0]
    assert (overall["status"], overall["message"]) == ("FAIL", "n_models=2")
    flat = {r["key"]: r["value"] for r in quality.quality_metrics(checks).collect()}
    assert flat["fq_overall_status"] == 2.0 and flat["fq_m_status"] == 0.0
    assert flat["fq_worse_excessive_bias_value"] == 200.0
    lines = [r["line"] for r in quality.quality_text(checks).where("model = 'm'").orderBy("place").collect()]
    assert lines[0] == "[PASS] m" and len(lines) == 8


def test_settings_ignore_unknown_keys():
    got = QualityThresholds.from_mapping({"bias_warn": 1.0, "enabled": True})
    assert got.bias_warn == 1.0 and got.bias_fail == 200.0


def test_absent_prediction_column_fails(spark):
    rows = spark.sql("SELECT DATE '2024-01-01' + CAST(id AS INT) AS date, 'm' AS model, 1.0D AS actual FROM range(3)")
    got = {r["check"]: r["status"] for r in quality.quality_checks(rows).collect()}
    assert got["missing_predictions"] == got["abnormal_errors"] == "FAIL"
    assert got["missing_timestamps"] == "PASS"


def test_named_model_without_rows_fails(spark):
    rows = spark.sql(
        "SELECT DATE '2024-01-01' + CAST(id AS INT) AS date, 'm' AS model, 1.0D AS actual, 1.0D AS prediction FROM range(3)"
    )
    for table, models in ((rows, ["m", "n"]), (rows.limit(0), ["n"])):
        got = quality.quality_checks(table, models=models).where("model = 'n'").collect()
        status = {r["check"]: r["status"] for r in got}
        assert len(status) == 7
        assert status["missing_timestamps"] == status["missing_predictions"] == "FAIL"
    alone = quality.quality_checks(rows, models=["m", "n"]).where("model = 'm'").collect()
    assert {r["status"] for r in alone} == {"PASS"}
