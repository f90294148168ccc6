import datetime as dt
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.operators import rollup, scoring, validate
from demandloom.sources import audit, panel as files

DAY = dt.date(2024, 1, 1)


def sales(spark, days=40, store="store_001"):
    rows = [(DAY + dt.timedelta(days=i), store, float(i)) for i in range(days)]
    return spark.createDataFrame(rows, "date date, store_id string, sales double")


def test_partitioned_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "sales")
    files.write_partitioned(sales(spark), path)
    assert os.path.isdir(os.path.join(path, "year=2024", "month=2", "day=9"))
    back = files.read_panel(spark, path, where="year = 2024 AND month = 2")
    assert back.count() == 9
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    files.write_partitioned(sales(spark), str(tmp_path / "weekly"), layout="week")
    assert os.path.isdir(tmp_path / "weekly" / "year=2024" / "week=1")


def test_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(path)
    assert files.read_panel(spark, path).agg(F.avg("x")).first()[0] == 1.0


def test_csv_readers(spark, tmp_path):
    (tmp_path / "h.csv").write_text("date,store_id,sales\n2024-01-01,store_001,5234.50\nbad,store_001,x\n")
    rows = files.read_history_csv(spark, str(tmp_path / "h.csv")).collect()
    assert rows[0]["date"] == DAY and rows[0]["sales"] == 5234.5 and rows[1]["date"] is None
    (tmp_path / "s.csv").write_text("date,volume,average_handle_time\n2024-01-01 08:00:00,120,300\n")
    assert files.read_staffing_csv(spark, str(tmp_path / "s.csv")).first()["timestamp"] == dt.datetime(2024, 1, 1, 8)
    (tmp_path / "w.csv").write_text("date,volume\n2024-01-01,1\n")
    with pytest.raises(ValueError, match="average_handle_time"):
        files.read_staffing_csv(spark, str(tmp_path / "w.csv"))


def test_reports(spark, tmp_path):
    sections = {"rows": sales(spark, 2), "total": sales(spark, 2).agg(F.sum("sales").alias("s"))}
    files.write_report(sections, str(tmp_path / "report"))
    text = spark.read.text(str(tmp_path / "report" / "section=total")).first()[0]
    assert json.loads(text) == {"s": 1.0}
    files.write_csv(sales(spark, 2), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["date", "store_id", "sales"]
    files.write_lines(spark.createDataFrame([("a",)], "line string"), str(tmp_path / "txt"))
    assert spark.read.text(str(tmp_path / "txt")).first()[0] == "a"


def test_file_audit(spark, tmp_path):
    good = tmp_path / "deep"
    good.mkdir()
    sales(spark, 5).toPandas().to_parquet(good / "good.parquet")
    data = (good / "good.parquet").read_bytes()
    (tmp_path / "cut.parquet").write_bytes(data[: len(data) // 2])
    (tmp_path / "text.parquet").write_text("not parquet")
    (tmp_path / "other.txt").write_text("ignored")
    found = audit.audit_files(audit.list_files(spark, str(tmp_path)), deep=True)
    status = {os.path.basename(r["path"]): (r["status"], r["error"]) for r in found.collect()}
    assert status["good.parquet"] == ("valid", None)
    assert status["cut.parquet"][0] == status["text.parquet"][0] == "corrupted"
    counts = audit.audit_counts(found).first()
    assert (counts["total"], counts["valid_count"], counts["corrupted_count"]) == (3, 1, 2)
    path = [str(tmp_path / "deep"), str(tmp_path / "cut.parquet")]
    safe = files.read_panel(spark, path, "date date, store_id string, sales double", tolerant=True)
    assert safe.count() == 5


def test_file_checks_and_empty_files(spark, tmp_path):
    path = str(tmp_path / "f")
    df = spark.createDataFrame([(DAY, "s", "p", -1.0)], "date date, store_id string, product_id string, quantity_sold double")
    df.coalesce(1).write.parquet(path)
    df.limit(0).coalesce(1).write.mode("append").parquet(path)
    checked = validate.file_checks(spark.read.parquet(path))
    row = checked.first()
    assert row["negative_quantity_sold"] == 1 and row["missing_columns"] == "revenue"
    empty = validate.empty_files(audit.list_files(spark, path), checked.withColumn("source", F.replace("source", F.lit("file:///"), F.lit("file:/"))))
    assert empty.count() == 1


def test_promotion_duplicates_and_times(spark):
    promos = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 13, 5), "p", 0.1), (dt.datetime(2024, 1, 1), "p", 0.3), (None, "p", 0.9)],
        "date timestamp_ntz, product_id string, discount_percent double")
    rows = rollup.promo_summary(promos).collect()
    assert [(r["date"], r["max_discount"]) for r in rows] == [(DAY, 0.3)]


def test_rollup_drops_null_keys_and_sums_nulls_to_zero(spark):
    schema = ("date date, store_id string, product_id string, category string, quantity_sold double, revenue double,"
              " cost double, profit double, discount_percent double, unit_price double")
    rows = [(DAY, "s", "p", "c", None, None, 1.0, 1.0, 0.1, 2.0), (DAY, None, "p", "c", 1.0, 1.0, 1.0, 1.0, 0.1, 2.0)]
    got = rollup.daily_product_rollup(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 1 and got[0]["sales"] == 0.0 and got[0]["quantity_sold"] == 0.0
    panel = rollup.training_panel(spark.createDataFrame(rows, schema), None, None).first()
    assert panel["has_promotion"] == 0.0 and panel["customer_traffic"] is None


@pytest.mark.parametrize("n", [2, 10, 60])
def test_last_window(spark, n):
    row = scoring.last_window(sales(spark, n)).first()
    y = np.arange(n, dtype=float)
    for k in (1, 7, 30):
        assert row[f"sales_lag_{k}"] == pytest.approx(y[-k] if n >= k else y.mean())
    for w in (3, 30):
        tail = y[-w:]
        assert row[f"sales_rolling_{w}_mean"] == pytest.approx(tail.mean() if n >= w else y.mean())
        assert row[f"sales_rolling_{w}_std"] == pytest.approx(tail.std() if n >= w else 0.0)
        assert row[f"sales_rolling_{w}_median"] == pytest.approx(np.median(tail) if n >= w else y.mean())


def test_forecast_request(spark):
    history = sales(spark, 40).unionByName(sales(spark, 10, "store_002"))
    predict = lambda df: df.withColumn("prediction", F.col("sales_lag_1") * 1.0)
    rows = scoring.forecast_request(history, predict, 5).orderBy("store_id", "date").collect()
    assert len(rows) == 10 and rows[0]["date"] == DAY + dt.timedelta(days=40)
    assert rows[0]["lower_bound"] == pytest.approx(39 * 0.9) and rows[0]["upper_bound"] == pytest.approx(39 * 1.1)


def test_requests_keep_bad_dates_apart(spark):
    df = spark.createDataFrame([("s", "2024-02-30"), ("s", "2024-02-28"), ("s", None)], "store_id string, date string")
    errors = [r["error"] for r in scoring.checked_requests(df).collect()]
    assert errors == ["invalid date: 2024-02-30", None, "invalid date: null"]


def test_store_numbers(spark):
    df = spark.createDataFrame([("store_017",), ("downtown",), ("store_x",)], "s string")
    assert [r[0] for r in df.select(scoring.store_number(F.col("s"))).collect()] == [17, 1, 1]


def test_sample_is_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = {r[0] for r in scoring.deterministic_sample(df.repartition(7), 100, ["k"]).collect()}
    two = {r[0] for r in scoring.deterministic_sample(df.coalesce(1), 100, ["k"]).collect()}
    assert one == two and len(one) == 100
