import datetime as dt

from pyspark.sql import functions as F

from demandloom.functions import calendar

# Holidays with their observed days, written down by hand.
KNOWN = {
    "2020-01-01": "New Year's Day",
    "2020-07-03": "Independence Day (observed)",
    "2020-07-04": "Independence Day",
    "2020-11-26": "Thanksgiving Day",
    "2021-01-18": "Martin Luther King Jr. Day",
    "2021-06-18": "Juneteenth National Independence Day (observed)",
    "2021-06-19": "Juneteenth National Independence Day",
    "2021-07-05": "Independence Day (observed)",
    "2021-12-24": "Christmas Day (observed)",
    "2021-12-31": "New Year's Day (observed)",
    "2022-12-26": "Christmas Day (observed)",
    "2023-01-02": "New Year's Day (observed)",
    "2023-11-10": "Veterans Day (observed)",
    "2024-05-27": "Memorial Day",
    "2024-09-02": "Labor Day",
    "2024-10-14": "Columbus Day",
    "2025-02-17": "Washington's Birthday",
    "2026-12-25": "Christmas Day",
}
ORDINARY = ["2020-06-19", "2020-11-27", "2021-07-06", "2024-05-20", "2024-09-09"]


def test_holiday_names(spark):
    days = [(dt.date.fromisoformat(d),) for d in [*KNOWN, *ORDINARY]]
    df = spark.createDataFrame(days, "date date")
    rows = df.select("date", calendar.holiday_name(F.col("date")).alias("name")).collect()
    found = {r["date"].isoformat(): r["name"] for r in rows}
    assert found == {**KNOWN, **dict.fromkeys(ORDINARY)}


def test_holidays_per_year(spark):
    df = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2026-12-31')) AS date")
    rows = df.where(calendar.holiday_name(F.col("date")).isNotNull() & ~F.contains(
        calendar.holiday_name(F.col("date")), F.lit("observed")))
    counts = {r[0]: r[1] for r in rows.groupBy(F.year("date")).count().collect()}
    assert counts == {2020: 10, **{y: 11 for y in range(2021, 2027)}}


def test_day_after_holiday(spark):
    df = spark.createDataFrame([(dt.date(2024, 7, 5),), (dt.date(2024, 7, 6),)], "date date")
    got = [r[0] for r in df.select(calendar.is_day_after_holiday(F.col("date"))).collect()]
    assert got == [True, False]


def test_date_parts_match_pandas(spark):
    import pandas as pd

    days = pd.date_range("2019-12-20", "2021-01-10")
    df = spark.createDataFrame([(d.date(),) for d in days], "date date")
    got = df.select("date", *[c.alias(n) for n, c in calendar.date_parts(F.col("date")).items()])
    got = got.toPandas().sort_values("date")
    assert (got["weekofyear"].to_numpy() == days.isocalendar().week.to_numpy()).all()
    assert (got["dayofweek"].to_numpy() == days.dayofweek.to_numpy()).all()
    assert (got["quarter"].to_numpy() == days.quarter.to_numpy()).all()
