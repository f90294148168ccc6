"""Calendar expressions on a date column: parts, cycles, month position, US holidays.

All of them are plain column expressions, so no calendar table has to be joined.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Federal holiday names.
NEW_YEAR = "New Year's Day"
MLK = "Martin Luther King Jr. Day"
WASHINGTON = "Washington's Birthday"
MEMORIAL = "Memorial Day"
JUNETEENTH = "Juneteenth National Independence Day"
INDEPENDENCE = "Independence Day"
LABOR = "Labor Day"
COLUMBUS = "Columbus Day"
VETERANS = "Veterans Day"
THANKSGIVING = "Thanksgiving Day"
CHRISTMAS = "Christmas Day"

# Fixed values: (name, month, day, first year) of the holidays on a fixed date.
FIXED_DATES = (
    (NEW_YEAR, 1, 1, None),
    (JUNETEENTH, 6, 19, 2021),
    (INDEPENDENCE, 7, 4, None),
    (VETERANS, 11, 11, None),
    (CHRISTMAS, 12, 25, None),
)

# Fixed values: (name, month, Monday-based weekday, first day, last day) of the others.
WEEKDAY_DATES = (
    (MLK, 1, 0, 15, 21),
    (WASHINGTON, 2, 0, 15, 21),
    (MEMORIAL, 5, 0, 25, 31),
    (LABOR, 9, 0, 1, 7),
    (COLUMBUS, 10, 0, 8, 14),
    (THANKSGIVING, 11, 3, 22, 28),
)


def wall_seconds(time: Column) -> Column:
    """Seconds of the clock reading since 1970, whatever the session's zone and clock changes."""
    wall = time.cast("timestamp_ntz")
    days = F.datediff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86_400 + F.hour(wall) * 3_600 + F.minute(wall) * 60 + F.second(wall)


def date_parts(date: Column) -> dict[str, Column]:
    """Year to ISO week, Monday-based weekday, weekend and holiday flags."""
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "dayofweek": F.weekday(date),
        "quarter": F.quarter(date),
        "weekofyear": F.weekofyear(date),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
        "is_holiday": is_holiday(date).cast("int"),
    }


def cyclical(date: Column) -> dict[str, Column]:
    """Sine and cosine of month, day of month and weekday."""
    phases = {
        "month": F.month(date) / 12,
        "day": F.dayofmonth(date) / 31,
        "dayofweek": F.weekday(date) / 7,
    }
    out = {}
    for name, share in phases.items():
        out[f"{name}_sin"] = F.sin(2 * F.pi() * share)
        out[f"{name}_cos"] = F.cos(2 * F.pi() * share)
    return out


def month_position(date: Column) -> dict[str, Column]:
    """Where a day lies in its month and quarter."""
    day = F.dayofmonth(date)
    progress = (F.month(date) - 1) % 3 + 1
    return {
        "day_of_month": day,
        "is_month_start": (day <= 5).cast("int"),
        "is_month_end": (day >= 25).cast("int"),
        "week_of_month": (F.floor((day - 1) / 7) + 1).cast("int"),
        "quarter_progress": progress.cast("int"),
        "is_quarter_end": (progress == 3).cast("int"),
        "days_since_month_start": day,
    }


def _holidays(date: Column) -> dict[str, Column]:
    """Condition of every holiday on ``date``, actual ones before observed ones.

    Conditions compare one number, month x 100 + day, so they stay cheap per row.
    """
    place = F.month(date) * 100 + F.dayofmonth(date)
    weekday = F.weekday(date)

    def since(hit: Column, first_year: int | None) -> Column:
        return hit if first_year is None else hit & (F.year(date) >= first_year)

    actual = {n: since(place == m * 100 + d, y) for n, m, d, y in FIXED_DATES}
    for name, month, day, first, last in WEEKDAY_DATES:
        actual[name] = place.between(month * 100 + first, month * 100 + last) & (weekday == day)
    observed = {}
    for name, month, day, first_year in FIXED_DATES:
        before, after = (
            dt.date(2001, month, day) + dt.timedelta(days=shift) for shift in (-1, 1)
        )
        friday = (place == before.month * 100 + before.day) & (weekday == 4)
        monday = (place == after.month * 100 + after.day) & (weekday == 0)
        observed[f"{name} (observed)"] = since(friday | monday, first_year)
    return {**actual, **observed}


def holiday_name(date: Column) -> Column:
    """Name of the US federal holiday on ``date``, else NULL.

    A fixed-date holiday that falls on a weekend is also observed on the nearest weekday,
    under its name with " (observed)" added.
    """
    return F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in _holidays(date).items()])


def is_holiday(date: Column) -> Column:
    return reduce(lambda x, y: x | y, _holidays(date).values())


def is_day_after_holiday(date: Column) -> Column:
    """A working day that follows a holiday."""
    return is_holiday(F.date_sub(date, 1)) & ~is_holiday(date)
