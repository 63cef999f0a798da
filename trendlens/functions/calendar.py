"""Calendar columns of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Croatian public holidays with a fixed date, as MM-dd.
FIXED_HOLIDAYS = (
    "01-01", "01-06", "05-01", "05-30", "06-22", "08-05", "08-15", "11-01", "11-18", "12-25", "12-26",
)

NAMES = (
    "day_of_week", "is_weekend", "day_of_month", "week_of_year", "month", "quarter",
    "is_month_start", "is_month_end", "is_holiday_hr", "days_since_weekend", "days_until_weekend",
)


def calendar_columns(date: Column, holidays: Sequence[str] = FIXED_HOLIDAYS) -> dict[str, Column]:
    """Name -> expression for the eleven calendar features; Monday is day 0."""
    dow = F.weekday(date)
    day = F.dayofmonth(date)
    weekend = dow >= 5
    cols = {
        "day_of_week": dow,
        "is_weekend": weekend.cast("int"),
        "day_of_month": day,
        "week_of_year": F.weekofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "is_month_start": (day == 1).cast("int"),
        "is_month_end": (date == F.last_day(date)).cast("int"),
        "is_holiday_hr": F.coalesce(F.date_format(date, "MM-dd").isin(*holidays), F.lit(False)).cast("int"),
        "days_since_weekend": F.when(weekend, 0).otherwise(dow),
        "days_until_weekend": F.when(weekend, 0).otherwise(5 - dow),
    }
    return {n: cols[n].cast("long") for n in NAMES}
