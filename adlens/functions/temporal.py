"""Time expressions over zone-less timestamps."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_NEVER = 31536000  # stands for "no earlier event": one year


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microsecond fractions; independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def weekend_flag(day_of_week: Column) -> Column:
    """1 on Saturday and Sunday (Monday is 0); 0 when the day is unknown."""
    return F.coalesce((day_of_week >= 5).cast("int"), F.lit(0))


def calendar(ts: Column) -> dict[str, Column]:
    """hour, day_of_week, is_weekend and date of a timestamp."""
    dow = F.weekday(ts)
    return {
        "hour": F.hour(ts),
        "day_of_week": dow,
        "is_weekend": weekend_flag(dow),
        "date": F.to_date(ts),
    }


def business_hours(hour: Column) -> Column:
    """1 from 9 to 17, both ends included."""
    return F.coalesce(hour.between(9, 17).cast("int"), F.lit(0))


def time_of_day(hour: Column) -> Column:
    """Part of the day; bins are closed on the right: 0-6, 7-12, 13-18, 19-24."""
    return (
        F.when(hour.isNull() | (hour < 0) | (hour > 24), "nan")
        .when(hour <= 6, "night")
        .when(hour <= 12, "morning")
        .when(hour <= 18, "afternoon")
        .otherwise("evening")
    )


def cyclical(value: Column, period: int, name: str) -> dict[str, Column]:
    """Sine and cosine of a value on a circle of `period` steps."""
    angle = F.lit(2 * pi) * value / F.lit(period)
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def parse_log_hour(value: Column) -> Column:
    """`YYMMDDHH` digits to a timestamp; anything else is null.

    Two-digit years follow the POSIX rule: 69-99 are 19xx, 00-68 are 20xx.
    """
    text = value.cast("string")
    digits = F.when(F.length(text) < 8, F.lpad(text, 8, "0")).otherwise(text)
    century = F.when(F.substring(digits, 1, 2) >= "69", "19").otherwise("20")
    stamp = F.concat(
        century,
        F.substring(digits, 1, 2),
        F.lit("-"),
        F.substring(digits, 3, 2),
        F.lit("-"),
        F.substring(digits, 5, 2),
        F.lit(" "),
        F.substring(digits, 7, 2),
        F.lit(":00:00"),
    )
    return F.when(digits.rlike("^[0-9]{8}$"), stamp.try_cast("timestamp_ntz"))
