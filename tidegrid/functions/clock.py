"""Calendar and clock expressions (UTC session zone)."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_CYCLE, WEEK_CYCLE = 24, 7


def check_year_month(year: int, month: int) -> None:
    if not 2000 <= year <= 2100:
        raise ValueError(f"year outside 2000..2100: {year}")
    if not 1 <= month <= 12:
        raise ValueError(f"month outside 1..12: {month}")


def year_month_ok(year: Column, month: Column) -> Column:
    """The same range rule for rows instead of driver arguments."""
    return year.between(2000, 2100) & month.between(1, 12)


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [first instant of the month, first instant of the next one)."""
    check_year_month(year, month)
    start = dt.datetime(year, month, 1)
    return start, (start + dt.timedelta(days=32)).replace(day=1)


def utc_literal(value: dt.datetime | str) -> Column:
    """A timestamp literal read as UTC wall-clock time."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz").cast("timestamp")


def in_month(ts: Column, year: int, month: int) -> Column:
    start, end = month_bounds(year, month)
    return (ts >= utc_literal(start)) & (ts < utc_literal(end))


def in_month_days(day: Column, year: int, month: int) -> Column:
    """The implied predicate on a stored date column; prunes partitions."""
    start, end = month_bounds(year, month)
    return (day >= F.lit(start.date())) & (day < F.lit(end.date()))


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def add_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def next_hour(ts: Column) -> Column:
    return add_hours(ts, 1)


def simulated_clock(now: Column, months_back: int = 2) -> Column:
    """``now`` moved back whole months (day clamped to month end), floored to the hour."""
    return hour_floor(now - F.make_ym_interval(F.lit(0), F.lit(months_back)))


def epoch_seconds(ts: Column) -> Column:
    return ts.cast("timestamp").cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def year_month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def day_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def cycle_sin(value: Column, period: int) -> Column:
    return F.sin(value * F.lit(2 * math.pi / period))


def cycle_cos(value: Column, period: int) -> Column:
    return F.cos(value * F.lit(2 * math.pi / period))


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(
        {
            "hour_of_day": hour_of_day(F.col(ts)),
            "day_of_week": day_of_week(F.col(ts)),
            "is_weekend": is_weekend(F.col(ts)),
        }
    )


def with_cycles(df: DataFrame) -> DataFrame:
    """Encode hour and weekday on fixed circles and drop the raw numbers."""
    hour, day = F.col("hour_of_day"), F.col("day_of_week")
    return df.withColumns(
        {
            "hour_of_day_sin": cycle_sin(hour, HOUR_CYCLE),
            "hour_of_day_cos": cycle_cos(hour, HOUR_CYCLE),
            "day_of_week_sin": cycle_sin(day, WEEK_CYCLE),
            "day_of_week_cos": cycle_cos(day, WEEK_CYCLE),
        }
    ).drop("hour_of_day", "day_of_week")


def as_utc(ts: Column, zone: str = "UTC") -> Column:
    """Wall-clock time of ``zone`` as a UTC instant; naive values count as UTC."""
    return F.to_utc_timestamp(ts.cast("timestamp"), zone)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
