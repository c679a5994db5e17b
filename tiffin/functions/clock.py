"""Time of day, calendar and duration."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiffin.schemas import (
    DEFAULT_TIMESTAMP_FORMAT,
    RUSH_HOURS,
    STRICT_JSON_TIMESTAMP_FORMAT,
    WEEKDAYS,
    WEEKEND_NUMBERS,
)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def weekday_number(ts: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(ts)


def weekday_position(name: Column) -> Column:
    """Place of a day name in a Monday-first week, for ordering."""
    return F.array_position(F.array(*[F.lit(day) for day in WEEKDAYS]), name)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def weekend_flag(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(WEEKEND_NUMBERS), 1).otherwise(0)


def rush_hour_flag(hour: Column) -> Column:
    in_a_rush = reduce(or_, [hour.between(first, last) for first, last in RUSH_HOURS])
    return F.when(in_a_rush, 1).otherwise(0)


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two times, counted in whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def duration_minutes_exact(start: Column, end: Column) -> Column:
    """Minutes between two times, fractions of a second kept."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60e6)


def parse_timestamp(text: Column, fmt: str = DEFAULT_TIMESTAMP_FORMAT) -> Column:
    """Time in one given format; text that does not fit gives NULL and not a failed job."""
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_iso_timestamp_strict(text: Column) -> Column:
    """ISO time in whole seconds with an optional offset, as the strict decoder takes it."""
    return F.try_to_timestamp(text, F.lit(STRICT_JSON_TIMESTAMP_FORMAT))


def parse_iso_timestamp(text: Column) -> Column:
    """ISO time with optional seconds, fraction and offset, `T` or space in the middle."""
    return F.coalesce(F.try_to_timestamp(text), parse_iso_timestamp_strict(text))


def parse_mixed_timestamp(text: Column) -> Column:
    """ISO time, plain date and time, or milliseconds since 1970."""
    # Four digits alone are a year, any other whole number is a count of milliseconds.
    digits = text.rlike(r"^(-\d+|\d{1,3}|\d{5,})$")
    return F.when(digits, F.timestamp_millis(text.try_cast("bigint"))).otherwise(
        parse_iso_timestamp(text)
    )


def iso_text(ts: Column) -> Column:
    """ISO text of a time; the fraction is written only if there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    has_fraction = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0
    return F.concat(whole, F.when(has_fraction, F.date_format(ts, ".SSSSSS")).otherwise(""))
