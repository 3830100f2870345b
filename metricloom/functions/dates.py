"""Publish year and month, durations and snapshot time, all independent of the session zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month names in order, the label of a missing publish time, and the
# pattern of a duration text made of hours, minutes and seconds.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)
MISSING = "n/a"
DURATION_PATTERN = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?\z"

_MS_PER_DAY = 86_400_000
_US_PER_DAY = 86_400_000_000
_SECONDS_PER_DAY = 86_400
_MILLIS = r"^[+-]?[0-9]+\z"
# The calendar repeats after 400 years, which are so many days.
_CYCLE_YEARS = 400
_CYCLE_DAYS = 146_097


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_div(value: Column, by: int) -> Column:
    """Whole quotient, rounded downwards, over the full range of a bigint."""
    return F.call_function("div", value, F.lit(by)) - (value % by < 0).cast("bigint")


def _in_cycle(text: Column) -> tuple[Column, Column]:
    """UTC date of an epoch-millis text moved into the 400 years from 1970 on, and the years to add; NULL if
    the text is missing or not a bigint."""
    millis = F.when(text.rlike(_MILLIS), text.try_cast("bigint"))
    days = _floor_div(millis, _MS_PER_DAY)
    cycle = _floor_div(days, _CYCLE_DAYS)
    return F.date_from_unix_date((days - cycle * _CYCLE_DAYS).cast("int")), cycle * _CYCLE_YEARS


# The labels below mention a part of the date more than once, always where it is computed
# anyway: codegen then computes it once. Inside a CASE branch it would not.


def publish_year(c: Column | str) -> Column:
    """UTC year, as text, of an epoch-millis text; a missing text gives ``n/a`` and an
    unreadable one NULL. As in ISO-8601 a year has at least four digits, and a sign outside
    0..9999."""
    text = _col(c)
    date, years = _in_cycle(text)
    year = F.year(date) + years
    digits = F.abs(year).cast("string")
    sign = F.when(year > 9999, "+").when(year < 0, "-").otherwise("")
    label = F.concat(sign, F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), "0"))
    return F.coalesce(label, F.when(text.isNull(), MISSING))


def publish_month_number(c: Column | str) -> Column:
    """UTC month ``01``..``12`` of an epoch-millis text; missing gives ``n/a``, unreadable NULL."""
    text = _col(c)
    number = F.lpad(F.month(_in_cycle(text)[0]).cast("string"), 2, "0")
    return F.coalesce(number, F.when(text.isNull(), MISSING))


def publish_month(c: Column | str) -> Column:
    """English name of the UTC publish month; missing or unreadable gives NULL."""
    number = F.month(_in_cycle(_col(c))[0])
    return F.get(F.array(*map(F.lit, MONTHS)), number - 1)


def duration_seconds(c: Column | str) -> Column:
    """Seconds of an ISO-8601 duration text.

    Text without any of the letters H, M, S is 0 (so day- or week-only durations are);
    text that has them but is not hours/minutes/seconds is NULL, as is a sum that does
    not fit an integer.
    """
    text = _col(c)

    def part(group: int) -> Column:
        # The leading zero turns an absent part into 0 and leaves the others as they are.
        digits = F.concat(F.lit("0"), F.regexp_extract(text, DURATION_PATTERN, group))
        return digits.try_cast("int").cast("bigint")

    total = (part(1) * 3600 + part(2) * 60 + part(3)).try_cast("int")
    return F.when(~text.rlike("[HMS]"), 0).when(text.rlike(DURATION_PATTERN), total)


def instant_from_utc(c: Column | str) -> Column:
    """Instant of a zone-less timestamp read as UTC wall-clock time.

    Date and time of day are taken apart because a cast would go through the session zone
    and shift the hours that zone skips in spring.
    """
    wall = _col(c)
    second = F.extract(F.lit("SECOND"), wall)
    in_day = (F.hour(wall) * 3600 + F.minute(wall) * 60).cast("bigint") * 1_000_000 + (second * 1_000_000).cast("bigint")
    return F.timestamp_micros(F.unix_date(wall.cast("date")).cast("bigint") * _US_PER_DAY + in_day)


def utc_day(c: Column | str) -> Column:
    """UTC calendar date of an instant."""
    seconds = F.unix_seconds(_col(c))
    return F.date_from_unix_date(_floor_div(seconds, _SECONDS_PER_DAY).cast("int"))


def with_snapshot_time(df: DataFrame, at: datetime | str | None = None) -> DataFrame:
    """``df`` with ``current_time`` in front: the processing time, fixed once per batch, or
    the given instant (ISO text with zone, or an aware datetime)."""
    if at is None:
        moment = F.current_timestamp()
    else:
        text = at.isoformat() if isinstance(at, datetime) else at
        moment = F.lit(text).cast("timestamp")
    return df.select(moment.alias("current_time"), "*")
