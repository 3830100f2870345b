"""Daily snapshots: the state of each key per day, and its change from day to day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.functions.dates import utc_day


# A moment in microseconds and a whole number share a decimal of 38 digits: the number, made
# positive and zero if missing, has the lower twenty.
_UNIT = 10**20
_OFFSET = 2**63 + 1
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _decimal(value: Column | int) -> Column:
    column = F.lit(str(value)) if isinstance(value, int) else value
    return column.cast("decimal(38,0)")


def latest_per_day(df: DataFrame, key: str, attributes: Sequence[str], measure: str) -> DataFrame:
    """The last snapshot of each key on each UTC day; of two taken at the same instant the
    one with the larger measure counts.

    An aggregate rather than a ranking window, so a key with very many snapshots is reduced
    before the shuffle. Time and measure are compared as one number of fixed width, which keeps
    that first aggregate a hash table; only one row per key, day and attributes is then compared
    with its texts.
    """
    kind = dict(df.dtypes)[measure]
    daily = df.select(key, "current_time", measure, *attributes, utc_day("current_time").alias("snapshot_date"))
    if kind not in _WHOLE:
        last = F.max(F.struct("current_time", measure, *attributes)).alias("last")
        picked = daily.groupBy(key, "snapshot_date").agg(last)
        return picked.select(key, "snapshot_date", *[f"last.{c}" for c in (*attributes, measure)])
    number = F.coalesce(_decimal(F.col(measure)) + _decimal(_OFFSET), _decimal(0))
    moment = _decimal(F.unix_micros("current_time")) * F.lit(str(_UNIT)).cast("decimal(21,0)")
    packed = (moment.cast("decimal(38,0)") + number).cast("decimal(38,0)")
    best = daily.groupBy(key, "snapshot_date", *attributes).agg(F.max(packed).alias("packed"))
    last = best.groupBy(key, "snapshot_date").agg(F.max(F.struct("packed", *attributes)).alias("last"))
    number = F.pmod(F.col("last.packed"), F.lit(str(_UNIT)).cast("decimal(38,0)"))
    value = F.when(number > 0, (number - _decimal(_OFFSET)).cast(kind)).alias(measure)
    return last.select(key, "snapshot_date", *[f"last.{c}" for c in attributes], value)


def percent_change(now: Column, before: Column) -> Column:
    """Change in percent; NULL without an earlier value or from zero."""
    return (now - before) * 100 / F.nullif(before, F.lit(0))


def daily_change(df: DataFrame, key: str, groups: Sequence[str], measure: str) -> DataFrame:
    """Sum of ``measure`` per group and day with the percent change from the group's
    previous snapshot day.

    The window runs over daily sums, so a group has at most one row per day however many
    snapshots it holds.
    """
    daily = (
        latest_per_day(df, key, groups, measure)
        .groupBy(*groups, "snapshot_date")
        .agg(F.sum(measure).alias(f"{measure}_sum"))
    )
    by_day = Window.partitionBy(*groups).orderBy("snapshot_date")
    value = F.col(f"{measure}_sum")
    change = percent_change(value, F.lag(value).over(by_day))
    return daily.select(*groups, "snapshot_date", value, change.alias("percent_change"))
