"""Casts that return NULL for bad input whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_number(c: Column | str, kind: str) -> Column:
    """Whole number from text or a number; a decimal fraction is cut off, anything else
    that is not a number or does not fit gives NULL."""
    value = _col(c)
    exact = value.try_cast(kind)
    # '12.7' is not a valid integer text under ANSI rules; the decimal step cuts the fraction.
    cut = value.try_cast("decimal(38,18)").try_cast(kind)
    has_point = F.contains(value.cast("string"), F.lit("."))
    no_exponent = ~F.contains(F.lower(value.cast("string")), F.lit("e"))
    return F.coalesce(exact, F.when(has_point & no_exponent, cut))


def to_long(c: Column | str) -> Column:
    return whole_number(c, "bigint")


def to_int(c: Column | str) -> Column:
    return whole_number(c, "int")


# A date and a time of day, then a zone; and the one form of the platform's documents.
_DATE_TIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?"
_ZONED = _DATE_TIME + r" ?(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)\z"
_ZONELESS = _DATE_TIME + r"\z"
_DOCUMENT_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z\z"


def to_instant(c: Column | str) -> Column:
    """Instant from ISO-8601 text with date and time of day, down to the second; an offset in the text is honoured, a text
    without one is UTC. Other text, a bare date, year or time among it, gives NULL."""
    text = _col(c)
    return F.when(text.rlike(_ZONED), text).when(text.rlike(_ZONELESS), F.concat(text, F.lit("Z"))).try_cast("timestamp")


def document_instant(c: Column | str) -> Column:
    """Instant from text of exactly the form ``2020-03-08T10:30:00Z``; any other text gives NULL."""
    text = _col(c)
    return F.when(text.rlike(_DOCUMENT_TIME), text).try_cast("timestamp")


def to_key(c: Column | str) -> Column:
    return _col(c).cast("string")
