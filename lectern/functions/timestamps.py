"""Lenient ISO-8601 parsing without a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(?:-\d)?|\d{4}W\d{2}\d?)"
_CLOCK = r"(\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{4}(?:\d{2}(?:[.,]\d+)?)?)"
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d+)?)?)?)?"
_WHOLE = rf"^{_DATE}(?:.{_CLOCK}{_ZONE})?$"
_DAY, _SECOND = 86_400, 1_000_000


def _day(text: Column) -> Column:
    """Days since 1970 of a calendar or week date; null if there is no such day."""
    digits = F.regexp_replace(text, "-", "")
    calendar = F.unix_date(F.try_to_date(F.concat_ws("-", *[F.substring(digits, a, n) for a, n in ((1, 4), (5, 2), (7, 2))])))
    year = F.substring(digits, 1, 4)
    week = F.substring(digits, 6, 2).try_cast("int")
    weekday = F.coalesce(F.nullif(F.substring(digits, 8, 1), F.lit("")).try_cast("int"), F.lit(1))
    # The week with the fourth of January is the first of the year.
    fourth = F.try_to_date(F.concat(year, F.lit("-01-04")))
    monday = F.unix_date(F.trunc(fourth, "week")) + (week - 1) * 7
    within = F.weekofyear(F.date_from_unix_date(monday)) == week
    return F.when(text.contains("W"), F.when(within & weekday.between(1, 7), monday + weekday - 1)).otherwise(calendar)


def _clock(text: Column, hours: int) -> Column:
    """Microseconds of hh, hh:mm, hh:mm:ss with any fraction, with or without colons."""
    plain = F.regexp_replace(text, ":", "")
    h, m, s = (F.coalesce(F.nullif(F.substring(plain, a, 2), F.lit("")).try_cast("int"), F.lit(0)) for a in (1, 3, 5))
    # Digits beyond the sixth are cut off.
    fraction = F.rpad(F.substring(F.regexp_extract(plain, r"[.,](\d+)", 1), 1, 6), 6, "0").try_cast("long")
    micros = (h * 3600 + m * 60 + s).cast("long") * _SECOND + F.coalesce(fraction, F.lit(0))
    return F.when((h <= hours) & (m <= 59) & (s <= 59), micros)


def parse_iso_timestamp(text: Column | str) -> Column:
    """Text to a UTC timestamp; anything that is not ISO-8601 is null.

    Dates are calendar or week dates, extended or basic; any one character may
    stand before the time.  Fractions of a second follow a stop or a comma and
    count to the microsecond.  Short forms that Spark would accept on its own (a
    bare year, a year and month, a clock time) give null.  A value without an
    offset is read as UTC, whatever the session zone is.
    """
    value = F.col(text) if isinstance(text, str) else text
    date, clock, zone = (F.regexp_extract(value, _WHOLE, i) for i in (1, 2, 3))
    sign = F.when(F.startswith(zone, F.lit("-")), F.lit(-1)).otherwise(F.lit(1))
    offset = F.when(zone.isin("", "Z"), F.lit(0)).otherwise(sign * _clock(F.substring(zone, 2, 100), 23))
    time = F.when(clock == "", F.lit(0)).otherwise(_clock(clock, 23))
    micros = _day(date).cast("long") * (_DAY * _SECOND) + time - offset
    return F.when(value.rlike(_WHOLE), F.timestamp_micros(micros))
