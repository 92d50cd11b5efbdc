"""Calendar expressions (FN1-FN7, FN11, FN21, FN22).

All are built-in Column expressions, so they stay inside whole-stage
codegen. Timestamps are TIMESTAMP_NTZ; the session is pinned to UTC so
flooring through ``date_trunc`` is exact.
"""

from __future__ import annotations

from collections.abc import Iterable

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hour(c: Column | str) -> Column:
    """FN1: floor a timestamp to the hour, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz")


def hour_of_day(c: Column | str) -> Column:
    """FN2."""
    return F.hour(_c(c)).cast("int")


def day_of_week(c: Column | str) -> Column:
    """FN3: Monday = 0 .. Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(c)).cast("int")


def is_weekend(c: Column | str) -> Column:
    """FN4: day of week >= 5."""
    return day_of_week(c) >= 5


def month(c: Column | str) -> Column:
    """FN5."""
    return F.month(_c(c)).cast("int")


def iso_week(c: Column | str) -> Column:
    """FN6: ISO-8601 week number."""
    return F.weekofyear(_c(c)).cast("int")


def day_name(c: Column | str) -> Column:
    """FN7: English day name (Monday .. Sunday)."""
    return F.date_format(_c(c), "EEEE")


def is_calendar_day(c: Column | str, dates: Iterable[dt.date]) -> Column:
    """FN11: the timestamp's date is one of ``dates`` (a small fixed set)."""
    return F.to_date(_c(c)).isin([F.lit(d) for d in dates])


def to_text(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """FN21: timestamp -> text."""
    return F.date_format(_c(c), fmt)


def from_text(c: Column | str, fmt: str | None = "yyyy-MM-dd HH:mm:ss") -> Column:
    """FN22: text -> TIMESTAMP_NTZ (NULL when it does not parse)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz") if fmt else \
        _c(c).try_cast("timestamp_ntz")


def hours_before(c: Column | str, hours: int) -> Column:
    return _c(c) - F.make_dt_interval(F.lit(0), F.lit(hours))


def hours_after(c: Column | str, hours: int) -> Column:
    return _c(c) + F.make_dt_interval(F.lit(0), F.lit(hours))
