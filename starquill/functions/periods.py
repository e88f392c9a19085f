"""Quarter periods written as ``YYYY-Q1`` to ``YYYY-Q4``."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the form of a period after trimming and upper-casing; there is no year 0.
PERIOD_PATTERN = r"^(?!0000)[0-9]{4}-Q[1-4]$"
# What follows the last moment that Python can write.
AFTER_LAST = "+10000-01-01 00:00:00"


class EmptyPeriod(ValueError):
    """No period was given."""


class MalformedPeriod(ValueError):
    """The text is not a period."""


def parse_period(text: str | None) -> tuple[int, int]:
    """Year and quarter; checked on the driver, before any plan exists."""
    if text is None or not text.strip(" "):
        raise EmptyPeriod("no quarter given; expected YYYY-Q1 to YYYY-Q4")
    value = text.strip(" ").upper()
    if not re.fullmatch(PERIOD_PATTERN, value):
        raise MalformedPeriod(f"not a quarter: {text!r}; expected YYYY-Q1 to YYYY-Q4")
    return int(value[:4]), int(value[6])


def period_of(day: dt.date) -> str:
    return f"{day.year:04d}-Q{(day.month - 1) // 3 + 1}"


Bounds = tuple[dt.datetime, dt.datetime | None]


def _month_start(year: int, month: int) -> dt.datetime | None:
    """None for the month after the last of year 9999."""
    return dt.datetime(year, month, 1) if year <= dt.MAXYEAR else None


def quarter_bounds(year: int, quarter: int) -> Bounds:
    """First instant of the quarter and first instant after it (None if that is in 10000)."""
    return (dt.datetime(year, 3 * quarter - 2, 1),
            _month_start(year + quarter // 4, 3 * quarter % 12 + 1))


def month_bounds(day: dt.date) -> Bounds:
    """First instant of the month of ``day`` and first instant after it."""
    return (dt.datetime(day.year, day.month, 1),
            _month_start(day.year + day.month // 12, day.month % 12 + 1))


def period_status(text: Column) -> Column:
    """``empty``, ``malformed`` or ``valid`` for a column of period texts."""
    value = F.upper(F.btrim(text))
    return (F.when(text.isNull() | (value == ""), "empty")
            .when(~value.rlike(PERIOD_PATTERN), "malformed")
            .otherwise("valid"))


def within(moment: Column, bounds: Bounds) -> Column:
    """Half-open range test on the raw column, so that it reaches the Parquet scan."""
    start, after = bounds
    end = after.isoformat(" ") if after else AFTER_LAST
    return (moment >= F.lit(start.isoformat(" ")).cast("timestamp_ntz")) & \
           (moment < F.lit(end).cast("timestamp_ntz"))


def period_start(text: Column) -> Column:
    """First instant of a period; NULL where the text is none."""
    value = F.upper(F.btrim(text))
    year, quarter = F.substring(value, 1, 4), F.substring(value, 7, 1)
    start = F.make_timestamp_ntz(
        F.try_to_number(year, F.lit("9999")).cast("int"),
        F.try_to_number(quarter, F.lit("9")).cast("int") * 3 - 2,
        F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.when(period_status(text) == "valid", start)


def period_end(text: Column) -> Column:
    """First instant after a period."""
    return period_start(text) + F.expr("INTERVAL 3 MONTHS")
