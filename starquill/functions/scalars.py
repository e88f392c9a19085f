"""Column expressions shared by the reports and jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rating codes and the audience each one stands for.
AUDIENCE_BY_RATING = {
    "G": "All ages",
    "PG": "Parental guidance suggested",
    "PG-13": "13+ (parents strongly cautioned)",
    "R": "Under 17 requires accompanying parent/adult guardian",
    "NC-17": "18+ only / adults only",
}
UNKNOWN_AUDIENCE = "Unknown"

# Units of a printed byte size, each 1024 times the one before.
SIZE_UNITS = ["bytes", "kB", "MB", "GB", "TB"]


def address_text(address: Column, address2: Column) -> Column:
    """Both address lines, or the first alone where the second is NULL or empty."""
    has_second = address2.isNotNull() & (address2 != "")
    return F.when(has_second, F.concat(address, F.lit(", "), address2)).otherwise(address)


def full_name(first: Column, last: Column) -> Column:
    """First and last name; NULL where either is NULL."""
    return F.concat(first, F.lit(" "), last)


def audience_label(rating: Column) -> Column:
    pairs = [F.lit(x) for pair in AUDIENCE_BY_RATING.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[rating], F.lit(UNKNOWN_AUDIENCE))


def whole_days(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``, any started day counted in full.

    Works on the calendar, not on epoch values, so the session time zone has no say.
    """
    days = F.datediff(end, start)
    reached = start + F.make_dt_interval(days)
    return (days + F.when(end > reached, 1).otherwise(0)).cast("int")


def _micros_of_day(moment: Column) -> Column:
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    return seconds.cast("long") * 1000000 + (
        F.extract(F.lit("SECOND"), moment) * 1000000).cast("long")


def fractional_days(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end`` with their fraction, again by the calendar."""
    micros = (F.datediff(end, start).cast("long") * 86400000000
              + _micros_of_day(end) - _micros_of_day(start))
    return micros / F.lit(86400e6)


def late_fee_amount(days: Column, duration: Column, rate: Column) -> Column:
    """The rate, plus one more rate for every day past the agreed duration."""
    late_days = F.greatest(days - duration, F.lit(0))
    return (rate + late_days * rate).cast("decimal(5,2)")


def balance_charge(days: Column, duration: Column, rate: Column, replacement: Column) -> Column:
    """Rate, plus the replacement cost past twice the duration, else 1 per late day."""
    extra = (F.when(days > duration * 2, replacement)
             .when(days > duration, (days - duration).cast("decimal(12,2)"))
             .otherwise(F.lit(0).cast("decimal(12,2)")))
    return rate + extra


def name_slug(prefix: str, first: Column, last: Column) -> Column:
    """Lower-case account name; in each of the two names a run of other characters becomes one
    underscore, and one more stands between them."""
    def cleaned(name: Column) -> Column:
        return F.regexp_replace(name, "[^a-zA-Z0-9]+", "_")
    return F.lower(F.concat(F.lit(prefix), cleaned(first), F.lit("_"), cleaned(last)))


def pretty_size(n_bytes: Column) -> Column:
    """Byte count in the smallest unit that keeps the number below 10240."""
    choices = []
    for power, unit in enumerate(SIZE_UNITS):
        number = F.round(n_bytes / F.lit(float(1024 ** power))).cast("long")
        text = F.concat(number.cast("string"), F.lit(f" {unit}"))
        last = power == len(SIZE_UNITS) - 1
        choices.append(text if last else F.when(n_bytes < 10240 * 1024 ** power, text))
    return F.coalesce(*choices)


def is_blank(text: Column) -> Column:
    """True for NULL and for text of blanks only."""
    return text.isNull() | (F.btrim(text) == "")


def same_text(text: Column) -> Column:
    """Comparison form of a name: trimmed, upper case."""
    return F.upper(F.btrim(text))


def title_pattern(text: str) -> str:
    """A LIKE pattern as given, or a bare word wrapped as ``%word%``."""
    if text is None or not text.strip(" "):
        raise ValueError("the title pattern must not be empty")
    if "%" in text or "_" in text:
        return text
    return "%" + text.strip(" ") + "%"
