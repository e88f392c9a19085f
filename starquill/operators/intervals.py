"""Joins of moments to intervals that come as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
# The finest bins are of 2 ** 16 microseconds; above 2 ** 62 the whole calendar is one bin.
FINEST, COARSEST = 16, 62


def micros(moment: Column) -> Column:
    """Microseconds of a timestamp without zone since 1970, as a whole number."""
    whole = F.datediff(moment, F.lit("1970-01-01").cast("date")).cast("long") * 86400
    seconds = whole + F.hour(moment) * 3600 + F.minute(moment) * 60
    return seconds * MICROS_PER_SECOND + (
        F.extract(F.lit("SECOND"), moment) * MICROS_PER_SECOND).cast("long")


def _bin(value: Column, level: Column) -> Column:
    """Number of the bin of ``2 ** level`` microseconds that holds ``value``."""
    return F.call_function("shiftright", value, level)


def interval_join(facts: DataFrame, moment: str, bounds: DataFrame, start: str, end: str
                  ) -> DataFrame:
    """Each row of ``facts`` with every row of ``bounds`` such that start <= moment < end.

    An interval is filed under the bins of the least size that is not below its length, of
    which it meets two at most.  A fact looks up its bin of every size that occurs; their
    list is short, 47 sizes at most.  So the join is on (size, bin), with the bounds as
    a residual, and never compares a fact with all intervals.  A hot bin is split by AQE.

    Rows with a NULL in moment, start or end meet nothing, nor do empty intervals.
    """
    first, last = micros(F.col(start)), micros(F.col(end)) - 1
    length = F.greatest(last - first, F.lit(1)).cast("long")
    # digits of the length in base two: 2 ** level is above it
    level = F.greatest(F.length(F.regexp_replace(F.bin(length), "^0+", "")), F.lit(FINEST))
    filed = (bounds.filter(F.col(start) < F.col(end))
             .withColumn("__size", F.least(level, F.lit(COARSEST)).cast("int"))
             .withColumn("__bin", F.explode(F.array_distinct(F.array(
                 _bin(first, F.col("__size")), _bin(last, F.col("__size")))))))
    sizes = sorted(r[0] for r in filed.select("__size").distinct().collect())
    if not sizes:
        sizes = [COARSEST]
    placed = (facts.withColumn("__size", F.explode(F.array(*[F.lit(s) for s in sizes])))
              .withColumn("__bin", _bin(micros(F.col(moment)), F.col("__size"))))
    met = placed.join(filed, ["__size", "__bin"])
    return met.filter((F.col(moment) >= F.col(start)) & (F.col(moment) < F.col(end))).drop(
        "__size", "__bin")
