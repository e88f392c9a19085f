"""Exact sets of whole numbers as bitmaps that merge.

A set is a table with a row per 32,768 neighbouring numbers: ``bucket`` and ``bits``, 4 KB.
Each task builds its part of a bucket ahead of the shuffle, so what moves is as large as the
range of the keys, not as the rows that hold them, and sets of different days or folders merge
without going back to the rows.  It pays for keys that lie dense, as counted ids do; of sparse ones
(hashes) every key would take a bucket of its own, and ``distinct`` is the better set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """The different values of ``column`` (a whole number), NULL left out; a set per group of
    ``within`` if given."""
    value = F.col(column).cast("long")
    return (df.filter(value.isNotNull())
            .groupBy(*within, F.bitmap_bucket_number(value).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")))


def merged(sets: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The union of all sets, or of those of each group of ``within``."""
    return sets.groupBy(*within, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def set_sizes(sets: DataFrame, within: Sequence[str] = (), name: str = "n") -> DataFrame:
    """The number of members; a row per group of ``within``, else one row (0 for no set)."""
    count = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name)
    return sets.groupBy(*within).agg(count)


def missing_keys(facts: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """The different values of ``column`` that are no ``key`` of ``dimension``, each with the
    number of its rows (``n_rows``).

    Both sides become bitmaps; a bucket holds a missing key exactly if the union has more
    members than the dimension's.  Only the facts of such buckets are looked at again, so a
    sound table moves no key at all.
    """
    held = key_set(dimension, key).select("bucket", F.col("bits").alias("_held"))
    found = key_set(facts, column)
    both = (found.unionByName(held.select("bucket", F.col("_held").alias("bits")))
            .groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_all")))
    wrong = (both.join(held, "bucket", "left")
             .filter(F.col("_all") > F.coalesce(F.bitmap_count("_held"), F.lit(0)))
             .select("bucket"))
    value = F.col(column).cast("long")
    doubtful = (facts.select(F.col(column), F.bitmap_bucket_number(value).alias("bucket"))
                .join(wrong, "bucket", "left_semi")
                .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))
    near = (dimension.select(F.col(key).alias("_key"),
                             F.bitmap_bucket_number(F.col(key).cast("long")).alias("bucket"))
            .join(wrong, "bucket", "left_semi").select("_key"))
    return doubtful.join(near, F.col(column) == F.col("_key"), "left_anti")
