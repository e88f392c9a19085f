"""Row selection and numbering."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.session import materialise
from starquill.sources.inline import values


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key.

    Catalyst turns the filter on the row number into a group limit ahead of the shuffle:
    each task sends on one row per key, however many rows a hot key has.
    """
    ranked = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def pick_first(df: DataFrame, *order: Column | str) -> DataFrame:
    """One row, the first in order (a top-1 per task, then a top-1 of those)."""
    return df.orderBy(*order).limit(1)


def pick_random(df: DataFrame, seed: int | None = None, key: str | None = None) -> DataFrame:
    """One row at random.  With a ``key``, the row whose key and ``seed`` have the least
    SHA-256, which depends neither on partitions nor on the order of rows."""
    if key is None:
        return df.orderBy(F.rand(seed)).limit(1)
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
    return df.orderBy(F.sha2(text, 256), key).limit(1)


def at_extremum(df: DataFrame, column: str, greatest: bool = True) -> DataFrame:
    """All rows that hold the greatest (or least) value of ``column``, ties included.

    ``df`` is needed twice, for the extremum and for the rows, and is written out in
    between.  Spark would share a shuffle between the two only as long as AQE treats both
    alike; once it splits a hot join key in one of them, the other runs again, unsplit.
    """
    df = materialise(df.filter(F.col(column).isNotNull()), "extremum")
    pick = F.max if greatest else F.min
    return df.filter(F.col(column) == df.agg(pick(column)).scalar())


def with_fallback(df: DataFrame, fallback: DataFrame) -> DataFrame:
    """``df``, or the rows of ``fallback`` if ``df`` has none."""
    n_rows = df.limit(1).agg(F.count(F.lit(1))).scalar()
    return df.unionByName(fallback.filter(n_rows == 0))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_num",
                within: Sequence[str] = (), after: int = 0) -> DataFrame:
    """Consecutive numbers in the order of ``order``, from ``after + 1``; per group of
    ``within`` if given.

    Rows are range-partitioned on group and order columns together, so neither the whole
    table nor one large group meets in one task.  Every task numbers its own rows, and
    the rows counted before it are added as an offset.  Rows that are equal in these columns
    follow a hash of the others, so they can be split between tasks too.
    """
    sort = [F.col(c) for c in (*within, *order)]
    others = [f.name for f in df.schema if f.name not in (*within, *order)
              and "map<" not in f.dataType.simpleString()]
    if others:
        sort.append(F.xxhash64(*others))
    placed = materialise(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_task", F.shiftright("_place", 33).cast("int"))
    runs = placed.groupBy("_task", *within).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    if within:
        # one row per group and task: at most as many rows per group as there are tasks
        earlier = (W.partitionBy(*within).orderBy("_task")
                   .rowsBetween(W.unboundedPreceding, -1))
        offsets = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        renamed = [F.col(c).alias(f"_g{i}") for i, c in enumerate(within)]
        offsets = offsets.select(F.col("_task").alias("_t"), "_first", "_offset", *renamed)
        match = F.col("_task") == F.col("_t")
        for i, c in enumerate(within):
            match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    else:
        # one row per task, so the list and its broadcast are bounded by the task count
        sizes = sorted((r["_task"], r["_first"], r["_n"]) for r in runs.collect())
        before = accumulate((n for _, _, n in sizes), initial=0)
        rows = [(t, first, n) for (t, first, _), n in zip(sizes, before)]
        offsets = F.broadcast(values(df.sparkSession, rows,
                                     "_t int, _first long, _offset long"))
        match = F.col("_task") == F.col("_t")
    number = F.col("_place") - F.col("_first") + F.col("_offset") + F.lit(1 + after)
    return placed.join(offsets, match).select(
        *df.columns, number.cast("long").alias(name))


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
              name: str = "next_value") -> DataFrame:
    """Every row with ``value`` of the row that follows it among those of equal ``keys``, in the
    order of ``order``; NULL for the last.

    A key may hold any share of the rows: the table is range-partitioned on keys and order
    together, each part looks for followers among its own rows, and the last row of a part gets
    the first one of the part behind it.  Only these first rows, one per part, come together.
    Rows that are equal in keys and order follow a hash of their other columns.  NULL keys are
    equal to each other.
    """
    sort = [F.col(c) for c in (*keys, *order)]
    others = [f.name for f in df.schema if f.name not in (*keys, *order)
              and "map<" not in f.dataType.simpleString()]
    if others:
        sort.append(F.xxhash64(*others))
    placed = materialise(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id()), "followed")
    placed = placed.withColumn("_part", F.shiftright("_place", 33).cast("int"))
    # a key of NULLs must not look like a missing follower, so the row's keys are in a struct
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
                   F.col(value).alias("value"))
    firsts = placed.groupBy("_part").agg(F.min_by(row, "_place").alias("_row"))
    handed = firsts.select(F.col("_part").alias("_before"), F.lead("_row").over(
        W.orderBy("_part")).alias("_handed"))
    inside = F.lead(row).over(W.partitionBy("_part").orderBy("_place"))
    follower = F.coalesce(F.col("_inside"), F.col("_handed"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(follower[f"k{i}"])
    return (placed.withColumn("_inside", inside)
            .join(F.broadcast(handed), F.col("_part") == F.col("_before"), "left")
            .select(*df.columns, F.when(follower.isNotNull() & same, follower["value"]).alias(name)))
