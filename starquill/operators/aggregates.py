"""Aggregations that stay balanced when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.operators.rows import number_rows


def conditional_distinct_counts(df: DataFrame, group: str, item: str,
                                conditions: dict[str, Column]) -> DataFrame:
    """Per group, the number of distinct items that meet each condition.

    Rows are first reduced to one per (group, item), which spreads a large group over
    many tasks; the counts are then plain sums.
    """
    flags = [F.max(F.when(c, 1).otherwise(0)).alias(name) for name, c in conditions.items()]
    per_item = df.groupBy(group, item).agg(*flags)
    counts = [F.sum(F.when(F.col(item).isNotNull(), F.col(name)).otherwise(0)).alias(name)
              for name in conditions]
    return per_item.groupBy(group).agg(*counts)


def text_concat(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
                separator: str = ", ", part_size: int | None = 1000,
                name: str = "texts") -> DataFrame:
    """Values of a group joined to one text, NULL values left out.

    A group is split into consecutive texts of at most ``part_size`` values with a part
    number; no task then holds more than one part, and the parts read in order give the whole
    group.  With None the result is one text per group, for groups that fit a single value.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        *dict.fromkeys([*keys, *order, value]))
    if part_size is not None:
        rows = number_rows(rows, order, "_index", within=keys)
        part = F.expr(f"(_index - 1) div {part_size}").cast("int") + 1
        rows = rows.withColumn("part_no", part)
        keys = [*keys, "part_no"]
        sort = "_index"
    else:
        sort = ", ".join(f"`{c}`" for c in order)
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    joined = F.expr(f"listagg(`{value}`, '{quoted}') WITHIN GROUP (ORDER BY {sort})")
    return rows.groupBy(*keys).agg(joined.alias(name))


def consecutive_gaps(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key, each distinct value with the next one and the distance between them.

    The distinct step runs first, so a window holds the different values of a key and not
    its rows.
    """
    steps = df.filter(F.col(value).isNotNull()).select(key, value).distinct()
    following = F.lead(value).over(W.partitionBy(key).orderBy(value))
    return (steps.withColumn("next_value", following)
            .filter(F.col("next_value").isNotNull())
            .withColumn("gap", F.col("next_value") - F.col(value)))
