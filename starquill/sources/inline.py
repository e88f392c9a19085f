"""Relations that come from the caller instead of from a table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def values(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Inline rows with a declared schema.

    They go in as one Arrow table, which makes a local relation of known size.  Catalyst
    then decides by that size whether to broadcast it; rows handed over one by one would
    make a relation of unknown size, which it never broadcasts.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    shape = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [()] * len(shape)
    arrays = [pa.array(column, field.type) for column, field in zip(columns, shape)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=shape), schema)


def known_if_empty(df: DataFrame) -> DataFrame:
    """``df``, or inline rows in its place if it has none, which Catalyst then knows while it
    plans: what is joined to them is not read.  Looks for a row, so ``df`` should be written."""
    return values(df.sparkSession, [], df.schema) if df.isEmpty() else df


def series(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """The integers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def ordered_elements(spark: SparkSession, items: Sequence[str | None], name: str) -> DataFrame:
    """Elements of an array with their position, counted from 1."""
    whole = values(spark, [(list(items),)], "items array<string>")
    return whole.select(F.posexplode("items").alias("position", name)).withColumn(
        "position", F.col("position") + 1)
