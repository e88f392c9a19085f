"""Pinned snapshots: rows written once and read by name until they are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starquill.session import new_table_path, remove_path


class Snapshot:
    """The rows that ``df`` had when the snapshot was taken, under the name of a temporary view.

    The rows are a written table, so neither a change of the source nor a lost executor changes
    them.  ``drop``, or the end of a ``with`` block, removes the view and the written rows; what
    reads them must have run by then.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.name = df.sparkSession, name
        self.path = new_table_path(self.spark, "snapshot")
        df.write.parquet(self.path)
        self.spark.read.schema(df.schema).parquet(self.path).createOrReplaceTempView(name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.catalog.dropTempView(self.name)
        remove_path(self.spark, self.path)

    def __enter__(self) -> Snapshot:
        return self

    def __exit__(self, *failure) -> None:
        self.drop()
