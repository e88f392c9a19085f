"""Reading and writing whole tables as Parquet."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starquill.functions.scalars import pretty_size
from starquill.session import materialise, new_table_path, remove_path

MOST_FOLDERS = 100_000


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Write the rows of ``df`` as a new table and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stage_table(df: DataFrame, label: str) -> str:
    """Write a new table state beside the old one and return its path.

    A table that is being read must not be overwritten; the caller points its readers at
    the new path once the write has finished.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition: str, spread: Sequence[str]) -> DataFrame:
    """A table with one folder per value of ``partition``.

    Rows are range-partitioned on the folder column and the ``spread`` columns: a large
    folder is written by several tasks, and a small one by one or two.
    """
    (df.repartitionByRange(partition, *spread)
       .write.partitionBy(partition).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of every Parquet file below ``folder``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(folder).select("path", "length"))


def footprint(spark: SparkSession, folder: str, like: str = "%") -> DataFrame:
    """Files and bytes per table for the tables whose name matches ``like``."""
    inside = F.substring_index(F.col("path"), folder.rstrip("/") + "/", -1)
    table = F.regexp_replace(F.substring_index(inside, "/", 1), r"\.parquet$", "")
    sizes = (table_files(spark, folder).withColumn("table_name", table)
             .filter(F.col("table_name").like(like))
             .groupBy("table_name")
             .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes")))
    return sizes.withColumn("total_size", pretty_size(F.col("total_bytes")))


def compact(spark: SparkSession, path: str, label: str, file_bytes: int = 128 << 20,
            partition: Sequence[str] = ()) -> str:
    """Rewrite a table of many small files into files of about ``file_bytes``.

    Neighbouring input splits are merged without a shuffle.  A table that has a folder per value
    of ``partition`` keeps them: its rows are range-partitioned on those columns and, within a
    large folder, on a hash of the row.
    """
    size = table_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    n_files = max(1, math.ceil(size / file_bytes))
    table = spark.read.parquet(path)
    if not partition:
        return stage_table(table.coalesce(n_files), label)
    target = new_table_path(spark, label)
    (table.repartitionByRange(n_files, *partition, F.xxhash64(*table.columns))
     .write.partitionBy(*partition).parquet(target))
    return target


def truncate(df: DataFrame) -> DataFrame:
    """The empty state of a table."""
    return df.limit(0)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that stay: those for which ``condition`` is false or NULL."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def partitions_with(table: DataFrame, condition: Column, partition: str) -> DataFrame:
    """The values of the folder column that have rows for which ``condition`` holds."""
    return table.filter(condition).select(partition).distinct()


class Rewritten(NamedTuple):
    """Folder values whose rows were rewritten, and those that were emptied and removed."""

    rewritten: list
    removed: list


def delete_where_by_folder(spark: SparkSession, path: str, condition: Column,
                           partition: str) -> Rewritten:
    """Delete the rows for which ``condition`` holds from a table with a folder per value of
    ``partition``, in place; folders without such rows keep their files.

    The rows that stay in the other folders are staged beside the table, in full, before
    anything of it is replaced, so a job that fails on the way leaves all rows in one place or
    the other; the folders then go in by a dynamic partition overwrite, and those that have no
    rows left are removed.  The list of folders is the only thing that reaches the driver.
    """
    table = spark.read.parquet(path)
    touched = [r[0] for r in partitions_with(table, condition, partition).collect()]
    if not touched:
        return Rewritten([], [])
    named = [v for v in touched if v is not None]
    of_touched = F.col(partition).isin(named)
    if None in touched:
        of_touched = of_touched | F.col(partition).isNull()
    kept = materialise(delete_where(table.filter(of_touched), condition), "kept-folders")
    spread = F.xxhash64(*[c for c in kept.columns if c != partition])
    (kept.repartitionByRange(partition, spread).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    left = {r[0] for r in kept.select(partition).distinct().collect()}
    emptied = [v for v in touched if v not in left]
    if emptied:
        folders = table.filter(of_touched).select(partition, F.col("_metadata.file_path").alias("f"))
        gone = folders.filter(F.col(partition).isin([v for v in emptied if v is not None])
                              | (F.col(partition).isNull() & F.lit(None in emptied)))
        for row in gone.select(F.regexp_replace("f", "/[^/]*$", "").alias("folder")).distinct().collect():
            remove_path(spark, unquote(row["folder"]))
    return Rewritten([v for v in touched if v in left], emptied)


def pruned_by(stored: DataFrame, dimension: DataFrame, partition: str) -> DataFrame:
    """The rows of a table with a folder per value of ``partition`` whose value is among those of
    the filtered ``dimension``.

    Which folders those are is known only when the dimension has been read: the join is on the
    folder column, and Catalyst hands the values it finds to the scan (dynamic partition
    pruning).  For that they are broadcast, if they are counted to be at most MOST_FOLDERS; more
    values than a table has folders are joined as any others.
    """
    wanted = dimension.select(partition).distinct()
    if wanted.limit(MOST_FOLDERS + 1).count() <= MOST_FOLDERS:
        wanted = F.broadcast(wanted)
    return stored.join(wanted, partition, "left_semi")
