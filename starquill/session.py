"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

# UTC keeps timestamp results comparable between engines.  The skew settings let AQE split
# a hot join key even where the split costs one more shuffle downstream.  The last one stops
# PySpark from recording a call site for every column expression of a plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "starquill", master: str | None = None,
                  options: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_settings(largest_shuffle_bytes: int, cores: int,
                     partition_bytes: int = 200 << 20) -> dict[str, str]:
    """Options for ``build_session`` that keep shuffle partitions at a size a task can hold.

    AQE merges small partitions but does not split ordinary large ones, so the number to
    start from must fit the largest shuffle: 20 TB, for one, start from 100,000.
    """
    start = max(2 * cores, -(-largest_shuffle_bytes // partition_bytes))
    return {"spark.sql.shuffle.partitions": str(start),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
            "spark.sql.files.maxPartitionBytes": str(256 << 20)}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster such a
    folder would be lost together with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="starquill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no table uses yet."""
    return f"{shared_dir(spark).rstrip('/')}/starquill-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Cuts the lineage and fixes every non-deterministic value (row positions, ids), so a
    recomputed task after a lost executor cannot hand out different ones.
    """
    path = new_table_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: each query's are deleted as it ends.

    Without this they lie on the executors' disks until the driver's garbage collector finds them
    unused.  For queries whose shuffles no later one reads.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder, in whatever store the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.delete(target, True)


def discard(written: DataFrame) -> None:
    """Delete a table that ``materialise`` has returned, once no query reads it any more."""
    for folder in {unquote(file).rpartition("/")[0] for file in written.inputFiles()}:
        if not folder.rpartition("/")[2].startswith("starquill-"):
            raise ValueError(f"not a table of materialise: {folder}")
        remove_path(written.sparkSession, folder)
