"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# about 40 MB in a Python worker
MEMO_ENTRIES, MEMO_BYTES = 250_000, 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(name: str, taken: Sequence[str]) -> str:
    """A column name that is not taken, whatever the case of its letters."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def schema_with(df: DataFrame, columns: Sequence[str], more: str) -> StructType:
    """Types of some columns of ``df``, and further columns given as DDL."""
    return StructType([*(df.schema[c] for c in columns), *StructType.fromDDL(more)])


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept between batches; emptied when it grows large."""

    n_bytes = 0

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        self.n_bytes += len(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO_ENTRIES or self.n_bytes > MEMO_BYTES:
            self.clear()
            self.n_bytes = 0
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for every ``width`` consecutive words; none if there are fewer words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    seed = np.uint64((width * 0x9E3779B97F4A7C15) % 2**64)
    joined = mix(hashes[:count] + seed)
    for shift in range(1, width):
        joined = mix(joined + hashes[shift:shift + count] + seed)
    return joined


def smaller(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what is made of a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls inside."""
    return (column.flatten().to_numpy(zero_copy_only=False),
            np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold only whole groups of equal ``key``, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(values, values[-1]))
        if first or (held and held[-1].column(key)[-1].as_py() != values[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, first)])
            held = [batch.slice(first)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
