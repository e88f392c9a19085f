"""Exact top-k inner products from an impact-ordered index, score at a time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.llm.common import lists_of, whole_groups
from starquill.session import materialise

SHARD_ROWS = 16384
QUERY_ROWS = 256
SEGMENTS = 256   # quantised sizes of a component
FALL = 0.8       # of the impact that a pass goes down to
PASSES = 12      # at most, of about as many postings each
PROVEN = 64      # members that are rescored rather than searched on
RESCORED = 0.25  # of the work on the postings left, likewise


def quantise(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component as a double; null for a vector that is null or
    holds a null or a component that is not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(
        x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(finite, F.transform(
        vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")))


class Shard:
    """The index of some vectors, given in the order that ties follow: for each dimension the
    postings in segments of equal quantised size of the component, from the greatest."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n, width = vectors.shape
        columns = np.ascontiguousarray(vectors.T)
        sizes = np.abs(columns)
        falling = np.argsort(-sizes, axis=1, kind="stable")
        self.rows = falling.astype(np.int32)
        self.values = np.take_along_axis(columns, falling, axis=1).astype(np.float64)
        self.greatest = int(sizes.max(initial=0))
        self.step = self.greatest // SEGMENTS + 1
        segment = np.arange(width)[:, None] * SEGMENTS + sizes // self.step
        counts = np.bincount(segment.ravel(), minlength=width * SEGMENTS).reshape(width, SEGMENTS)
        # postings of a dimension in a segment and in those of greater sizes
        self.held = np.c_[counts[:, ::-1].cumsum(axis=1)[:, ::-1], np.zeros(width, np.int64)]
        self.processed = 0

    def search(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best scores and their rows, ties to the first row; row ``own`` is left out.

        A segment's impact is the size of the query's component times the greatest size that the
        segment may hold.  Passes process the segments of all dimensions by falling impact.  What
        a vector still lacks is less than the impact reached for each of its postings not met,
        which bounds its score from above; the k-th best exact score of the vectors that lead so
        far is a floor.  A vector bounded below the floor is proven out.  The search stops when
        rescoring all others is at most ``RESCORED`` of the work on the postings left, or they
        are few, or no postings are left.
        """
        n = len(self.vectors)
        live = np.ones(n, bool)
        if own is not None:
            live[own] = False
        k = min(k, int(live.sum()))
        if not k:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        used = np.flatnonzero(query)
        weights = np.abs(query[used])
        added, seen, done = np.zeros(n), np.zeros(n, np.int64), np.zeros(len(used), np.int64)
        impact = float(weights.max(initial=0)) * self.greatest
        # sums of doubles are exact up to 2^53, and off by less than this beyond
        slack = impact * max(1, len(used)) ** 2 * 2.0 ** -50
        total, floor, members = n * len(used), None, np.flatnonzero(live)
        while impact:
            impact = impact * FALL if impact > 1 else 0.0
            lowest = np.minimum(impact / (weights * float(self.step)), SEGMENTS).astype(np.int64)
            ends = self.held[used, lowest] if impact else np.full(len(used), n)
            if impact and (ends - done).sum() * PASSES < total:
                continue
            parts = [(d, a, b) for d, a, b in zip(used.tolist(), done.tolist(), ends.tolist()) if b > a]
            if parts:
                rows = np.concatenate([self.rows[d, a:b] for d, a, b in parts])
                added += np.bincount(rows, np.concatenate(
                    [self.values[d, a:b] * float(query[d]) for d, a, b in parts]), n)
                seen += np.bincount(rows, minlength=n)
                self.processed += len(rows)
                done = ends
            leading = np.flatnonzero(live)
            lead = min(len(leading), 4 * k)
            leading = leading[np.argpartition(added[leading], len(leading) - lead)[-lead:]]
            exact = self.vectors[leading] @ query
            least = int(np.partition(exact, lead - k)[lead - k])
            floor = least if floor is None else max(floor, least)
            members = np.flatnonzero(live & (added + impact * (len(used) - seen) + slack >= floor))
            if (len(members) <= max(k, PROVEN)
                    or len(members) * len(used) <= RESCORED * (total - int(done.sum()))):
                break
        scores = self.vectors[members] @ query
        best = np.lexsort((members, -scores))[:k]
        return scores[best], members[best]


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
          k: int = 10, scale: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` rows with the
    greatest inner product of each query row, of integers floor(``scale`` * x); ties go to the
    smaller id.  Every row but the query's own is a candidate.

    The index lies in shards of about SHARD_ROWS vectors, dealt by a hash of the id.  Queries are
    dealt to blocks of about QUERY_ROWS, and every block goes to every shard: queries, not the
    indexed vectors, are copied.  Each shard gives its ``k`` best of each query, and the ``k``
    best of those are exact.

    A vector that is null or holds a null, a NaN or an infinity takes no part, neither does a
    row without id.  Repeated ids are candidates of one another, each a row.  Vectors of another
    length than the query's are no candidates.  With fewer candidates than ``k`` all are
    returned.  No queries or no rows give no rows; other columns aren't read, except by
    ``is_query``.
    """
    rows = vectors.select(F.col(key).alias("id"), quantise(F.col(vector), scale).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    # numbered and written once, so a query knows its own row among repeated ones
    rows = materialise(rows.filter("v IS NOT NULL AND id IS NOT NULL")
                       .withColumn("row", F.monotonically_increasing_id()), "vectors")
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards = max(1, math.ceil(n_rows / SHARD_ROWS))
    blocks = max(1, math.ceil(n_queries / QUERY_ROWS))
    indexed = rows.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
                          F.lit(0).alias("block"), "row", "id", "v")
    asked = rows.filter("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        (F.pmod(F.xxhash64("row"), F.lit(blocks)) + 1).cast("int").alias("block"), "row", "id", "v")
    parts = indexed.unionByName(asked).withColumn("part", F.col("shard") * F.lit(blocks + 1).cast("long") + F.col("block"))
    id_type = vectors.schema[key].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index = None, {}
        for group in whole_groups(batches, "part"):
            part = group.column("part").to_numpy()
            begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist()
            for begin, end in zip(begins, [*begins[1:], len(part)]):
                rows_ = group.slice(begin, end - begin).combine_chunks()
                at, block = rows_["shard"][0].as_py(), rows_["block"][0].as_py()
                if shard != at:
                    shard, index = at, {}
                if block == 0:
                    index = _indexed(rows_)
                else:
                    yield _found(rows_, index, k, group.schema.field("id").type)

    # a task per shard
    found = (parts.repartitionById(shards, "shard").sortWithinPartitions("part").mapInArrow(
        search, f"row long, query_id {id_type}, vec_id {id_type}, score long"))
    ranked = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _lengths(rows: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per vector length, in order of the rows: their places and their vectors."""
    column = rows["v"].combine_chunks()
    values, offsets = lists_of(column)
    lengths = np.diff(offsets)
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        places = offsets[at][:, None] + np.arange(width)
        yield width, at, values[places].astype(np.int64).reshape(len(at), width)


def _indexed(rows: pa.Table) -> dict[int, tuple[Shard, list, dict[int, int]]]:
    """By vector length: the index, the ids in order, and each row's place."""
    rows = rows.sort_by("id")
    ids, numbers = rows["id"].to_pylist(), rows["row"].to_pylist()
    return {width: (Shard(vectors), [ids[i] for i in at.tolist()],
                    {numbers[i]: place for place, i in enumerate(at.tolist())})
            for width, at, vectors in _lengths(rows)}


def _found(queries: pa.Table, index: dict, k: int, kind: pa.DataType) -> pa.RecordBatch:
    names, numbers = queries["id"].to_pylist(), queries["row"].to_pylist()
    out: list[tuple] = []
    for width, at, vectors in _lengths(queries):
        if width in index:
            shard, ids, place = index[width]
            for i, vector in zip(at.tolist(), vectors):
                scores, members = shard.search(vector, place.get(numbers[i]), k)
                out += [(numbers[i], names[i], ids[m], s)
                        for m, s in zip(members.tolist(), scores.tolist())]
    columns = list(zip(*out)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), kind, kind, pa.int64()))],
        names=["row", "query_id", "vec_id", "score"])
