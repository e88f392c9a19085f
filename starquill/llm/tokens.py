"""Token counts of whole texts; huge ones are encoded in overlapping chunks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.llm.byte_bpe import encoder
from starquill.llm.common import schema_with
from starquill.session import materialise

CHUNK = 32_768
OVERLAP = 256
WIDEN = 8

_CHUNK_SCHEMA = ("_row long, _k int, total long, head array<long>, head_before array<long>, "
                 "tail array<long>, tail_before array<long>")


def count_tokens(docs: DataFrame, path: str, text: str = "text", chunk: int = CHUNK,
                 overlap: int = OVERLAP, n_bytes: str = "n_bytes",
                 n_tokens: str = "n_tokens") -> DataFrame:
    """The columns of ``docs`` but the text, with UTF-8 bytes and tokens of the whole text.

    A text of up to ``chunk`` + ``overlap`` characters is encoded where it lies.  A longer one is
    cut into chunks that overlap, dealt to tasks of their own.  Each chunk tells the places
    inside its overlaps where the library surely begins a piece, with the tokens before.  Two
    neighbours are spliced at the first place that both tell; a text with a seam that has no
    such place goes another round with wider overlaps, at last as one chunk.

    Null and empty texts have 0 bytes and tokens; repeated rows are counted each; an empty table
    gives no rows; columns of ``docs`` named like the two new ones are replaced.
    """
    kept = docs.drop(*({n_bytes, n_tokens} - {text}))
    plain = [c for c in kept.columns if c != text]
    schema = schema_with(kept, plain, f"`{n_bytes}` long, `{n_tokens}` long, _long string")
    limit = chunk + overlap

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in plain),
                 pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([len(encode.ids(t)) // 4 if len(t) <= limit else None for t in texts],
                          pa.int64()),
                 pa.array([t if len(t) > limit else None for t in texts], pa.string())],
                names=[*plain, n_bytes, n_tokens, "_long"])

    first = (kept.withColumn("_text", F.col(text)).select(*plain, "_text")
             .mapInArrow(count, schema)
             .withColumn("_row", F.monotonically_increasing_id()))
    first = materialise(first, "tokens")  # fixes the row numbers; holds long texts only
    huge = first.filter(F.col("_long").isNotNull()).select("_row", "_long")
    counted = []
    while not huge.isEmpty():
        seams = materialise(_splice(_chunks(huge, path, chunk, overlap)), "tokens-spliced")
        counted.append(seams.filter("failed = 0").select("_row", "spliced"))
        huge = huge.join(seams.filter("failed > 0").select("_row"), "_row", "left_semi")
        overlap *= WIDEN
        chunk = max(chunk, 2 * overlap)
    result = first.drop("_long")
    if counted:
        spliced = counted[0]
        for more in counted[1:]:
            spliced = spliced.unionByName(more)
        result = (result.join(spliced, "_row", "left")
                  .withColumn(n_tokens, F.coalesce(F.col(n_tokens), F.col("spliced"))))
    return result.select(*plain, n_bytes, n_tokens)


def _chunks(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """A row per chunk, see ``count_tokens``; chunk k starts at character k * ``chunk``."""
    n_chunks = F.greatest(F.lit(1), F.ceil((F.length("_long") - overlap) / F.lit(chunk))).cast("int")
    cut = (huge.withColumn("_k", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
           .select("_row", "_k", F.substring(F.col("_long"), F.col("_k") * chunk + 1,
                                             F.lit(chunk + overlap)).alias("_part"))
           .repartition("_row", "_k"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = encoder(path).pieces
        for batch in batches:
            out: dict[str, list] = {name: [] for name in (
                "_row", "_k", "total", "head", "head_before", "tail", "tail_before")}
            for row, k, part in zip(*(batch.column(c).to_pylist() for c in ("_row", "_k", "_part"))):
                words, ids = words_of(part)
                start = k * chunk
                ends = list(accumulate(map(len, words), initial=start))
                before = list(accumulate((len(i) // 4 for i in ids), initial=0))
                # neither the chunk's own beginning nor its end is a place to splice at
                inner = [(p, n) for p, n in zip(ends[1:-1], before[1:-1]) if p > start]
                head = [x for x in inner if k and x[0] < start + overlap]
                tail = [x for x in inner if x[0] >= start + chunk]
                for name, value in (
                        ("_row", row), ("_k", k), ("total", before[-1]),
                        ("head", [p for p, _ in head]), ("head_before", [n for _, n in head]),
                        ("tail", [p for p, _ in tail]), ("tail_before", [n for _, n in tail])):
                    out[name].append(value)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, longs if isinstance(v[0], list) else
                          pa.int32() if name == "_k" else pa.int64())
                 for name, v in out.items()] if out["_k"] else
                [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), *[longs] * 4)],
                names=list(out))

    return cut.mapInArrow(encode, _CHUNK_SCHEMA)


def _splice(chunks: DataFrame) -> DataFrame:
    """Tokens per text, and the number of its seams without a common place."""
    after = W.partitionBy("_row").orderBy("_k")

    def ahead(name: str) -> Column:
        return F.lead(name).over(after)

    def at(values: Column, places: Column) -> Column:
        return F.get(values, (F.array_position(places, F.col("place")) - 1).cast("int"))

    seams = (chunks.withColumns({"next_head": ahead("head"), "next_before": ahead("head_before"),
                                 "is_seam": ahead("_k").isNotNull()})
             .withColumn("place", F.array_min(F.array_intersect("tail", "next_head"))))
    cut = (F.col("total") - at(F.col("tail_before"), F.col("tail"))
           + at(F.col("next_before"), F.col("next_head")))
    return seams.groupBy("_row").agg(
        (F.sum("total") - F.coalesce(F.sum(cut), F.lit(0))).alias("spliced"),
        F.count_if(F.col("is_seam") & F.col("place").isNull()).alias("failed"))
