"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.llm.common import mix, schema_with, smaller
from starquill.sources.inline import values

UNDETERMINED = "und"
MATRIX_BYTES = 64 << 20  # of the broadcast matrix, at most
LEAST_BITS = 8
LEAST_ROWS = 200         # of a label are in the sample, or all it has


@dataclass(frozen=True)
class Model:
    """``log_p[bucket, language]`` with the priors in the last row; languages in order."""

    languages: tuple[str, ...]
    log_p: np.ndarray
    orders: int

    @property
    def bits(self) -> int:
        return int(np.log2(len(self.log_p) - 1))


def buckets_of(texts: list[str], orders: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n of 1 to ``orders``: hash buckets of all n-grams of lower-cased characters in
    the texts, and the text of each."""
    texts = [t.lower() for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    points = points.astype(np.uint64)
    joined = np.zeros(len(points), np.uint64)
    for n in range(1, orders + 1):
        count = max(0, len(points) - n + 1)
        joined = joined[:count] * np.uint64(0x110000) + points[n - 1:n - 1 + count]
        inside = owner[:count] == owner[n - 1:n - 1 + count]
        hashed = mix(joined + np.uint64(n)) >> np.uint64(64 - bits)
        yield hashed[inside].astype(np.int64), owner[:count][inside]


def _slices(texts: list[str], chars: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring texts of about ``chars`` characters together, with the first's index."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def quota(counts: list[int], total: int) -> int:
    """The most rows of one label, if the labels have so many and all share ``total``."""
    left = total
    for i, n in enumerate(sorted(counts)):
        if n * (len(counts) - i) > left:
            return max(LEAST_ROWS, left // (len(counts) - i))
        left -= n
    return max(LEAST_ROWS, *counts)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", orders: int = 3,
        bits: int = 15, sample_rows: int = 40_000, smoothing: float = 0.5) -> Model:
    """Fit on a sample of the rows that have text and label (a documented bound: the model is small).

    Labels share ``sample_rows`` evenly: each has the same quota, at least LEAST_ROWS, and what
    labels with fewer rows leave goes to the others.  A label with no more rows than the quota has
    all of them in the sample; of another, about the quota, picked by a hash of the row and its
    place, so equal rows are picked one by one.  So about ``sample_rows`` are fitted, or up to LEAST_ROWS
    for each label if that is more.  Priors come from all rows.

    Empty texts have no n-grams and are not picked; a label that has no others is left out.  The matrix holds at most MATRIX_BYTES: with
    many languages it gets fewer buckets.  Without labelled rows the model has no language."""
    rows = labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("string").alias("label"),
        F.monotonically_increasing_id().alias("place"))
    most = MATRIX_BYTES // (8 << LEAST_BITS)
    has_text = F.col("text") != ""
    found = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(has_text).alias("told"))
    found = found.take(most + 1)
    counted = {r["label"]: r["n"] for r in found if r["told"]}
    told = {r["label"]: r["told"] for r in found if r["told"]}
    if len(found) > most:
        raise ValueError(f"more than {most} labels are too many for a broadcast matrix")
    languages = tuple(sorted(counted))
    if not languages:
        return Model((), np.zeros(((1 << bits) + 1, 0)), orders)
    while (8 << bits) * len(languages) > MATRIX_BYTES:
        bits -= 1
    rows = rows.filter(has_text)
    most_rows = quota(list(told.values()), sample_rows)
    shares = {name: -(-most_rows * (1 << 30) // n) for name, n in told.items() if n > most_rows}
    if shares:  # at most as many entries as the matrix has columns
        share = values(rows.sparkSession, list(shares.items()), "label string, share long")
        rows = rows.join(F.broadcast(share), "label", "left").filter(
            F.col("share").isNull()
            | (F.pmod(F.xxhash64("text", "place", F.lit("sample")), F.lit(1 << 30)) < F.col("share")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("label").to_pylist()
            texts = batch.column("text").to_pylist()
            for name in set(labels):
                held = totals.setdefault(name, np.zeros(1 << bits, np.int64))
                for _, part in _slices([t for t, x in zip(texts, labels) if x == name]):
                    for found, _ in buckets_of(part, orders, bits):
                        held += np.bincount(found, minlength=1 << bits)
        for name, held in totals.items():
            where = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([name] * len(where), pa.string()),
                "bucket": pa.array(where, pa.int32()), "n": pa.array(held[where], pa.int64())})

    grams = (rows.select("text", "label").mapInArrow(count, "label string, bucket int, n long")
             .groupBy("label", "bucket").agg(F.sum("n").alias("n")))
    # bounded by buckets times languages, see above
    found = grams.toArrow()
    counts = np.full((1 << bits, len(languages)), smoothing)
    place = {name: i for i, name in enumerate(languages)}
    columns = np.array([place[x] for x in found["label"].to_pylist()], np.int64)
    counts[found["bucket"].to_numpy(), columns] += found["n"].to_numpy()
    log_p = np.log(counts) - np.log(counts.sum(axis=0))
    prior = np.array([counted[x] for x in languages], float)
    return Model(languages, np.vstack([log_p, np.log(prior / prior.sum())]), orders)


def score_batch(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Language and posterior probability of each text, over all its n-grams."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not model.languages:
        return names, scores
    whole = [t if t and any(map(str.isalpha, t)) else "" for t in texts]
    for first, part in _slices(whole):
        total = np.tile(model.log_p[-1], (len(part), 1))
        for found, owner in buckets_of(part, model.orders, model.bits):
            if len(found):
                begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                total[owner[begins]] += np.add.reduceat(model.log_p[found], begins, axis=0)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i, text in enumerate(part):
            if text:
                names[first + i] = model.languages[best[i]]
                scores[first + i] = float(share[i])
    return names, scores


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior probability, from the whole text
    alone.  A text that is null or has no letter gets ``und`` and 0.  Columns of ``docs`` that
    have one of the two names are replaced; repeated rows are predicted each; an empty table
    stays empty."""
    kept = docs.drop(name, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = schema_with(kept, kept.columns, f"`{name}` string, `{score}` double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            names, scores = score_batch(batch.column(text).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, name, score])

    return kept.mapInArrow(predict, schema)

