"""Packing of documents into sequences: a configuration linear program over the lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.llm.byte_bpe import encoder
from starquill.llm.common import schema_with, smaller
from starquill.operators.rows import number_rows
from starquill.session import materialise

CAPACITY = 1024
END_ID = 2
ROUNDS = 32
PRICINGS = 8
RATE = 0.02
KEEP = 0.8  # of the fractional solution; the rest is demand for best-fit


# -- the plan: sizes and counts only, so its work is bounded by the capacity ------------------

def price(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: for every room, the greatest value of sizes that fit it
    together, and the size to take first (0: leave one place empty)."""
    capacity = len(values) - 1
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        offers = values[1:room + 1] + best[room - 1::-1][:room]
        size = int(offers.argmax())
        if offers[size] > best[room - 1]:
            best[room], choice[room] = offers[size], size + 1
        else:
            best[room] = best[room - 1]
    return best, choice


def _filling(choice: np.ndarray, room: int) -> list[int]:
    sizes = []
    while room > 0:
        if choice[room]:
            sizes.append(int(choice[room]))
            room -= sizes[-1]
        else:
            room -= 1
    return sizes


def solve(demand: np.ndarray, rounds: int = ROUNDS, pricings: int = PRICINGS,
          rate: float = RATE) -> tuple[dict[tuple[int, ...], float], float]:
    """A fractional solution of the configuration program, and a lower bound on any solution.

    Every round owes each size its share of the demand.  Sizes that are owed something, largest
    first, get the dearest configuration that holds them; the others in it are then ahead, and
    weigh less by a factor that grows with their lead when configurations are priced next.
    Weights that no configuration exceeds prove the bound.
    """
    capacity = len(demand) - 1
    sizes = np.flatnonzero(demand)[::-1].tolist()
    volume = np.where(demand > 0, np.arange(capacity + 1) / capacity, 0.0)
    share = demand / rounds
    owed = np.zeros(capacity + 1)
    found: dict[tuple[int, ...], float] = {}
    bound = 0.0
    for _ in range(rounds):
        owed += share
        for block in np.array_split(sizes, pricings):
            lead = np.divide(-owed, share, out=np.zeros(capacity + 1), where=share > 0)
            weights = volume * np.exp(-rate * lead)
            best, choice = price(weights)
            bound = max(bound, float(demand @ weights) / best[capacity])
            for size in block.tolist():
                if owed[size] > 0:
                    config = tuple(sorted((size, *_filling(choice, capacity - size)), reverse=True))
                    amount = owed[size] / config.count(size)
                    found[config] = found.get(config, 0.0) + amount
                    for s in config:
                        owed[s] -= amount
    return found, bound


def rounded(found: dict[tuple[int, ...], float],
            demand: np.ndarray, keep: float = KEEP) -> list[tuple[tuple[int, ...], int]]:
    """Whole configurations that hold the demand exactly: the share ``keep`` of the solution,
    rounded down, and what is left over put best-fit, an exact pair first."""
    left = demand.astype(np.int64).copy()
    plan = []
    for config, amount in sorted(found.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        copies = int(keep * amount)
        if copies:
            sizes, counts = np.unique(config, return_counts=True)
            copies = min(copies, int((left[sizes] // counts).min()))
        if copies:
            left[sizes] -= copies * counts
            plan.append((config, copies))
    return plan + _best_fit(left)


def _best_fit(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    capacity = len(left) - 1
    there = np.flatnonzero(left).tolist()
    plan: dict[tuple[int, ...], int] = {}

    def take(size: int) -> int:
        left[size] -= 1
        if not left[size]:
            there.remove(size)
        return size

    while there:
        config = [take(there[-1])]
        room = capacity - config[0]
        while room and there and there[0] <= room:
            if left[room]:
                config.append(take(room))
                break
            pair = None
            if room > 1:
                both = np.flatnonzero((left[1:room] > 0) & (left[room - 1:0:-1] > 0)) + 1
                both = both[(both * 2 != room) | (left[both] > 1)]
                if len(both):
                    pair = int(both[-1])
            if pair:
                config += [take(pair), take(room - pair)]
                break
            config.append(take(there[bisect_right(there, room) - 1]))
            room -= config[-1]
        # many at once while many are left, so the steps grow with the logarithm of the demand
        more = min(int(left[s]) // config.count(s) for s in config) // 8
        for s in config:
            left[s] -= more
        key = tuple(sorted(config, reverse=True))
        plan[key] = plan.get(key, 0) + 1 + more
    return list(plan.items())


@dataclass(frozen=True)
class Placement:
    """For pieces numbered by length: runs of numbers, and where the first of each run goes.
    The next pieces of a run go to the next sequences, at the same offset."""

    begins: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    n_sequences: int
    bound: float


def place(counts: dict[int, int], capacity: int = CAPACITY) -> Placement:
    """The plan for so many pieces of each length."""
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        demand[length] = n
    whole = int(demand[capacity])
    demand[capacity] = 0
    plan, bound = [((capacity,), whole)] if whole else [], 0.0
    if demand.any():
        found, bound = solve(demand)
        plan += rounded(found, demand)
    demand[capacity] = whole
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for config, copies in plan:
        offset = 0
        for size in config:
            runs.setdefault(size, []).append((copies, sequence, offset))
            offset += size
        sequence += copies
    begins, sequences, offsets, number = [], [], [], 0
    for size in sorted(runs):
        for copies, first, offset in runs[size]:
            begins.append(number)
            sequences.append(first)
            offsets.append(offset)
            number += copies
    return Placement(*(np.array(x, np.int64) for x in (begins, sequences, offsets)), sequence,
                     bound + whole)


# -- documents ---------------------------------------------------------------------------------

def tokenised_pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
                     capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids with the end id behind them: ``piece``, ``start``,
    ``length``, ``ids_crc32`` and, if asked, ``ids``.  All but the first have ``capacity`` ids."""
    schema = schema_with(docs, [key], "piece int, start long, length long, ids_crc32 long"
                         + ", ids array<int>" * with_ids)
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        for batch in smaller(batches):
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, body in enumerate(batch.column("_text").to_pylist()):
                whole = encode(body or "") + end
                total = len(whole) // 4
                start, stop = 0, total % capacity or capacity
                piece = 0
                while start < total:
                    part = whole[4 * start:4 * stop]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(stop - start)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = [batch.column(key).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                       *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece: its document's ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``
    (and ``ids``), and its place: ``sequence_id`` and ``offset``.

    The lengths are counted, the plan is made from their histogram (at most ``capacity`` numbers,
    however many documents), and pieces are numbered by length with a range partitioning; the
    number tells the place.  Pieces are written once before that, so a lost task can't renumber
    them.

    A null or empty text is the end id alone.  Repeated rows and equal keys are packed each; a
    null key stays null; no documents give no rows; other columns aren't read.
    """
    pieces = tokenised_pieces(docs, path, text, key, capacity, with_ids)
    pieces = materialise(pieces.withColumn("_copy", F.monotonically_increasing_id()), "pieces")
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(place(counts, capacity))
    light = number_rows(pieces.drop("ids"), ["length", key, "piece", "_copy"], "_number")
    names = [c for c in light.columns if c != "_number" and (with_ids or c != "_copy")]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            number = batch.column("_number").to_numpy(zero_copy_only=False) - 1
            run = np.searchsorted(plan.begins, number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names),
                 pa.array(plan.sequences[run] + number - plan.begins[run]),
                 pa.array(plan.offsets[run])],
                names=[*names, "sequence_id", "offset"])

    placed = light.mapInArrow(put, schema_with(light, names, "sequence_id long, offset long"))
    if with_ids:
        placed = placed.join(pieces.select("_copy", "ids"), "_copy").drop("_copy")
    return placed
