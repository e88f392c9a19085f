"""Benchmark decontamination with suffix arrays over the training documents."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.llm.common import schema_with, smaller, texts_of, unused
from starquill.session import materialise

WINDOW = 10
BLOCK_BYTES = 16 << 20  # of benchmark texts that are broadcast at once
SHARD_WORDS = 1 << 19   # of a suffix array

# A-Z become a-z; letters, digits and everything beyond ASCII stay; the rest separates words
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))

_FOUND = ("n_words long, matches array<struct<item_id:string,item_start:int,doc_start:int,"
          "n_words:int>>, item_ids array<string>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Queries:
    """The distinct windows of a block of items.  ``low`` and ``high`` are the least and the
    greatest packed key of a suffix that begins with the window.  ``chain`` has the windows of
    every item in turn, by number, and ``chain_item`` and ``chain_start`` their places; the items
    are numbered by their ids, and ``names`` are these."""

    vocabulary: dict[bytes, int]
    per_key: int
    low: np.ndarray
    high: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]
    names: list[str]
    chain: np.ndarray
    chain_item: np.ndarray
    chain_body: np.ndarray
    chain_start: np.ndarray


def prepare(items: list[tuple[str, bytes]], window: int = WINDOW) -> Queries:
    """Every suffix of every item that still has a whole window; a shorter item is one window."""
    vocabulary: dict[bytes, int] = {}
    numbers: dict[tuple[int, ...], int] = {}
    names = sorted({name for name, _ in items})
    by_name = {name: i for i, name in enumerate(names)}
    chain: list[tuple[int, int, int, int]] = []
    for body, (name, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for start in range(max(1, len(ids) - window + 1) if ids else 0):
            number = numbers.setdefault(tuple(ids[start:start + window]), len(numbers))
            chain.append((number, by_name[name], body, start))
    windows = sorted(numbers)
    place = np.zeros(len(windows), np.int64)
    for i, w in enumerate(windows):
        place[numbers[w]] = i
    columns = np.array(chain, np.int64).reshape(len(chain), 4).T
    holders: list[set[int]] = [set() for _ in windows]
    for w, item in zip(place[columns[0]].tolist(), columns[1].tolist()):
        holders[w].add(item)
    bits = max(1, (len(vocabulary) + 1).bit_length())
    per_key = max(1, 63 // bits)
    lengths = np.array([len(w) for w in windows], np.int64)
    ids = np.zeros((len(windows), window), np.int64)
    for i, w in enumerate(windows):
        ids[i, :len(w)] = w
    top = np.where(np.arange(window) < lengths[:, None], ids, (1 << bits) - 1)
    return Queries(vocabulary, per_key, _packed(ids, per_key, bits), _packed(top, per_key, bits),
                   lengths, [[names[i] for i in sorted(h)] for h in holders], names,
                   place[columns[0]], columns[1], columns[2], columns[3])


def _packed(ids: np.ndarray, per_key: int, bits: int) -> np.ndarray:
    """Columns of ids joined to columns of integers that compare in the same order."""
    n, width = ids.shape
    columns = []
    for first in range(0, width, per_key):
        key = np.zeros(n, np.int64)
        for j in range(first, first + per_key):
            key = (key << bits) | (ids[:, j] if j < width else 0)
        columns.append(key)
    return np.stack(columns) if columns else np.zeros((0, n), np.int64)


def suffix_array(ids: np.ndarray, shortest: int, window: int, per_key: int,
                 bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the suffixes in order of their first ``window`` words, and the packed words.

    Id 0 ends a suffix: the end of a document, or a word that no item has.  Suffixes with fewer
    than ``shortest`` words before that can't begin with a window and are left out.
    """
    stops = np.flatnonzero(np.r_[ids, 0] == 0)
    left = stops[np.searchsorted(stops, np.arange(len(ids)))] - np.arange(len(ids))
    starts = np.flatnonzero(left >= shortest)
    padded = np.r_[ids, np.zeros(window, ids.dtype)]
    keys = np.zeros((-(-window // per_key), len(starts)), np.int64)
    alive = np.ones(len(starts), bool)
    for j in range(keys.shape[0] * per_key):
        alive &= left[starts] > j
        keys[j // per_key] <<= bits
        if j < window:
            keys[j // per_key] |= np.where(alive, padded[starts + j], 0)
    order = np.lexsort(keys[::-1]) if len(starts) else np.zeros(0, np.int64)
    return starts[order], keys[:, order]


def binary_search(keys: np.ndarray, wanted: np.ndarray, behind: bool) -> np.ndarray:
    """Place of each wanted key among the ordered ``keys``; ``behind`` equal ones if asked."""
    low = np.zeros(wanted.shape[1], np.int64)
    high = np.full(wanted.shape[1], keys.shape[1], np.int64)
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high) // 2, 0)
        less, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
        for column, want in zip(keys, wanted):
            here = column[middle]
            less |= equal & (here < want)
            equal &= here == want
        right = (less | equal) if behind else less
        low = np.where(open_ & right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)
    return low


class Suffixes:
    """Sequences of windows in suffix order to their full length, by prefix doubling: the ranks of
    the first 2^k windows of every suffix, for each k until the order is complete."""

    def __init__(self, windows: np.ndarray, next_: np.ndarray):
        """``next_`` has the place of the window one word on; len(windows) at a sequence's end."""
        n = len(windows)
        ends = np.flatnonzero(next_ == n)
        self.left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1
        distinct, rank = np.unique(windows, return_inverse=True)
        self.ranks, self.jumps = [rank], [np.r_[next_, n]]
        while True:
            behind = np.r_[rank + 1, 0][self.jumps[-1][:-1]]
            finer, rank = np.unique(rank * (n + 2) + behind, return_inverse=True)
            if len(finer) == len(distinct):
                break
            distinct = finer
            self.ranks.append(rank)
            self.jumps.append(self.jumps[-1][self.jumps[-1]])

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many windows two suffixes have in common at their begin."""
        n, most = len(self.left), np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        # a suffix may be many times as long as the last rank compares
        levels = [*range(len(self.ranks))]
        moved = np.ones(len(a), bool)
        while moved.any():
            moved = self._step(a, b, n, levels[-1], length)
            a, b = self._behind(a, b, levels[-1], moved)
        for k in levels[-2::-1]:
            moved = self._step(a, b, n, k, length)
            a, b = self._behind(a, b, k, moved)
        return np.minimum(length, most)

    def _step(self, a: np.ndarray, b: np.ndarray, n: int, k: int, length: np.ndarray) -> np.ndarray:
        rank = np.r_[self.ranks[k], -1]
        same = (a < n) & (b < n) & (rank[a] == rank[b])
        length[same] += 1 << k
        return same

    def _behind(self, a: np.ndarray, b: np.ndarray, k: int, moved: np.ndarray) -> tuple:
        return np.where(moved, self.jumps[k][a], a), np.where(moved, self.jumps[k][b], b)


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``values[low:high]`` for each pair, none of them empty."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half, last = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    level = np.frexp((high - low).astype(float))[1] - 1
    found = np.empty(len(low), values.dtype)
    for k in np.unique(level).tolist():
        at = level == k
        found[at] = np.minimum(table[k][low[at]], table[k][high[at] - (1 << k)])
    return found


def longest(queries: Queries, places: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the places of a shard where a whole window begins: those whose longest match with any
    item doesn't lie inside another's, the number of windows of that match, and the first item
    (by id, then by place) that has it, as a place in ``chain``."""
    part = np.flatnonzero(np.isin(queries.chain, windows))
    m, n = len(part), len(part) + len(places)
    follows = np.r_[(np.diff(part) == 1) & (np.diff(queries.chain_body[part]) == 0), False,
                    np.diff(places) == 1, False]
    suffixes = Suffixes(np.r_[queries.chain[part], windows],
                        np.where(follows, np.arange(1, n + 1), n))
    rank = suffixes.ranks[-1]
    order = np.argsort(rank[:m], kind="stable")
    docs = np.arange(m, n)
    at = np.searchsorted(rank[order], rank[docs])
    length = np.maximum(suffixes.common(order[np.maximum(at - 1, 0)], docs),
                        suffixes.common(order[np.minimum(at, m - 1)], docs))
    ends = places + length
    kept = np.flatnonzero(ends > np.r_[-1, np.maximum.accumulate(ends)[:-1]])
    docs, at, length = docs[kept], at[kept], length[kept]
    # items around the place in the order have it as long as what they share is as long
    edges = []
    for low, high, inside in ((np.zeros_like(at), at.copy(), True), (at.copy(), np.full_like(at, m), False)):
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            shares = suffixes.common(order[middle], docs) >= length
            right = ~shares if inside else shares
            low, high = np.where(open_ & right, middle + 1, low), np.where(open_ & ~right, middle, high)
        edges.append(low)
    first = np.lexsort((queries.chain_start[part], queries.chain_item[part]))
    precedence = np.empty(m, np.int64)
    precedence[first] = np.arange(m)
    return kept, length, part[first[_least(precedence[order], *edges)]]


def ids_of(text: bytes, queries: Queries) -> np.ndarray:
    """Numbers of the words of a text; 0 for a word that no item has."""
    words = words_of(text)
    return np.fromiter(map(queries.vocabulary.get, words, repeat(0)), np.int32, len(words))


def search_shard(docs: list[np.ndarray], queries: Queries, window: int) -> list[tuple[list, list]]:
    """Matches and item ids of each document (numbers of its words) of one shard."""
    bits = max(1, (len(queries.vocabulary) + 1).bit_length())
    result: list[tuple[list, list]] = [([], []) for _ in docs]
    if not len(queries.lengths):
        return result
    begins = np.cumsum([0, *(len(d) + 1 for d in docs[:-1])])
    # a document's end divides it from the next one
    ids = np.concatenate([part for d in docs for part in (d, np.zeros(1, np.int32))])
    starts, keys = suffix_array(ids, int(queries.lengths.min()), window, queries.per_key, bits)
    if not len(starts):
        return result
    low = binary_search(keys, queries.low, False)
    high = binary_search(keys, queries.high, True)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return result
    counts = (high - low)[hit]
    window_at = np.repeat(hit, counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    places = starts[np.repeat(low[hit], counts) + offset]
    doc_at = np.searchsorted(begins, places, "right") - 1
    for d, w in np.unique(np.c_[doc_at, window_at], axis=0).tolist():
        result[d][1].extend(queries.items[w])
    found: list[tuple[np.ndarray, ...]] = []  # place, words, place in chain
    whole = np.flatnonzero(queries.lengths[window_at] == window)
    if len(whole):
        whole = whole[np.argsort(places[whole])]
        kept, length, link = longest(queries, places[whole], window_at[whole])
        found.append((places[whole][kept], length + window - 1, link))
    short = np.flatnonzero(queries.lengths[window_at] < window)
    if len(short):
        # items of fewer words are whole; of equal ones the first
        first = np.lexsort((queries.chain_item, queries.chain))
        links = first[np.searchsorted(queries.chain[first], window_at[short])]
        found.append((places[short], queries.lengths[window_at[short]], links))
    place, length, link = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-length, place))
    place, length, link = place[order], length[order], link[order]
    ends = place + length
    kept = ends > np.r_[-1, np.maximum.accumulate(ends)[:-1]]
    place, length, link = place[kept], length[kept], link[kept]
    doc = np.searchsorted(begins, place, "right") - 1
    for d, p, n, item, start in zip(doc.tolist(), (place - begins[doc]).tolist(), length.tolist(),
                                    queries.chain_item[link].tolist(), queries.chain_start[link].tolist()):
        result[d][0].append({"item_id": queries.names[item], "item_start": start, "doc_start": p,
                             "n_words": n})
    return [(matches, sorted(set(names))) for matches, names in result]


def _search(rows: DataFrame, queries: Queries, window: int, kept: list[str], text: str) -> DataFrame:
    """``kept`` columns with ``n_words``, ``matches`` and ``item_ids`` of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)
    schema = schema_with(rows, kept, _FOUND)
    found_types = [pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int32()),
                                       ("doc_start", pa.int32()), ("n_words", pa.int32())])),
                   pa.list_(pa.string())]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches, 2048):
            counts, matches, names = [], [], []
            shard, size = [], 0
            texts = texts_of(batch.column(text))
            for i, body in enumerate(texts):
                shard.append(ids_of(body, shared.value))
                counts.append(len(shard[-1]))
                size += len(shard[-1])
                if size >= SHARD_WORDS or i + 1 == len(texts):
                    for m, ids in search_shard(shard, shared.value, window):
                        matches.append(m)
                        names.append(ids)
                    shard, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(counts, pa.int64()),
                 pa.array(matches, found_types[0]), pa.array(names, found_types[1])],
                names=[*kept, "n_words", "matches", "item_ids"])

    return rows.select(*dict.fromkeys([*kept, text])).mapInArrow(search, schema)


def find_matches(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``; ``matches``, longest verbatim runs of item words with their
    places; ``item_ids`` with a window in the document; ``n_hit`` words inside matches; and
    ``contaminated``.

    Each Arrow batch of documents is a shard: its suffixes are put in order and every suffix of
    every item is looked up by binary search, by its first window.  Where one is found, the
    suffixes of both sides are ordered to their full length, which gives the longest match of
    every place.  ``matches`` has those that don't lie inside another one, in order; of several
    items with a match it names the first by id, and there the first place.

    Items are broadcast in blocks of at most BLOCK_BYTES (or one longer item); with more than one
    block, the hits of each are written, put together by place, and joined to the documents, with
    the same result as of one block.

    A null text has no words, a null item id counts as the empty text, an item without words is
    nowhere.  Repeated rows are searched each; columns of ``docs`` that have one of the new names
    are replaced; without documents there are no rows, without items no hits.
    """
    new = {"n_words", "matches", "item_ids", "n_hit", "contaminated"}
    docs = docs.drop(*(new - {text}))
    chosen = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
                          F.coalesce(F.col(item_text), F.lit("")).alias("body"))
    size = chosen.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(1.25 * size / BLOCK_BYTES))
    if blocks == 1:
        found = _search(docs, _block(chosen, window), window, docs.columns, text)
    else:
        own, row = docs.columns, unused("row", docs.columns)
        docs = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate")
        number = F.pmod(F.xxhash64("id", "body"), F.lit(blocks))
        hits = None
        for k in range(blocks):
            one = _search(docs, _block(chosen.filter(number == k), window), window, [row], text)
            one = materialise(one.filter(F.size("matches") + F.size("item_ids") > 0), "hits")
            hits = one if hits is None else hits.unionByName(one)
        # a document's matches in one block lie apart in it, so a row has at most its words' share
        joined = hits.groupBy(row).agg(
            F.flatten(F.collect_list("matches")).alias("matches"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
        joined = _outermost(joined, row)
        counted = _search(docs, prepare([], window), window, docs.columns, text)
        found = counted.drop("matches", "item_ids").join(joined, row, "left").select(
            *own, "n_words", "matches", "item_ids")
        for name in ("matches", "item_ids"):
            found = found.withColumn(name, F.coalesce(F.col(name), F.array()))
    return _with_hits(found)


def _outermost(hits: DataFrame, row: str) -> DataFrame:
    """Of the matches of several blocks those that don't lie inside another, as ``longest`` tells."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for matches in batch.column("matches").to_pylist():
                kept, reach = [], 0
                for m in sorted(matches, key=lambda m: (m["doc_start"], -m["n_words"],
                                                        m["item_id"], m["item_start"])):
                    if m["doc_start"] + m["n_words"] > reach:
                        reach = m["doc_start"] + m["n_words"]
                        kept.append(m)
                chosen.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), pa.array(chosen, batch.column("matches").type),
                 batch.column("item_ids")], names=[row, "matches", "item_ids"])

    return hits.select(row, "matches", "item_ids").mapInArrow(choose, hits.schema)


def _block(items: DataFrame, window: int) -> Queries:
    # bounded by BLOCK_BYTES, see find_matches
    return prepare(sorted((r["id"], r["body"].encode()) for r in items.collect()), window)


def _with_hits(found: DataFrame) -> DataFrame:
    """Words inside the union of the matches."""
    step = F.aggregate(
        F.array_sort(F.transform("matches", lambda m: F.struct(
            m["doc_start"].alias("a"), (m["doc_start"] + m["n_words"]).alias("b")))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(s["reach"], m["a"]))).alias("n"),
            F.greatest(s["reach"], m["b"]).alias("reach")))
    return (found.withColumn("n_hit", step["n"].cast("long"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no window of an item occurs, with their own columns."""
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"))
    found = find_matches(whole, items, text="_text", **options)
    return found.filter(~F.col("contaminated")).select("_doc.*")
