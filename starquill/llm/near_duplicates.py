"""Near duplicates: an exact n-gram Jaccard join in size-banded tiles.

Documents with equal shingle sets become one node.  If two sets are similar enough, they share
one of their first shingles in the order of hashes (a prefix of about 1 - threshold of the set),
and their sizes lie in the same or in neighbouring bands.  So a tile holds the nodes of two
neighbouring bands that share a prefix shingle; large tiles are cut into a grid of blocks.
Inside a tile, a hashed bitmap of each set bounds the overlap of every pair from above, in numpy;
pairs that may reach the threshold are verified on the sorted arrays of shingle hashes.

A group of copies is not turned into all its pairs.  The first round takes all pairs of a tile
that may reach the threshold only if they are at most CROWDED per row, and else, for each node, the
most promising partner.  Its bitmaps are short, as every row of every tile has one, and let some
unrelated pairs through.  These meet in more and more tiles as the input grows, so the pairs are
held against bitmaps FINER times as long before any set moves, and the crowded tiles are gone
through again with those.  The last round goes through the tiles that are crowded still, those that
hold more than one component, and takes all pairs whose nodes are not yet connected; its bitmaps are
longer again, because sets just below the threshold are what such tiles are left with.  No link
between components can stay unseen.
That is enough for components only: ``links`` verifies the pairs of all tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.llm.common import (WordHashes, lists_of, mix, runs, schema_with, smaller, texts_of,
                                  whole_groups)
from starquill.llm.components import connected
from starquill.operators.rows import first_per_key
from starquill.session import discard, materialise, shuffles_freed

TILE_ROWS = 1024
CROWDED = 2
LEAST_BITS = 128
FINER = 2
WIDER = 8
DEALT_KEYS = 1 << 20
CHUNK = 2048
PAIR_BLOCK = 1 << 17

_hashes = WordHashes()


def shingles(text: bytes, words: int) -> np.ndarray:
    """Distinct hashes of all runs of ``words`` lower-cased words, ascending; of fewer words, one
    hash of all."""
    found = _hashes.of(text.lower().split())
    return np.unique(runs(found, min(words, len(found)))) if len(found) else runs(found, words)


def needed(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of two sets of these sizes that makes them similar."""
    return -(-percent * (small + large) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def bitmap(hashes: np.ndarray, times: int = 1) -> bytes:
    """A bit per bucket of hashes, the parity of its count.  Sets of one size class have bitmaps
    of equal length, half a bit to one bit per member (or ``times`` as many, a power of two); a
    longer one folds to a shorter.  Bitmaps of unrelated sets differ in about half their bits, a
    quarter of a member or more, where similar sets differ in less."""
    bits = max(LEAST_BITS, (1 << (len(hashes) - 1).bit_length()) * times >> 1)
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1).tobytes()


def _sketched(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A light row per document: set size, digest, prefix and bitmaps."""
    schema = schema_with(docs, ["doc_id", "text_hash"],
                         "n int, digest binary, prefix array<long>, bits binary, fine binary")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            sizes, digests, prefixes, bits, fine = [], [], [], [], []
            for text in texts_of(batch.column("text")):
                found = shingles(text, words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                prefixes.append(found[:prefix_size(len(found), percent)].view(np.int64)
                                if len(found) else found.view(np.int64))
                bits.append(bitmap(found) if len(found) else None)
                fine.append(bitmap(found, FINER) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int32()),
                 pa.array(digests, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                 pa.array(bits, pa.binary()), pa.array(fine, pa.binary())], names=schema.names)

    return docs.mapInArrow(sketch, schema)


def _folded(bitmaps: list[bytes], length: int, size: int) -> np.ndarray:
    """A row of words for each of some bitmaps of ``length`` bytes, folded to ``size`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(b"".join(bitmaps), np.uint64).reshape(
        len(bitmaps), length // size, size // 8), axis=1)


def _apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many bits two bitmaps differ, the longer one folded to the shorter; for each pair."""
    lengths = np.array([[len(x), len(y)] for x, y in zip(left, right)], np.int64).reshape(-1, 2)
    apart = np.zeros(len(lengths), np.int64)
    for x, y in np.unique(lengths, axis=0).tolist():
        where = np.flatnonzero((lengths == (x, y)).all(axis=1))
        one, two = (_folded([side[i] for i in where.tolist()], length, min(x, y))
                    for side, length in ((left, x), (right, y)))
        apart[where] = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
    return apart


def _compare(tile: pa.Table, percent: int, nearest: bool
             ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of row numbers inside tiles whose overlap may be large enough, a block of about
    PAIR_BLOCK at a time.  If ``nearest``, for crowded tiles only each row's closest partner, and
    those tiles' keys: the pairs of a tile are dropped as soon as it is known to be crowded, so
    never more are held than a few per row."""
    key, n, home, block, diagonal, component = (
        tile.column(c).to_numpy() for c in ("tile", "n", "home", "block", "diagonal", "component"))
    n = n.astype(np.int64)
    lengths = tile.column("bits").combine_chunks()
    lengths = np.diff(np.frombuffer(lengths.buffers()[1], np.int32)[
        lengths.offset:lengths.offset + len(lengths) + 1])
    bodies = tile.column("bits").to_pylist()
    maps: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in np.unique(lengths).tolist():  # each row's bitmap folded to this size
        rows = np.flatnonzero(lengths >= size)
        place = np.zeros(len(n), np.int64)
        place[rows] = np.arange(len(rows))
        folded = np.empty((len(rows), size // 8), np.uint64)
        for length in np.unique(lengths[rows]).tolist():
            same = np.flatnonzero(lengths[rows] == length)
            folded[same] = _folded([bodies[r] for r in rows[same].tolist()], length, size)
        maps[size] = place, folded
    ends = np.flatnonzero(np.r_[key[1:] != key[:-1], True])
    end = ends[np.searchsorted(ends, np.arange(len(key)))]
    rows = np.arange(len(key))
    number = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    allowed = CROWDED * np.bincount(number)
    met = np.zeros(len(allowed), np.int64)
    closest, partner = np.full(len(key), np.inf), np.full(len(key), -1)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for step in range(1, int((end - rows).max(initial=0)) + 1):
        i = rows[end - rows >= step]
        j = i + step
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        ok = ((100 * small >= percent * large) & (home[i] | home[j]) & (component[i] != component[j])
              & (diagonal[i] | (block[i] != block[j])))
        i, j, small, large = i[ok], j[ok], small[ok], large[ok]
        size = np.minimum(lengths[i], lengths[j])
        apart = np.zeros(len(i), np.int64)
        for s in np.unique(size).tolist():
            where = np.flatnonzero(size == s)
            place, folded = maps[s]
            apart[where] = np.bitwise_count(
                folded[place[i[where]]] ^ folded[place[j[where]]]).sum(axis=1, dtype=np.int64)
        may = (small + large - apart) // 2 >= needed(small, large, percent)
        i, j = i[may], j[may]
        if nearest:
            differ = apart[may] / (small + large)[may]
            for x, y in ((i, j), (j, i)):  # a row is in x once
                better = (differ < closest[x]) | ((differ == closest[x]) & (y < partner[x]))
                closest[x[better]], partner[x[better]] = differ[better], y[better]
            met += np.bincount(number[i], minlength=len(met))
            calm = met[number[i]] <= allowed[number[i]]
            i, j = i[calm], j[calm]
        held.append((i.astype(np.int32), j.astype(np.int32)))
        waiting += len(i)
        if waiting >= PAIR_BLOCK:
            left, right = map(np.concatenate, zip(*held))
            if nearest:
                calm = met[number[left]] <= allowed[number[left]]
                held, waiting = [(left[calm], right[calm])], 0
            else:
                held, waiting = [], 0
                yield left, right, key[:0]
    left, right = map(np.concatenate, zip(*held)) if held else (rows[:0], rows[:0])
    if not nearest:
        yield left, right, key[:0]
        return
    calm = met[number[left]] <= allowed[number[left]]
    crowded = (met > allowed)[number]
    busy = np.flatnonzero(crowded & (partner >= 0))
    yield np.r_[left[calm], busy], np.r_[right[calm], partner[busy]], np.unique(key[crowded])


def _distinct(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers, the smaller first, each once."""
    x, y = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])][:len(x)]
    return x[new], y[new]


def _some(values: np.ndarray, before: int, after: int, kind: pa.DataType) -> pa.Array:
    """An Arrow column of ``values`` with nulls before and after them."""
    mask = np.r_[np.ones(before, bool), np.zeros(len(values), bool), np.ones(after, bool)]
    whole = np.r_[np.zeros(before, values.dtype), values, np.zeros(after, values.dtype)]
    return pa.array(whole, kind, mask=mask)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then their next bytes and so on: equal bytes stand
    together, so they compress."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _numbers(planes: list[bytes], kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.concatenate([np.empty(0, kind), *(
        np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(width, -1).T).view(kind).ravel()
        for p in planes)])


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return starts, np.diff(np.r_[starts, len(key)])


_DEALT = "bucket long, keys binary, nodes binary, sizes binary, weights binary"


def _deal(nodes: list[pa.RecordBatch], buckets: int) -> pa.RecordBatch:
    """The prefix shingles of some nodes, a row per bucket of keys.  A key that more than two of
    them share is sent once, with a weight that says so; its entries, already known to be
    shared, go in rows of their own with a bucket below 0."""
    table = pa.Table.from_batches(nodes)
    keys, at = lists_of(table.column("prefix").combine_chunks())
    key = mix(keys.view(np.uint64))  # a prefix holds small hashes; these are spread evenly
    row = np.repeat(np.arange(len(table)), np.diff(at))
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    node, n = table.column("node").to_numpy()[row], table.column("n").to_numpy()[row]
    starts, lengths = _groups(key)
    count = np.repeat(lengths, lengths)
    first = np.zeros(len(key), bool)
    first[starts] = True
    rows = []

    def pack(bucket: int, part: np.ndarray) -> None:
        rows.append((bucket, _planes(key[part]), _planes(node[part]), _planes(n[part]),
                     np.where(count[part] > 2, 3, 1).astype(np.uint8).tobytes()))

    sent = np.flatnonzero((count <= 2) | first)
    bucket = ((key[sent] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    for start, length in zip(*_groups(bucket)):
        pack(int(bucket[start]), sent[start:start + length])
    known = np.flatnonzero(count > 2)
    for start in range(0, len(known), CHUNK):
        part = known[start:start + CHUNK]
        pack(-1 - int(key[part[0]] >> np.uint64(32)), part)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(
            zip(*rows) if rows else [[]] * 5, [pa.int64(), *[pa.binary()] * 4])],
        names=["bucket", "keys", "nodes", "sizes", "weights"])


def _shared(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """What whole buckets share: an entry ``key``, ``node``, ``n`` per set for a key of more than
    two sets, and ``node``, ``partner`` for two sets that may be similar and alone share a key."""
    key, node, n, weight = (_numbers(rows.column(c).to_pylist(), kind) for c, kind in (
        ("keys", np.uint64), ("nodes", np.int64), ("sizes", np.int32), ("weights", np.uint8)))
    known = np.repeat(rows.column("bucket").to_numpy() < 0,
                      [len(w) for w in rows.column("weights").to_pylist()])
    counted = np.flatnonzero(~known)
    counted = counted[np.argsort(key[counted], kind="stable")]
    starts, lengths = _groups(key[counted])
    total = np.add.reduceat(weight[counted].astype(np.int64), starts) if len(starts) else lengths
    more = np.r_[np.flatnonzero(known),
                 counted[(np.repeat(total, lengths) > 2) & (weight[counted] == 1)]]
    i = starts[total == 2]
    i, j = counted[i], counted[i + 1]
    near = (100 * np.minimum(n[i], n[j]).astype(np.int64)
            >= percent * np.maximum(n[i], n[j]).astype(np.int64))
    x, y = _distinct(node[i[near]], node[j[near]])
    return pa.RecordBatch.from_arrays(
        [_some(key[more].view(np.int64), 0, len(x), pa.int64()),
         pa.array(np.r_[node[more], x], pa.int64()),
         _some(n[more], 0, len(x), pa.int32()), _some(y, len(more), 0, pa.int64())],
        names=["key", "node", "n", "partner"])


def _shared_prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """The prefix shingles that more than one node has, as ``_shared`` gives them.

    One shuffle: each task sends, for many nodes together, one row per bucket of keys, with the
    numbers side by side, sorted and compressible.  Of a key, however many nodes share it, a
    bucket gets two entries at most from about DEALT_KEYS."""
    spark = nodes.sparkSession
    # some to a partition, so that partitions are of about equal size
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys = [], 0
        for batch in batches:
            held.append(batch)
            keys += len(batch.column("prefix").flatten())
            if keys >= DEALT_KEYS:
                yield _deal(held, buckets)
                held, keys = [], 0
        if keys:
            yield _deal(held, buckets)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "bucket"):
            yield _shared(rows, percent)

    return (nodes.select("node", "n", "prefix").mapInArrow(deal, _DEALT)
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(gather, "key long, node long, n int, partner long"))


def _tiles(entries: DataFrame, percent: int) -> DataFrame:
    """Light rows of all tiles.  Shingles that only two sets share make one tile for all that
    these two share; the others a tile for every two neighbouring size bands: rows of the upper
    band are at ``home``, rows of the lower are compared with them.  A tile of more than about
    TILE_ROWS rows is a grid: a row goes with its block to the meeting with each block."""
    pairs = (entries.filter("partner IS NOT NULL")
             .select(F.col("node").alias("a"), F.col("partner").alias("b")).distinct())
    pairs = pairs.select(
        F.xxhash64("a", "b").alias("tile"), F.explode(F.array("a", "b")).alias("node"),
        F.lit(True).alias("home"), F.lit(0).alias("block"), F.lit(True).alias("diagonal"))
    # a little wider than the ratio, so that rounding can't part two linked sizes by two bands
    width = max(math.log(100 / percent), 0.01) * 1.000001
    band = F.floor(F.log("n") / F.lit(width)).cast("int")
    more = (entries.filter("partner IS NULL").select("key", "node", band.alias("band"))
            .withColumn("tile_band", F.explode(F.array("band", F.col("band") + 1)))
            .withColumn("home", F.col("tile_band") == F.col("band")))
    counts = more.groupBy("key", "tile_band").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("at_home"))
    more = more.join(counts.filter("rows > 1 AND at_home > 0"), ["key", "tile_band"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    more = more.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.unionByName(more.select(
        F.xxhash64("key", "tile_band", F.least("block", "other"),
                   F.greatest("block", "other")).alias("tile"),
        "node", "home", "block", (F.col("block") == F.col("other")).alias("diagonal")))


def _candidates(tiles: DataFrame, bitmaps: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct pairs ``a`` < ``b`` of nodes of different components that may be similar.  A row
    without ``b`` names in ``a`` a crowded tile, of which only the closest pairs are there."""
    rows = tiles.join(bitmaps, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in whole_groups(batches, "tile"):
            node = tile.column("node").to_numpy()
            for left, right, crowded in _compare(tile, percent, nearest):
                x, y = _distinct(node[left], node[right])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[x, crowded], pa.int64()),
                     _some(y, 0, len(crowded), pa.int64())], names=["a", "b"])

    return (rows.repartition("tile").sortWithinPartitions("tile", "n", "node")
            .mapInArrow(compare, "a long, b long").distinct())


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that may be similar by their longer bitmaps, too."""
    both = pairs
    for side in ("a", "b"):
        both = both.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                      F.col("fine").alias(f"of_{side}")), side)

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            apart = _apart(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist())
            may = (x + y - apart) // 2 >= needed(np.minimum(x, y), np.maximum(x, y), percent)
            yield batch.select(["a", "b"]).filter(pa.array(may))

    return both.select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(hold, "a long, b long")


def _wide_bitmaps(sets: DataFrame) -> DataFrame:
    """Bitmaps long enough to tell sets just below the threshold from those above it."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = lists_of(batch.column("hashes"))
            values = values.view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(np.diff(at), pa.int32()),
                 pa.array([bitmap(values[i:j], WIDER) for i, j in zip(at[:-1], at[1:])],
                          pa.binary())], names=["node", "n", "bits"])

    return sets.mapInArrow(draw, "node long, n int, bits binary")


def _open_tiles(tiles: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the tiles that hold nodes of more than one component."""
    several = (tiles.join(labels, "node", "left")
               .withColumn("component", F.coalesce("component", "node")).groupBy("tile")
               .agg(F.min("component").alias("least"), F.max("component").alias("last"))
               .filter("least < last").select("tile"))
    return tiles.join(several, "tile", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar, by intersecting their sorted hashes."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b")), "b"))

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, at), (y, bt) = lists_of(batch.column("of_a")), lists_of(batch.column("of_b"))
            x, y = x.view(np.uint64), y.view(np.uint64)
            good = []
            for i in range(batch.num_rows):
                one, two = x[at[i]:at[i + 1]], y[bt[i]:bt[i + 1]]
                if len(one) > len(two):
                    one, two = two, one
                where = np.minimum(np.searchsorted(two, one), len(two) - 1)
                overlap = int((two[where] == one).sum())
                good.append(100 * overlap >= percent * (len(one) + len(two) - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(intersect, "a long, b long")


def _document_key(doc_id: Column, text_hash: Column) -> list[Column]:
    return [F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull()).alias("_ka"),
            text_hash.alias("_kb")]


def _prepared(docs: DataFrame, words: int,
              percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents with a hash of their text, their light rows, the nodes and the prefix shingles
    that nodes share.  The prefixes themselves are not kept."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1 to 100")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sketches = materialise(_sketched(docs, words, percent), "sketches")
    light = materialise(sketches.select("doc_id", "n", "digest"), "light")
    firsts = first_per_key(sketches.filter("n > 0"), ["digest"],
                           [F.col("doc_id").asc_nulls_last(), F.col("text_hash")])
    firsts = materialise(firsts.withColumn("node", F.monotonically_increasing_id()), "firsts")
    discard(sketches)
    nodes = materialise(firsts.drop("prefix"), "nodes")
    entries = materialise(_shared_prefixes(firsts, percent), "shared-prefixes")
    discard(firsts)
    return docs, light, nodes, entries


def _sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The sorted hashes of every node that is in one of the pairs."""
    members = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    wanted = materialise(nodes.select("node", *_document_key(F.col("doc_id"), F.col("text_hash")))
                         .join(members, "node"), "wanted")
    bodies = docs.select("text", *_document_key(F.col("doc_id"), F.col("text_hash")))

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            sets = [shingles(t, words).view(np.int64) for t in texts_of(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    # the wanted nodes grow with the input: moved by their keys at every size.  A node has one key,
    # so its rows are together
    sets = (bodies.join(wanted.hint("merge"), ["_ka", "_kb"]).dropDuplicates(["_ka", "_kb", "node"])
            .select("node", "text").mapInArrow(hash_all, "node long, hashes array<long>"))
    return materialise(sets, "sets")


def _analysed(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Light rows of all documents, and for every node its ``component_id``, with the id and
    text hash of the document that stands for its whole component."""
    with shuffles_freed(docs.sparkSession):
        docs, light, nodes, entries = _prepared(docs, words, percent)
        tiles = _tiles(entries, percent)
        bitmaps = nodes.select("node", "n", "bits", F.col("node").alias("component"))
        found = materialise(_candidates(tiles, bitmaps, percent, True), "first-pairs")
        pairs = materialise(_likely(found.filter("b IS NOT NULL"), nodes, percent), "likely-pairs")
        crowded = found.filter("b IS NULL").select(F.col("a").alias("tile"))
        busy = not crowded.isEmpty()
        if busy:
            bitmaps = nodes.select("node", "n", F.col("fine").alias("bits"),
                                   F.col("node").alias("component"))
            tiles = tiles.join(crowded, "tile", "left_semi")
            closer = materialise(_candidates(tiles, bitmaps, percent, True), "closer-pairs")
            pairs = pairs.unionByName(closer.filter("b IS NOT NULL")).distinct()
            crowded = closer.filter("b IS NULL").select(F.col("a").alias("tile"))
            busy = not crowded.isEmpty()
        # every node with a candidate in a crowded tile is in one of these pairs, so the sets serve
        # the last round, too
        sets = _sets(docs, nodes, pairs, words)
        links = materialise(_verified(pairs, sets, percent), "links")
        labels = materialise(connected(links), "components")
        if busy:
            bitmaps = _wide_bitmaps(sets).join(labels, "node", "left").withColumn(
                "component", F.coalesce("component", "node"))
            open_tiles = _open_tiles(tiles.join(crowded, "tile", "left_semi"), labels)
            again = _candidates(open_tiles, bitmaps, percent, False)
            more = materialise(_verified(again, sets, percent), "more-links")
            labels = materialise(connected(links.unionByName(more)), "components")
        named = nodes.select("node", "digest", "doc_id", "text_hash").join(labels, "node", "left")
        named = materialise(named.withColumn("component", F.coalesce("component", "node")), "named")
        for dead in (nodes, entries, sets):
            discard(dead)
    # one row per component: the least id, and the text hash that goes with it
    heads = first_per_key(named, ["component"], [F.col("doc_id").asc_nulls_last(), "text_hash"])
    heads = heads.select("component", F.col("doc_id").alias("component_id"),
                         F.col("text_hash").alias("head_hash"))
    return light, named.select("digest", "component").join(heads, "component")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs`` (columns
    ``doc_id`` and ``text``; others are not read).

    Words are what lies between ASCII white space, A-Z lower-cased; a document's set holds its
    distinct runs of ``words`` words, or the whole sequence if it has fewer.  Two documents link
    if 100 * intersection >= ``percent`` * union; ``component_id`` is the least ``doc_id``
    reachable by links.  Sets are compared by 64-bit hashes of their members.

    A null, empty or blank text has no shingles and links with nothing.  Repeated rows and equal
    texts share a component.  A null id is never the least, unless a component has no other.
    Without documents there are no rows.
    """
    light, nodes = _analysed(docs, words, percent)
    filled = light.filter("n > 0").join(nodes, "digest").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
    empty = light.filter("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return filled.unionByName(empty)


def links(docs: DataFrame, words: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links of ``near_duplicates``: pairs of different sets, and what set each row has.

    The first table has a row per link of two different sets: ``set_id`` < ``other_set``, and
    ``doc_id`` and ``other_id``, the least ids that have them.  The second has a row per row of
    ``docs``: ``doc_id``, ``n_shingles``, ``set_id`` and ``n_links``, its links with all other rows.
    Rows of equal sets link with each other, and with all rows of the sets theirs is linked to, so
    the two tables are all links; half the sum of ``n_links`` is their number.  Rows without
    shingles have a null set and no links.  Numbers of sets hold for one call.

    The pairs of every tile are verified, also within a component, so the work grows with the
    number of links between different sets: the square of a group of near copies.
    """
    docs, light, nodes, entries = _prepared(docs, words, percent)
    bitmaps = nodes.select("node", "n", "bits", F.col("node").alias("component"))
    pairs = materialise(_candidates(_tiles(entries, percent), bitmaps, percent, False), "all-pairs")
    found = materialise(_verified(pairs, _sets(docs, nodes, pairs, words), percent), "all-links")
    sizes = light.filter("n > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("size"))
    sets = materialise(nodes.select("digest", "node", "doc_id").join(sizes, "digest"), "set-sizes")
    degrees = (found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .join(sets.select(F.col("node").alias("b"), "size"), "b")
               .groupBy(F.col("a").alias("node")).agg(F.sum("size").alias("degree")))
    linked = materialise(sets.join(degrees, "node", "left").select(
        "digest", F.col("node").alias("set_id"),
        (F.col("size") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links")), "set-links")
    filled = light.filter("n > 0").join(linked, "digest").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "set_id", "n_links")
    empty = light.filter("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("set_id"),
        F.lit(0).cast("long").alias("n_links"))
    told = found.select(F.col("a").alias("set_id"), F.col("b").alias("other_set"))
    told = told.join(sets.select(F.col("node").alias("set_id"), "doc_id"), "set_id").join(
        sets.select(F.col("node").alias("other_set"), F.col("doc_id").alias("other_id")), "other_set")
    return (told.select("set_id", "other_set", "doc_id", "other_id"), filled.unionByName(empty))


def distinct_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: the one with the least
    id (null last, then by a hash of the text).  Rows without words all stay."""
    _, nodes = _analysed(docs, words, percent)
    heads = nodes.select("component", "component_id", "head_hash").distinct().select(
        *_document_key(F.col("component_id"), F.col("head_hash")))
    keyed = docs.withColumns(dict(zip(("_ka", "_kb"), _document_key(
        F.col("doc_id"), F.xxhash64("text")))))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = first_per_key(keyed.filter(has_words).join(heads, ["_ka", "_kb"], "left_semi"),
                         ["_ka", "_kb"], [F.lit(1)])
    return kept.unionByName(keyed.filter(~has_words)).select(*docs.columns)
