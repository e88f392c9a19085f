"""Collocations from a weighted de Bruijn graph of words.

Texts are split into pieces.  The edges of the graph are the word sequences of ``LONGEST`` words
in a piece, weighted with how often they occur; an edge leads from the node of its first words to
the node of its last, one word on.  Only the edges are counted.  How often a shorter sequence
occurs follows: what flows out of all that begins with it, plus the pieces that end with it.

An edge that takes all the flow of the node behind it and of the node ahead continues an unbranched
path; such paths are compacted to passages, found by pointer doubling.  What lies inside a passage
and has its weight occurs nowhere else.

Most links of two words are rare and cannot be in a phrase that occurs ``least`` times, so the
pieces are first cut at rare links, and what is left where three words are a rare sequence.  No
list of sequences is in one place: documents are read in blocks, a block asks buckets of the
sequences' hashes, and each bucket answers every block with a bit per sequence.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starquill.llm.common import mix, runs, whole_groups
from starquill.llm.scoring import squeeze, unsqueeze
from starquill.session import materialise

LONGEST = 5
LEAST = 100
BLOCK_BYTES = 2 << 20
BUCKET_KEYS = 1 << 19
# Sequences whose keys agree are counted as one, so some rare ones are not cut; which of those
# occur often enough is then counted by their words.
KEY_BITS = 48
SALTS = 32                # a language's phrases are dealt to so many tasks
PASSAGE_EDGES = 1 << 10   # longer passages go on in a further part
UNKNOWN = "und"

# letters in lower case; the signs that end a piece as one sign, a tab as a space
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
                        b"abcdefghijklmnopqrstuvwxyz.......... ")

TOTAL, WORD = 0, 1  # widths of counted rows that are no sequences: all words, a single word


class Words(NamedTuple):
    """The words of a block in one language: distinct ones, and each word's index among them,
    with -1 at the end of a piece."""

    lang: str
    vocabulary: list[bytes]
    index: np.ndarray


def words_of(lang: str, texts: list[bytes]) -> Words:
    tokens = b".".join(t.translate(_FOLD) for t in texts).replace(b".", b" . ").split()
    places = dict.fromkeys(tokens)
    places.pop(b".", None)
    vocabulary = list(places)
    places = {w: i for i, w in enumerate(vocabulary)}
    places[b"."] = -1
    index = np.fromiter(map(places.__getitem__, tokens), np.int32, len(tokens))
    return Words(lang, vocabulary, index)


def slices(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size``, each with whole pieces."""
    at = 0
    folded = text if len(text) <= size else text.translate(_FOLD)
    while len(text) - at > size:
        end = folded.find(b".", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


class Keys(NamedTuple):
    """What a block asks for: hashed keys of its sequences of some width (and of its words) in
    order, their counts, and the position in them of the sequence that begins at every place
    (-1: none) and of every word."""

    keys: np.ndarray
    counts: np.ndarray
    places: list[np.ndarray]
    words: list[np.ndarray]


def _whole(index: np.ndarray, width: int) -> np.ndarray:
    """Whether ``width`` words of one piece begin at a place."""
    inside = index >= 0
    ahead = np.r_[inside, np.zeros(width - 1, bool)]
    return reduce(np.logical_and, (ahead[i:i + len(index)] for i in range(width)))


def keys_of(groups: list[Words], width: int, words: bool) -> Keys:
    keys, counts, begins = [], [], []
    for lang, vocabulary, index in groups:
        salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        hashes = mix(np.fromiter(map(xxhash.xxh64_intdigest, vocabulary), np.uint64,
                                 len(vocabulary)) + salt)
        begin = np.flatnonzero(_whole(index, width))
        found = runs(hashes[index], width)[begin] if len(begin) else np.empty(0, np.uint64)
        distinct, which = np.unique(found, return_inverse=True)
        begins.append((begin, which, len(index)))
        keys += [distinct, hashes if words else hashes[:0]]
        counts += [np.bincount(which, minlength=len(distinct)),
                   np.bincount(index[index >= 0], minlength=len(vocabulary))[:len(keys[-1])]]
    whole = np.concatenate([np.empty(0, np.uint64), *keys]) >> np.uint64(64 - KEY_BITS)
    order = np.argsort(whole)
    rank = np.empty(len(whole), np.int64)
    rank[order] = np.arange(len(whole))
    own = np.split(rank, np.cumsum([len(k) for k in keys])[:-1]) if keys else []
    places = []
    for (begin, which, size), ranks in zip(begins, own[0::2]):
        places.append(np.full(size, -1, np.int64))
        places[-1][begin] = ranks[which]
    return Keys(whole[order], np.concatenate([np.empty(0, np.int64), *counts])[order], places,
                own[1::2])


def cut(index: np.ndarray, joined: np.ndarray, width: int) -> list[np.ndarray]:
    """The runs of words that are left if pieces are cut wherever the sequence of ``width`` words
    that begins at a place is not ``joined``.  Each sequence of one word less is in one run;
    single words are left out."""
    inside = _whole(index, width - 1)
    starts = np.flatnonzero(inside & ~np.r_[False, joined[:-1]])
    ends = np.flatnonzero(inside & ~joined) + width - 1
    return [index[a:b] for a, b in zip(starts.tolist(), ends.tolist()) if b - a > 1]


def edges_of(vocabulary: list[bytes], runs_left: list[np.ndarray]) -> Counter:
    """The edges in runs of words, and the shorter ends of these runs (of two words at least), as
    (width, text), with how often they occur."""
    found: Counter = Counter()
    for run in runs_left:
        words = [vocabulary[i] for i in run.tolist()]
        size = len(words)
        found.update((min(LONGEST, size - i), b" ".join(words[i:i + LONGEST]))
                     for i in range(size - 1))
    return found


def reduced(group: Words, runs_left: list[np.ndarray]) -> Words:
    """The group with the given runs as its pieces."""
    end = np.array([-1], np.int32)
    index = np.concatenate([x for run in runs_left for x in (run, end)] or [end])
    used = np.unique(index[index >= 0])
    again = np.append(np.searchsorted(used, index), -1).astype(np.int32)[:len(index)]
    again[index < 0] = -1
    return Words(group.lang, [group.vocabulary[i] for i in used.tolist()], again)


def _packed(groups: list[Words]) -> bytes:
    """A block as bytes: per language its name, its words, and the indices."""
    parts = []
    for lang, vocabulary, index in groups:
        for part in (lang.encode(), b" ".join(vocabulary), index.tobytes()):
            parts += [len(part).to_bytes(8, "little"), part]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes) -> list[Words]:
    data = zstandard.ZstdDecompressor().decompress(data)
    parts, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 8], "little")
        parts.append(data[at + 8:at + 8 + size])
        at += 8 + size
    return [Words(lang.decode(), words.split(b" ") if words else [],
                  np.frombuffer(index, np.int32))
            for lang, words, index in zip(parts[0::3], parts[1::3], parts[2::3])]


BLOCK = "block long, n_keys long, body binary, keys binary, counts binary"
COUNT = "lang string, width int, phrase string, n long"
_BLOCK_SHAPE = pa.schema([("block", pa.int64()), ("n_keys", pa.int64()), ("body", pa.binary()),
                          ("keys", pa.binary()), ("counts", pa.binary())])
_COUNT_SHAPE = pa.schema([("lang", pa.string()), ("width", pa.int32()), ("phrase", pa.string()),
                          ("n", pa.int64())])


def _asking(block: int, groups: list[Words], width: int, words: bool) -> dict:
    asked = keys_of(groups, width, words)
    return {"block": block, "n_keys": len(asked.keys), "body": _packed(groups),
            "keys": squeeze(np.diff(asked.keys, prepend=np.uint64(0))),
            "counts": squeeze(asked.counts.astype(np.uint32))}


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of about BLOCK_BYTES of text, with the keys and counts of their words and links of two
    words."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        texts: dict[str, list[bytes]] = {}

        def row() -> pa.RecordBatch:
            groups = [words_of(lang, own) for lang, own in texts.items()]
            return pa.RecordBatch.from_pylist([_asking(block, groups, 2, True)], _BLOCK_SHAPE)

        for batch in batches:
            langs, column = batch.column("lang"), batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                lang = langs[i].as_py()
                for part in slices(column[i].as_py() or b""):
                    texts.setdefault(UNKNOWN if lang is None else lang, []).append(part)
                    size += len(part) + 1
                    if size >= BLOCK_BYTES:
                        yield row()
                        block, size = block + 1, 0
                        texts.clear()
        if texts:
            yield row()

    return docs.mapInArrow(gather, BLOCK)


def _buckets(blocks: DataFrame) -> int:
    n_keys = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0]
    return max(1, -(-n_keys // BUCKET_KEYS))


def _answered(blocks: DataFrame, least: int) -> DataFrame:
    """Every block's body with the answers of all buckets: a bit for each of its keys, in order,
    that tells whether it occurs ``least`` times in all blocks."""
    buckets = _buckets(blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.cumsum(unsqueeze(batch.column("keys")[i].as_py(), np.uint64),
                                 dtype=np.uint64)
                counts = unsqueeze(batch.column("counts")[i].as_py(), np.uint32)
                place = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets) >> np.uint64(32)
                found, first = np.unique(place, return_index=True)
                parts = list(zip(first.tolist(), [*first[1:].tolist(), len(keys)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int64)),
                     pa.array([batch.column("block")[i].as_py()] * len(parts), pa.int64()),
                     pa.array([squeeze(np.diff(keys[a:b], prepend=np.uint64(0)))
                               for a, b in parts], pa.binary()),
                     pa.array([squeeze(counts[a:b]) for a, b in parts], pa.binary())],
                    names=["bucket", "block", "keys", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            owners, every = group.column("block").to_numpy(), group.column("bucket").to_numpy()
            for bucket in np.unique(every).tolist():
                at = np.flatnonzero(every == bucket)
                keys = [np.cumsum(unsqueeze(group.column("keys")[i].as_py(), np.uint64),
                                  dtype=np.uint64) for i in at.tolist()]
                counts = [unsqueeze(group.column("counts")[i].as_py(), np.uint32)
                          for i in at.tolist()]
                distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(index, np.concatenate(counts), len(distinct))
                heavy = (total >= least)[index]
                ends = np.cumsum([len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners[at], pa.int64()), pa.array([bucket] * len(at), pa.int64()),
                     pa.array(np.diff(ends, prepend=0), pa.int64()),
                     pa.array([np.packbits(h).tobytes() for h in np.split(heavy, ends[:-1])],
                              pa.binary())],
                    names=["block", "bucket", "n_keys", "bits"])

    asked = blocks.select("block", "keys", "counts").mapInArrow(
        ask, "bucket long, block long, keys binary, counts binary")
    answers = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        answer, "block long, bucket long, n_keys long, bits binary")
    answers = answers.groupBy("block").agg(F.sort_array(F.collect_list(
        F.struct("bucket", "n_keys", "bits"))).alias("answers"))
    return blocks.select("block", "body").join(answers, "block", "left")


def _opened(batches: Iterator[pa.RecordBatch], width: int, words: bool) -> Iterator[tuple]:
    """Block, group, its keys, the answers to all keys of the block, and the group's runs."""
    for batch in batches:
        for i in range(batch.num_rows):
            groups = _unpacked(batch.column("body")[i].as_py())
            bits = [np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n_keys"])
                    for a in batch.column("answers")[i].as_py() or ()]
            heavy = np.concatenate([np.empty(0, np.uint8), *bits]).astype(bool)
            asked = keys_of(groups, width, words)
            rows = []
            for j, group in enumerate(groups):
                joined = asked.places[j] >= 0
                joined[joined] = heavy[asked.places[j][joined]]
                rows.append((group, cut(group.index, joined, width), asked.words[j]))
            yield batch.column("block")[i].as_py(), rows, asked.counts, heavy


def _cut_at_links(answered: DataFrame) -> DataFrame:
    """Blocks with the runs that heavy links join, asking for sequences of three words; and, as
    rows without a block, counts: all words per language (TOTAL), and frequent words (WORD)."""

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.unify_schemas([_BLOCK_SHAPE, _COUNT_SHAPE])
        for block, rows, counts, heavy in _opened(batches, 2, True):
            groups, told = [], []
            for group, runs_left, words in rows:
                if runs_left:
                    groups.append(reduced(group, runs_left))
                n_words = int(np.count_nonzero(group.index >= 0))
                if n_words:
                    told.append((group.lang, TOTAL, b"", n_words))
                told += [(group.lang, WORD, group.vocabulary[j], int(counts[words[j]]))
                         for j in np.flatnonzero(heavy[words]).tolist()]
            langs, widths, phrases, n = zip(*told) if told else ((), (), (), ())
            size = len(told)
            body = _asking(block, groups, 3, False)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([body[f.name], *[None] * size], f.type) for f in _BLOCK_SHAPE),
                 pa.array([None, *langs], pa.string()), pa.array([None, *widths], pa.int32()),
                 pa.array([None, *phrases], pa.binary()).cast(pa.string()),
                 pa.array([None, *n], pa.int64())], schema=shape)

    return answered.mapInArrow(shorten, f"{BLOCK}, {COUNT}")


def _counted(answered: DataFrame, buckets: int) -> DataFrame:
    """Counts of the edges and ends of runs that heavy sequences of three words join.

    A block sends its own counts to buckets of the texts' hashes, as one compressed list for each;
    a bucket adds up by text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, _, _ in _opened(batches, 3, False):
            for group, runs_left, _ in rows:
                found = edges_of(group.vocabulary, runs_left)
                parts: dict[int, list[tuple[bytes, int]]] = {}
                for (width, text), n in found.items():
                    parts.setdefault(xxhash.xxh64_intdigest(text) % buckets, []).append(
                        (b"%d %b" % (width, text), n))
                if not parts:
                    continue
                bodies, counts = [], []
                for part in parts.values():
                    texts, n = zip(*sorted(part))
                    bodies.append(zstandard.ZstdCompressor(level=1).compress(b"\t".join(texts)))
                    counts.append(squeeze(np.array(n, np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(parts), pa.int64()), pa.array([group.lang] * len(parts)),
                     pa.array(bodies, pa.binary()), pa.array(counts, pa.binary())],
                    names=["bucket", "lang", "texts", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            sums: dict[str, Counter] = {}
            for i in range(group.num_rows):
                texts = zstandard.ZstdDecompressor().decompress(group.column("texts")[i].as_py())
                n = unsqueeze(group.column("counts")[i].as_py(), np.uint32).tolist()
                own = sums.setdefault(group.column("lang")[i].as_py(), Counter())
                for text, k in zip(texts.split(b"\t"), n):
                    own[text] += k
            for lang, own in sums.items():
                widths, phrases = zip(*(t.split(b" ", 1) for t in own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()),
                     pa.array([int(w) for w in widths], pa.int32()),
                     pa.array(phrases, pa.binary()).cast(pa.string()),
                     pa.array(own.values(), pa.int64())], schema=_COUNT_SHAPE)

    asked = answered.mapInArrow(count, "bucket long, lang string, texts binary, counts binary")
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, COUNT)


class Graph(NamedTuple):
    """``totals``: words per language; ``words``: frequent words; ``phrases``: sequences of 2 to
    LONGEST words that occur often enough, with ``width`` and ``a``; those of LONGEST words are
    the heavy edges."""

    totals: DataFrame
    words: DataFrame
    phrases: DataFrame


def _first(width: int) -> Column:
    return F.substring_index("phrase", " ", width)


def _last(width: int) -> Column:
    return F.substring_index("phrase", " ", -width)


def build_graph(docs: DataFrame, least: int = LEAST) -> Graph:
    """Count the edges and what follows from them.  Rows are written while this is called."""
    if least < 1:
        raise ValueError("least must be above 0")
    blocks = materialise(_blocks(docs.select("lang", "text")), "phrase-blocks")
    shortened = materialise(_cut_at_links(_answered(blocks, least)), "phrase-runs")
    left = shortened.filter("block IS NOT NULL").select(*blocks.columns)
    edges = _counted(_answered(left, least), _buckets(left))
    words = (shortened.filter("block IS NULL").select("lang", "width", "phrase", "n")
             .groupBy("lang", "width", "phrase").agg(F.sum("n").alias("n")))
    counted = materialise(edges.unionByName(words), "phrase-edges")

    def of_width(width: int) -> DataFrame:
        return counted.filter(F.col("width") == width).select("lang", "phrase", "n")

    flow = of_width(LONGEST)
    levels = [(LONGEST, flow)]
    for width in range(LONGEST - 1, 1, -1):
        flow = materialise(
            flow.select("lang", _first(width).alias("phrase"), "n").unionByName(of_width(width))
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrase-flow")
        levels.append((width, flow))
    frequent = [f.filter(F.col("n") >= least).select(
        "lang", F.lit(w).alias("width"), "phrase", F.col("n").alias("a")) for w, f in levels]
    phrases = materialise(reduce(DataFrame.unionByName, frequent), "phrases")
    return Graph(of_width(TOTAL).select("lang", "n"), of_width(WORD), phrases)


def _of_width(phrases: DataFrame, width: int) -> DataFrame:
    return phrases.filter(F.col("width") == width)


def compact(phrases: DataFrame) -> DataFrame:
    """The unbranched paths of heavy edges: ``lang``, ``passage`` (a number by the path's last
    edge), ``part_no``, ``text`` and ``n``, the weight that all its edges have.

    An edge goes on to the one that takes all the flow of its end, if it brings all of it.  The
    end of a path is found by pointer doubling, in as many rounds as the longest path's
    length has binary digits.  A path of more than PASSAGE_EDGES edges comes in parts, which
    overlap by LONGEST - 1 words.
    """
    node = LONGEST - 1
    edges = _of_width(phrases, LONGEST).select("lang", "phrase", F.col("a").alias("n"))
    nodes = _of_width(phrases, node).select("lang", F.col("phrase").alias("node"), "a")
    comes = edges.select("lang", F.col("phrase").alias("edge"), _last(node).alias("node"), "n")
    goes = edges.select("lang", F.col("phrase").alias("after"), _first(node).alias("node"), "n")
    through = nodes.withColumnRenamed("a", "n")
    follows = (comes.join(through, ["lang", "node", "n"])
               .join(goes, ["lang", "node", "n"]).select("lang", "edge", "after"))
    paths = materialise(
        edges.withColumnRenamed("phrase", "edge").join(follows, ["lang", "edge"], "left")
        .select("lang", "edge", "n", F.coalesce("after", "edge").alias("last"),
                F.col("after").isNotNull().cast("long").alias("ahead"),
                F.col("after").isNotNull().alias("moved")), "phrase-paths")
    while not paths.filter("moved").isEmpty():
        ends = paths.select("lang", F.col("edge").alias("last"), F.col("last").alias("_last"),
                            F.col("ahead").alias("_ahead"))
        paths = materialise(
            paths.join(ends, ["lang", "last"])
            .select("lang", "edge", "n", F.col("_last").alias("last"),
                    (F.col("ahead") + F.col("_ahead")).alias("ahead"),
                    (F.col("_ahead") > 0).alias("moved")), "phrase-paths")
    part = F.expr(f"ahead div {PASSAGE_EDGES}")
    chained = F.sort_array(F.collect_list(F.struct((-F.col("ahead")).alias("at"), "edge")))["edge"]
    joined = F.concat_ws(" ", F.col("edges")[0], F.array_join(F.transform(
        F.slice("edges", 2, PASSAGE_EDGES), lambda e: F.substring_index(e, " ", -1)), " "))
    return (paths.groupBy("lang", "last", "n", part.alias("_part"))
            .agg(chained.alias("edges"))
            .select("lang", F.xxhash64("lang", "last").alias("passage"),
                    (F.col("_part") + 1).alias("part_no"),
                    F.rtrim(joined).alias("text"), "n"))


def _covered(phrases: DataFrame) -> DataFrame:
    """Phrases that occur only inside a longer one: some phrase of one word more has their
    count.  Those of LONGEST - 1 words are read off the compacted passages."""
    node = LONGEST - 1
    words = F.split("text", " ")
    inside = compact(phrases).select("lang", F.col("n").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(words) - (node - 1)),
        lambda i: F.array_join(F.slice(words, i, node), " "))).alias("phrase"))
    for width in range(2, node):
        longer = _of_width(phrases, width + 1)
        for part in (_first(width), _last(width)):
            inside = inside.unionByName(longer.select("lang", "a", part.alias("phrase")))
    return inside.distinct()


def mine(docs: DataFrame, least: int = LEAST, first: int = 2000) -> DataFrame:
    """Per language the ``first`` phrases by score: ``lang``, ``rank``, ``phrase``, ``a`` (its
    occurrences), ``l`` and ``r`` (those of the two parts of its lowest-scoring cut), ``n`` (all
    words) and ``score``, floor(1000 * a * n / (l * r)) in exact numbers.

    Phrases have 2 to LONGEST words of one piece and occur ``least`` times; one that lies inside a
    longer phrase as often as it occurs is left out.  Ties go to more occurrences, then by text
    (order of bytes).

    Nulls: a null language is ``und``; a null or empty text has no words.  Repeated rows count as
    often as they are there.  A text of any length is read in parts of whole pieces.  An empty
    table gives no rows.  Other columns are not read.
    """
    graph = build_graph(docs, least)
    phrases = graph.phrases
    kept = phrases.join(_covered(phrases), ["lang", "a", "phrase"], "left_anti")
    known = graph.words.unionByName(phrases.select("lang", "phrase", F.col("a").alias("n")))
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("width") - 1)))
            .withColumns({"_head": F.expr("substring_index(phrase, ' ', k)"),
                          "_tail": F.expr("substring_index(phrase, ' ', k - width)")}))
    heads = known.select("lang", F.col("phrase").alias("_head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("_tail"), F.col("n").alias("r"))

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(18,0)")

    totals = graph.totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    scored = (cuts.join(heads, ["lang", "_head"]).join(tails, ["lang", "_tail"])
              .withColumn("_salt", salt).join(totals, ["lang", "_salt"])
              .withColumns({"_over": F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"),
                            "_under": exact("l") * exact("r")})
              .withColumn("score", F.expr("_over div _under"))
              .groupBy("lang", "_salt", "phrase", "a", "n")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "_salt", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    ranked = scored  # the first of every salt, then the first of those
    for keys in (["lang", "_salt"], ["lang"]):
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("rank", place).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
                         "r", "n", "score")
