"""Language-model scores of whole texts from a weighted backoff automaton.

The states of the automaton are the contexts of up to ``order`` - 1 tokens that training texts
hold, each text beginning in a state of its own.  A state has an arc for every token that followed
it, and a failure arc to the state of its context without the first token.  Counts are smoothed
with a Dirichlet prior: p(w | h) = (c(hw) + K p(w | h')) / (c(h) + K), so the failure arc of h
weighs K / (c(h) + K) and the probabilities of each state sum to 1; below the last state stands the
add-one distribution of single tokens, with one share for all unknown ones.

The automaton of a corpus has about as many arcs as the corpus has words, so it is never in one
place.  Documents are read in blocks.  A block asks for the counts of its distinct n-grams: it
sends them, with its own counts, to buckets of the n-gram hashes; each bucket adds up what all
blocks have sent and answers every one.  The widths of n-grams are asked one after another, so that
the questions of one width lie on disk at a time.  Each block then has the part of the automaton that its
texts traverse: states, arcs and failure arcs, which all texts walk from left to right.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.llm.common import WordHashes, runs, texts_of, whole_groups
from starquill.session import materialise, new_table_path, shuffles_freed

ORDER = 3
PRIOR = 4.0
BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 20
PIECE = 256  # tokens of a text that are walked one after another

# no word holds a space
END = np.uint64(xxhash.xxh64_intdigest(b"the end"))
START = np.uint64(xxhash.xxh64_intdigest(b"the start"))

_hashes = WordHashes()


def squeeze(values: np.ndarray) -> bytes:
    """Bytes of an array, equal places of all numbers together, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def tokens_of(text: bytes) -> np.ndarray:
    """Hashes of the words, then of the end."""
    return np.append(_hashes.of(text.lower().split()), END)


def ngrams(tokens: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """For every token of the texts that begin at ``starts``, the hash of the n-gram of ``width``
    that ends with it; tokens before a text are START."""
    if width == 1:
        return tokens
    lengths = np.diff(np.r_[starts, len(tokens)])
    padded = np.full(len(tokens) + (width - 1) * len(starts), START)
    place = np.arange(len(tokens)) + (width - 1) * np.repeat(np.arange(1, len(starts) + 1), lengths)
    padded[place] = tokens
    return runs(padded, width)[place - width + 1]


def _blocks(docs: DataFrame, held: Column) -> DataFrame:
    """Rows of about BLOCK_BYTES of text: ids, fold and token count of each document, the
    distinct token hashes and each token's index among them."""
    key_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"block long, doc_ids array<{key_type}>, held array<boolean>, lengths array<int>, "
              "n_tokens long, vocabulary binary, tokens binary")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, out, tokens, size = [], [], [], 0
        kind = None

        def row() -> pa.RecordBatch:
            whole = np.concatenate(tokens)
            vocabulary, index = np.unique(whole, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(kind)),
                 pa.array([out], pa.list_(pa.bool_())),
                 pa.array([[len(t) for t in tokens]], pa.list_(pa.int32())),
                 pa.array([len(whole)], pa.int64()), pa.array([squeeze(vocabulary)], pa.binary()),
                 pa.array([squeeze(index.astype(np.uint32))], pa.binary())],
                names=["block", "doc_ids", "held", "lengths", "n_tokens", "vocabulary", "tokens"])

        for batch in batches:
            kind = batch.column("doc_id").type
            for key, away, text in zip(batch.column("doc_id").to_pylist(),
                                       batch.column("held").to_pylist(), texts_of(batch.column("text"))):
                ids.append(key)
                out.append(away)
                tokens.append(tokens_of(text))
                size += len(text) + 1
                if size >= BLOCK_BYTES:
                    yield row()
                    block += 1
                    ids, out, tokens, size = [], [], [], 0
        if ids:
            yield row()

    return docs.select("doc_id", held.alias("held"), "text").mapInArrow(gather, schema)


def _written(blocks: DataFrame) -> DataFrame:
    """The blocks as a table in the shared folder, bucketed by their numbers, so that the counts
    come to them and no text moves again."""
    spark = blocks.sparkSession
    path = new_table_path(spark, "lm-blocks")
    name = f"lm_blocks_{path.rsplit('-', 1)[1]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks.write.bucketBy(parts, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row: a batch may hold many blocks."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: token hashes, starts of the documents, which tokens train, documents' lengths."""
    vocabulary = unsqueeze(row["vocabulary"], np.uint64)
    tokens = vocabulary[unsqueeze(row["tokens"], np.uint32)]
    lengths = np.array(row["lengths"], np.int64)
    trains = np.repeat(~np.array(row["held"], bool), lengths)
    return tokens, np.cumsum(lengths) - lengths, trains, lengths


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grows with the key, so a bucket's keys are a slice of ordered ones."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _questions(blocks: DataFrame, width: int, buckets: int) -> DataFrame:
    """A row per block and bucket: the block's distinct n-grams of ``width`` in order (as
    differences) and its training counts of them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                tokens, starts, trains, _ = _opened(row)
                keys, index = np.unique(ngrams(tokens, starts, width), return_inverse=True)
                counts = np.bincount(index[trains], minlength=len(keys)).astype(np.uint32)
                found, first = np.unique(_bucket(keys, buckets), return_index=True)
                ends = np.r_[first[1:], len(keys)]
                parts = list(zip(first.tolist(), ends.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int64)),
                     pa.array([row["block"]] * len(parts), pa.int64()),
                     pa.array([width] * len(parts), pa.int32()),
                     pa.array([squeeze(np.diff(keys[a:b], prepend=np.uint64(0)))
                               for a, b in parts], pa.binary()),
                     pa.array([squeeze(counts[a:b]) for a, b in parts], pa.binary())],
                    names=["bucket", "block", "width", "keys", "counts"])

    return blocks.select("block", "held", "lengths", "vocabulary", "tokens").mapInArrow(
        ask, "bucket long, block long, width int, keys binary, counts binary")


def _answers(questions: DataFrame) -> DataFrame:
    """For each question the training counts over all blocks.  A row without block has a
    bucket's share of the training tokens and of the distinct ones."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            by_key: dict[tuple[int, int], list[dict]] = {}
            for r in group.to_pylist():
                by_key.setdefault((r["bucket"], r["width"]), []).append(r)
            n_tokens = n_distinct = 0
            blocks, widths, buckets, totals = [], [], [], []
            for (bucket, width), asked in by_key.items():
                keys = [np.cumsum(unsqueeze(r["keys"], np.uint64), dtype=np.uint64) for r in asked]
                counts = np.concatenate([unsqueeze(r["counts"], np.uint32) for r in asked])
                distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.zeros(len(distinct), np.int64)
                np.add.at(total, index, counts.astype(np.int64))
                if width == 1:
                    n_tokens += int(total.sum())
                    n_distinct += int((total > 0).sum())
                at = 0
                for r, k in zip(asked, keys):
                    blocks.append(r["block"])
                    widths.append(width)
                    buckets.append(bucket)
                    totals.append(squeeze(total[index[at:at + len(k)]]))
                    at += len(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*blocks, None], pa.int64()), pa.array([*widths, None], pa.int32()),
                 pa.array([*buckets, None], pa.int64()), pa.array([*totals, None], pa.binary()),
                 pa.array([0] * len(blocks) + [n_tokens], pa.int64()),
                 pa.array([0] * len(blocks) + [n_distinct], pa.int64())],
                names=["block", "width", "bucket", "totals", "n_tokens", "n_distinct"])

    return (questions.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(answer, "block long, width int, bucket long, totals binary, "
                                "n_tokens long, n_distinct long"))


@dataclass(frozen=True)
class Automaton:
    """The states and arcs that the texts of a block can reach.  State 0 has no context; then come
    the contexts of one token, of two, and so on, the one in which a text begins last of each.
    ``keys`` are state and token of the arcs, in order."""

    tokens: int
    keys: np.ndarray
    weights: np.ndarray
    targets: np.ndarray
    failure_weights: np.ndarray
    failures: np.ndarray
    start: int

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of one token behind each state, and the states it leads to."""
        state, weight = state.copy(), np.zeros(len(state))
        left = np.arange(len(state))
        while len(left):
            key = state[left] * self.tokens + token[left]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            found, arc, left = left[there], arc[there], left[~there]
            weight[found] += self.weights[arc]
            state[found] = self.targets[arc]
            weight[left] += self.failure_weights[state[left]]
            state[left] = self.failures[state[left]]
        return weight, state


def automaton(grams: list[np.ndarray], counts: list[np.ndarray], starts: np.ndarray,
              lowest: np.ndarray, n_texts: int, prior: float) -> Automaton:
    """From the n-grams of a block: ``grams[k]`` numbers the one of k + 1 tokens that ends at each
    token, ``counts[k]`` has their training counts, ``lowest`` the probability of each token
    without a context."""
    order, n = len(grams), len(grams[0])
    first = np.zeros(n, bool)
    first[starts] = True
    offsets = np.cumsum([0, 1, *(len(c) + 1 for c in counts[:-1])])
    seen = np.concatenate([[1], *(np.r_[c, n_texts] for c in counts[:-1])])
    # state of the k tokens before each token, whether training has it or not
    contexts = [np.zeros(n, np.int64)]
    for k in range(1, order):
        before = np.r_[0, grams[k - 1][:-1]]
        before[first] = len(counts[k - 1])
        contexts.append(offsets[k] + before)
    failures = np.zeros(offsets[-1], np.int64)
    for k in range(1, order):
        failures[contexts[k]] = contexts[k - 1]
    keys, weights, targets = [], [], []
    chance = np.zeros(0)
    for k in range(1, order + 1):
        at = np.zeros(len(counts[k - 1]), np.int64)
        at[grams[k - 1]] = np.arange(n)  # a place of each n-gram
        source, count = contexts[k - 1][at], counts[k - 1]
        if k == 1:
            chance = np.ones(len(count))
            chance[grams[0]] = lowest
        else:
            chance = (count + prior * chance[grams[k - 2][at]]) / (seen[source] + prior)
        longest = min(k, order - 1)
        target = offsets[longest] + grams[longest - 1][at] if longest else np.zeros(len(at), np.int64)
        target = np.where(count > 0, target, 0)
        # the lowest state has an arc for every token, the others for those that followed them
        there = np.flatnonzero((count > 0) | (k == 1))
        keys.append(source[there] * len(counts[0]) + grams[0][at[there]])
        weights.append(np.log10(chance[there]))
        targets.append(target[there])
    joined = np.concatenate(keys)
    by_key = np.argsort(joined)
    with np.errstate(divide="ignore"):
        failure_weights = np.log10(prior / (seen + prior))
    start = int(offsets[order - 1] + len(counts[order - 2])) if order > 1 and n_texts else 0
    return Automaton(len(counts[0]), joined[by_key], np.concatenate(weights)[by_key],
                     np.concatenate(targets)[by_key], failure_weights, failures, start)


def traverse(grams: list[np.ndarray], counts: list[np.ndarray], starts: np.ndarray, n_tokens: int,
             n_distinct: int, n_texts: int, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every token under the automaton and under its lowest state.

    The texts are walked from left to right, all at once, and each carries its state.  A text of
    more than PIECE tokens is walked in pieces side by side: a piece but the first begins ``order``
    - 1 tokens early in the lowest state, and these lead it to the state of the whole text, as a
    state knows no more than that many tokens.
    """
    order, n = len(grams), len(grams[0])
    lowest = (counts[0][grams[0]] + 1) / (n_tokens + n_distinct + 1)
    walk = automaton(grams, counts, starts, lowest, n_texts, prior)
    lengths = np.diff(np.r_[starts, n])
    pieces = -(-lengths // PIECE)
    text = np.repeat(np.arange(len(starts)), pieces)
    own = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
    begin = np.maximum(0, own - (order - 1))
    steps = np.minimum(own + PIECE, lengths[text]) - begin
    falling = np.argsort(-steps, kind="stable")
    text, own, begin, steps = (x[falling] for x in (text, own, begin, steps))
    state = np.where(begin == 0, walk.start, 0)
    at, own = starts[text] + begin, starts[text] + own
    chance = np.zeros(n)
    for t in range(int(steps[0]) if len(steps) else 0):
        active = int(np.searchsorted(-steps, -t, "left"))
        here = at[:active] + t
        weight, state[:active] = walk.step(state[:active], grams[0][here])
        counted = here >= own[:active]
        chance[here[counted]] = weight[counted]
    return chance, np.log10(lowest)


def score_texts(docs: DataFrame, held: Column, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """A row per document: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``
    (tokens that training has), ``train_tokens``, ``base_score`` (add-one single tokens) and
    ``score`` (the automaton), both log10 probabilities of the whole text.

    Words are what lies between ASCII white space, A-Z lower-cased; they are told apart by 64-bit
    hashes.  All documents that are not ``held`` train; nothing is left out of the counts.

    A null text is empty and has its end alone; a null in ``held`` means it trains.  Repeated
    rows count and are scored each.  Without training texts every token has probability 1.  No
    documents give no rows; columns other than ``doc_id`` and ``text`` are read only by ``held``.
    """
    held = F.coalesce(held, F.lit(False))
    blocks = _written(_blocks(docs, held))
    size = blocks.agg(F.sum("n_tokens"), F.sum(F.size(F.filter("held", lambda x: ~x)))).first()
    n_texts = size[1] or 0
    buckets = max(1, math.ceil((size[0] or 0) / BUCKET_KEYS))
    with shuffles_freed(docs.sparkSession):
        answers = reduce(DataFrame.unionByName, [
            materialise(_answers(_questions(blocks, width, buckets)), "lm-counts")
            for width in range(1, order + 1)])
    counted = answers.filter("block IS NULL").agg(F.sum("n_tokens"), F.sum("n_distinct")).first()
    n_tokens, n_distinct = counted[0] or 0, counted[1] or 0
    # one row per block and bucket that it asked: as many n-grams as the block has tokens
    parts = answers.filter("block IS NOT NULL").groupBy("block").agg(
        F.collect_list(F.struct("width", "bucket", "totals")).alias("parts"))
    key_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {key_type}, held_out boolean, n_tokens long, n_known long, "
              "train_tokens long, base_score double, score double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("doc_ids").type.value_type
            for row in _rows(batch):
                tokens, starts, _, lengths = _opened(row)
                grams, counts = [], []
                for width in range(1, order + 1):
                    grams.append(np.unique(ngrams(tokens, starts, width), return_inverse=True)[1])
                    told = sorted((p["bucket"], p["totals"]) for p in row["parts"] if p["width"] == width)
                    counts.append(np.concatenate([unsqueeze(t, np.int64) for _, t in told]))
                chance, lowest = traverse(grams, counts, starts, n_tokens, n_distinct, n_texts, prior)
                known = (counts[0][grams[0]] > 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], kind), pa.array(row["held"], pa.bool_()),
                     pa.array(lengths), pa.array(np.add.reduceat(known, starts)),
                     pa.array(np.full(len(lengths), n_tokens, np.int64)),
                     pa.array(np.add.reduceat(lowest, starts)),
                     pa.array(np.add.reduceat(chance, starts))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"])

    return blocks.drop("n_tokens").join(parts, "block").mapInArrow(score, schema)
