"""Merkle manifest of a table: one tree per source, their roots under one root, octopus proofs.

A *block* is a run of ``FANOUT ** HEIGHT`` consecutive nodes, so no run of siblings crosses a
block.  Upwards, each block of nodes gives the one node above it, round after round, until a
tree is down to its root.  Downwards, the proofs of all nodes of a block miss the same few
nodes outside it (``missing``), which are the proof of the block's own node: a block fetches
that once, rebuilds the interiors its members share, and writes out their proofs by itself.
A block is fetched for by as many rows as it has members at most, however large a tree is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.operators.rows import number_rows
from starquill.session import materialise

FANOUT = 3
HEIGHT = 7
DIGEST = 64  # letters of a digest
NODES = "_tree string, _pos long, _total long, _digest string"
PROOFS = "_tree string, _pos long, _proof string, _top string"
_PROOF_SCHEMA = pa.schema([("_tree", pa.string()), ("_pos", pa.int64()), ("_proof", pa.string()),
                           ("_top", pa.string())])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def steps(total: int) -> int:
    """Levels above the leaves of a tree of ``total`` leaves."""
    count = 0
    while total > 1:
        total, count = -(-total // FANOUT), count + 1
    return count


def missing(pos: int, total: int) -> list[tuple[int, int]]:
    """Level and place of the siblings that lead from node ``pos`` of ``total`` to the root."""
    found, level = [], 0
    while total > 1:
        first = pos // FANOUT * FANOUT
        found += [(level, p) for p in range(first, min(first + FANOUT, total)) if p != pos]
        pos, total, level = pos // FANOUT, -(-total // FANOUT), level + 1
    return found


def fold(node: str, pos: int, total: int, proof: str, at: int = 0) -> tuple[str, int]:
    """The root that ``node`` and the siblings of ``proof`` from letter ``at`` on lead to, and
    the letter behind the last sibling used."""
    while total > 1:
        place = pos % FANOUT
        size = min(FANOUT, total - pos + place)
        cut, end = at + place * DIGEST, at + (size - 1) * DIGEST
        node = digest(proof[at:cut] + node + proof[cut:end])
        at, pos, total = end, pos // FANOUT, -(-total // FANOUT)
    return node, at


def interiors(nodes: Sequence[str], total: int, height: int) -> list[Sequence[str]]:
    """The levels that a block's nodes give by themselves: up to its own node, or to the root
    of a tree of ``total`` nodes, whichever comes first."""
    levels = [nodes]
    for _ in range(min(height, steps(total))):
        below = levels[-1]
        levels.append([digest("".join(below[i:i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def expand(levels: list[Sequence[str]], place: int, above: str) -> str:
    """The proof of member ``place`` of a block: its siblings inside, then what the block
    fetched."""
    parts = []
    for level in levels[:-1]:
        first = place // FANOUT * FANOUT
        parts += [level[p] for p in range(first, min(first + FANOUT, len(level))) if p != place]
        place //= FANOUT
    return "".join(parts) + above


def _block(height: int) -> Column:
    return F.expr(f"_pos div {FANOUT ** height}")


def _raise(nodes: DataFrame, height: int) -> DataFrame:
    """The node above every block."""
    def above(key: tuple, members: pa.Table) -> pa.Table:
        members = members.sort_by("_pos")
        total = members.column("_total")[0].as_py()
        top = interiors(members.column("_digest").to_pylist(), total, height)[-1][0]
        return pa.table({"_tree": [key[0].as_py()], "_pos": [key[1].as_py()],
                         "_total": [-(-total // FANOUT ** height)], "_digest": [top]})

    grouped = nodes.withColumn("_block", _block(height)).groupBy("_tree", "_block")
    return grouped.applyInArrow(above, NODES)


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes`` and the nodes above them, until every tree has one."""
    most = nodes.agg(F.coalesce(F.max("_total"), F.lit(0))).first()[0]
    rounds = [nodes]
    while most > 1:
        rounds.append(materialise(_raise(rounds[-1], height), "merkle-nodes"))
        most = -(-most // FANOUT ** height)
    return rounds


def _descend(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The proofs of ``nodes`` from those of the nodes of their blocks."""
    def spread(key: tuple, members: pa.Table, fetched: pa.Table) -> pa.Table:
        members = members.sort_by("_pos")
        own = members.column("_digest").to_pylist()
        rest, top = fetched.column("_proof")[0].as_py(), fetched.column("_top")[0].as_py()
        levels = interiors(own, members.column("_total")[0].as_py(), height)
        return pa.table({
            "_tree": members.column("_tree"), "_pos": members.column("_pos"),
            "_proof": [expand(levels, i, rest) for i in range(len(own))],
            "_top": [top] * len(own)}, schema=_PROOF_SCHEMA)

    return (nodes.withColumn("_block", _block(height)).groupBy("_tree", "_block")
            .cogroup(above.groupBy("_tree", F.col("_pos").alias("_block")))
            .applyInArrow(spread, PROOFS))


def _proofs(rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """Proofs of the blocks of the first round; ``tops`` has the proof and root of each tree."""
    proofs = tops
    for nodes in reversed(rounds[1:-1]):
        proofs = materialise(_descend(nodes, proofs, height), "merkle-proofs")
    return proofs


def _value(column: Column) -> Column:
    """A value as length in UTF-8 bytes, colon and text; a dash for null."""
    text = column.cast("string")
    size = F.octet_length(text).cast("string")
    return F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[_value(c) for c in columns]).cast("binary"), 256)


def manifest(docs: DataFrame, tampered: dict[str, Column], key: str = "doc_id",
             source: str = "source",
             columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             proofs: bool = False, height: int = HEIGHT) -> DataFrame:
    """A row per document with its leaf, the roots above it, and what its proof says.

    ``tampered`` maps columns to what a reader is handed in their place; the proof of the
    original is folded over the leaf of that row.  Returns ``doc_id``, ``leaf``, ``subroot``,
    ``root``, ``proof_sha256`` (of the siblings, joined), ``folded_root`` and ``verified``; with
    ``proofs`` the joined siblings too, as ``proof``.  ``doc_id`` is the column named by ``key``.
    A block has FANOUT ** ``height`` nodes.

    Nulls: a null value counts as a dash; rows of a null source form a tree of their own, the
    first; a null key comes first in its tree.  Rows of equal key follow their leaves, and
    repeated rows get a leaf each.  A tree of one leaf is that leaf.  Empty texts are values
    of no bytes.  An empty table gives no rows.  Further columns are not read.

    The tables between (leaves without texts, nodes, proofs of blocks) are written while this
    is called.
    """
    handed = [tampered.get(c, F.col(c)) for c in columns]
    rows = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("_tree"),
        leaf_of([F.col(c) for c in columns]).alias("_digest"), leaf_of(handed).alias("_handed"))
    placed = number_rows(rows, ["_key", "_digest"], "_pos", within=["_tree"], after=-1)
    totals = placed.groupBy("_tree").agg(F.count(F.lit(1)).alias("_total"))
    leaves = materialise(placed.join(totals, "_tree"), "merkle-leaves")
    names = ("_tree", "_pos", "_total", "_digest")

    rounds = _rounds(leaves.select(*names), height)
    # the trees are down to a node each; these are the leaves of the tree above them
    subroots = materialise(rounds[-1].select("_tree", "_digest"), "merkle-subroots")
    trees = subroots.count()
    forest = materialise(number_rows(subroots, ["_tree"], "_pos", after=-1).select(
        F.lit("").alias("_tree"), "_pos", F.lit(trees).cast("long").alias("_total"), "_digest",
        F.col("_tree").alias("_of")), "merkle-forest")
    upper = _rounds(forest.select(*names), height)
    above = _proofs(upper, upper[-1].select(
        "_tree", "_pos", F.lit("").alias("_proof"), F.col("_digest").alias("_top")), height)
    above = _descend(upper[0], above, height)
    tops = materialise(
        forest.join(above.select("_pos", "_proof", "_top"), "_pos")
        .select(F.col("_of").alias("_tree"), F.lit(0).cast("long").alias("_pos"), "_proof",
                "_top", F.col("_digest").alias("_subroot"), F.col("_pos").alias("_at")),
        "merkle-tops")
    fetched = (_proofs(rounds, tops.select("_tree", "_pos", "_proof", "_top"), height)
               .join(tops.select("_tree", "_subroot", "_at"), "_tree"))
    told = _judge(leaves, fetched, trees, proofs, height)
    return told.withColumnRenamed("_key", "doc_id")


def _judge(leaves: DataFrame, fetched: DataFrame, trees: int, proofs: bool,
           height: int) -> DataFrame:
    """Proofs of the leaves, written out, digested and folded in the block that holds them."""
    texts = ["leaf", "subroot", "root", *(["proof"] if proofs else []), "proof_sha256",
             "folded_root"]
    key_type = leaves.schema["_key"].dataType.simpleString()
    schema = ", ".join([f"_key {key_type}", *(f"{n} string" for n in texts), "verified boolean"])

    def rows_of(members: pa.Table, fetched: pa.Table) -> Iterator[dict]:
        members = members.sort_by("_pos")
        own, handed, places, keys = (members.column(c).to_pylist()
                                     for c in ("_digest", "_handed", "_pos", "_key"))
        total = members.column("_total")[0].as_py()
        rest, root, subroot, at = (fetched.column(c)[0].as_py()
                                   for c in ("_proof", "_top", "_subroot", "_at"))
        levels = interiors(own, total, height)
        for i, pos in enumerate(places):
            proof = expand(levels, i, rest)
            half, used = fold(handed[i], pos, total, proof)
            folded, _ = fold(half, at, trees, proof, used)
            yield {"_key": keys[i], "leaf": own[i], "subroot": subroot, "root": root,
                   "proof": proof, "proof_sha256": digest(proof), "folded_root": folded,
                   "verified": folded == root}

    def judge(key: tuple, members: pa.Table, fetched: pa.Table) -> pa.Table:
        shape = pa.schema([members.schema.field("_key"), *((n, pa.string()) for n in texts),
                           ("verified", pa.bool_())])
        return pa.Table.from_pylist(list(rows_of(members, fetched)), schema=shape)

    return (leaves.withColumn("_block", _block(height)).groupBy("_tree", "_block")
            .cogroup(fetched.groupBy("_tree", F.col("_pos").alias("_block")))
            .applyInArrow(judge, schema))
