"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.operators.rows import number_rows


@dataclass(frozen=True)
class Leaf:
    """A shard: its number, the names of its region and rack, its weight.  ``late`` shards
    joined a tree that was already in use."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0
    late: bool = False


def even_tree(shards: int, racks: int = 2, regions: int = 2) -> tuple[Leaf, ...]:
    """``shards`` equal shards, dealt over ``regions`` with ``racks`` racks each."""
    return tuple(Leaf(s, f"region{s % regions}", f"rack{s // regions % racks}")
                 for s in range(shards))


def add_shard(tree: tuple[Leaf, ...], leaf: Leaf) -> tuple[Leaf, ...]:
    """The tree with one shard more.  Only rows that the new shard wins move, into it."""
    if leaf.shard in {x.shard for x in tree}:
        raise ValueError(f"shard {leaf.shard} is in the tree")
    return (*tree, replace(leaf, late=True))


def _draw(key: Column, node: str, weight: float) -> Column:
    """A weighted draw of ``key`` at ``node``: the time of the first event of a process of rate
    ``weight``.  Changing the weight of a node changes no other node's draw."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / F.lit(weight)


def _first(draws: list[tuple[Column, Column]]) -> Column:
    """The choice with the least draw."""
    return F.array_min(F.array(*[F.struct(t.alias("t"), c.alias("c")) for t, c in draws]))["c"]


def assign_shard(key: Column, tree: tuple[Leaf, ...]) -> Column:
    """The shard of ``key`` (any column; null counts as empty text).

    A row draws among the regions, then among the racks of its region, then among the shards of
    its rack; a node's weight is that of the shards in it.  If a weight changes, rows move only
    into or out of the subtrees that hold the change.  A late shard draws at the root, against
    the regions: it takes its share from all others and no row moves between them.
    """
    tree = tuple(x for x in tree if x.weight > 0)
    if not tree:
        raise ValueError("no shard has a weight")
    text = F.coalesce(key.cast("string"), F.lit(""))

    def choose(leaves: list[Leaf], path: str, levels: tuple[str, ...]) -> Column:
        if not levels:
            return _first([(_draw(text, f"{path}/shard{x.shard}", x.weight), F.lit(x.shard))
                           for x in leaves])
        groups: dict[str, list[Leaf]] = {}
        for x in leaves:
            groups.setdefault(getattr(x, levels[0]), []).append(x)
        return descend([(f"{path}/{name}", inside) for name, inside in groups.items()], [],
                       levels[1:])

    def descend(groups: list[tuple[str, list[Leaf]]], late: list[Leaf],
                levels: tuple[str, ...]) -> Column:
        draws = [(_draw(text, path, sum(x.weight for x in inside)), F.lit(path))
                 for path, inside in groups]
        draws += [(_draw(text, f"late/shard{x.shard}", x.weight), F.lit(f"late/{x.shard}"))
                  for x in late]
        won, chosen = _first(draws), F.lit(None).cast("int")
        for path, inside in groups:
            chosen = F.when(won == path, choose(inside, path, levels)).otherwise(chosen)
        for x in late:
            chosen = F.when(won == f"late/{x.shard}", F.lit(x.shard)).otherwise(chosen)
        return chosen

    groups: dict[str, list[Leaf]] = {}
    for x in tree:
        if not x.late:
            groups.setdefault(x.region, []).append(x)
    return descend(list(groups.items()), [x for x in tree if x.late], ("rack",))


def shard_documents(docs: DataFrame, tree: tuple[Leaf, ...], grown: tuple[Leaf, ...],
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: ``key``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (0, 1, ... within the shard) and ``grown_shard`` (its shard in
    ``grown``).

    Nulls: a null text has no bytes; all rows of a null key share a shard, as key and tree alone
    decide.  Repeated rows get slots of their own.  An empty table gives no rows.  Other columns
    are not read.  Slots come from one range-partitioned numbering in the order of shard and
    key, so no shard meets in one task.
    """
    utf8 = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(key), F.length(utf8).cast("long").alias("size"),
                       F.crc32(utf8).alias("text_crc32"), F.lit("key").alias("law"),
                       assign_shard(F.col(key), tree).alias("shard"),
                       assign_shard(F.col(key), grown).alias("grown_shard"))
    rows = rows.withColumn("size", F.col("size") + 1)
    # the copy number only spreads rows that are alike in everything else
    spread = rows.withColumn("_copy", F.monotonically_increasing_id())
    placed = number_rows(spread, ["shard", key, "size", "text_crc32", "_copy"], "_place")
    # a row per shard, at most as many as the tree has leaves
    firsts = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(
        F.min("_place").alias("first")).collect()}
    first = F.lit(0).cast("long")
    for shard, place in firsts.items():
        first = F.when(F.col("shard") == shard, F.lit(place)).otherwise(first)
    return placed.select(key, "size", "text_crc32", "law", "shard",
                         (F.col("_place") - first).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, tree: tuple[Leaf, ...], key: str = "doc_id",
                 spread: int = 16) -> None:
    """The documents as Parquet, a folder per shard; ``spread`` tasks write each."""
    (docs.withColumn("shard", assign_shard(F.col(key), tree))
     .withColumn("_salt", F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")),
                                            F.monotonically_increasing_id()), F.lit(spread)))
     .repartition("shard", "_salt").drop("_salt").write.partitionBy("shard").parquet(path))
