"""Constraint checks that report the rows which break a rule.

Every check returns (table_name, rule_name, row_key, n_rows); no row means the rule holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from graphlib import TopologicalSorter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquill.session import materialise


def row_key(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def _report(df: DataFrame, table: str, rule: Column | str, key: Column, n_rows: Column
            ) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(F.lit(table).alias("table_name"), rule.alias("rule_name"),
                     key.alias("row_key"), n_rows.cast("long").alias("n_rows"))


def unique_violations(df: DataFrame, table: str, key: Sequence[str], rule: str) -> DataFrame:
    """Keys that occur more than once; a key with a NULL in it equals no other."""
    complete = df.select(*key).dropna()
    repeated = complete.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _report(repeated, table, rule, row_key(key), F.col("_n"))


def foreign_key_violations(child: DataFrame, table: str, columns: Sequence[str],
                           parent: DataFrame, parent_key: Sequence[str], rule: str) -> DataFrame:
    """References that point nowhere, with the number of rows that hold them.

    The child is counted per reference first, so a reference held by many rows crosses the
    shuffle once per task.
    """
    held = (child.select(*columns).dropna().groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_key, columns)])
    orphans = held.join(keys, list(columns), "left_anti")
    return _report(orphans, table, rule, row_key(columns), F.col("_n"))


def not_null_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULL, with the number of rows; all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])
    found = counts.select(F.explode(pairs).alias("f")).filter("f.n > 0")
    return _report(found, table, F.concat(F.lit("not null "), F.col("f.column")),
                   F.lit(""), F.col("f.n"))


def check_violations(df: DataFrame, table: str, key: Sequence[str],
                     rules: dict[str, Column]) -> DataFrame:
    """Rows for which a rule is false, one line per row and rule, in one pass.

    A rule that comes out NULL is met, as in an SQL CHECK.
    """
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name))
                                       for name, rule in rules.items()]))
    found = df.select(*key, F.explode(broken).alias("_rule"))
    return _report(found, table, F.col("_rule"), row_key(key), F.lit(1))


def positive(column: str) -> Column:
    return F.col(column) > 0


def not_blank(column: str) -> Column:
    return F.btrim(column) != ""


def after_instant(column: str, instant: str = "2000-01-01 00:00:00") -> Column:
    return F.col(column) > F.lit(instant).cast("timestamp_ntz")


def one_of(column: str, allowed: Sequence[str]) -> Column:
    return F.col(column).isin(*allowed)


def differ(column: str, other: str) -> Column:
    return F.col(column) != F.col(other)


def at_most_long(column: str, limit: int = 255) -> Column:
    return F.char_length(column) <= limit


class Reference(NamedTuple):
    """``child.columns`` refer to ``parent.parent_key``."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_key: tuple[str, ...]


def load_order(references: Sequence[Reference]) -> list[str]:
    """Table names with every parent ahead of its children."""
    sorter: TopologicalSorter = TopologicalSorter()
    for ref in references:
        sorter.add(ref.parent)
        if ref.child != ref.parent:
            sorter.add(ref.child, ref.parent)
    return list(sorter.static_order())


def descendants(df: DataFrame, key: str, parent: str, roots: DataFrame) -> DataFrame:
    """Keys of ``roots`` and of all rows below them along ``parent``.

    Each round lets a row look twice as far up as before, so a reply chain of n rows takes
    about log2(n) rounds.  Only rows that have not found a root and have not reached the
    top take part in a round, and only they are written out by it, which cuts the lineage.
    Runs jobs while it is called.
    """
    hit = roots.select(F.col(key), F.lit(True).alias("_root")).distinct()
    state = df.join(hit, key, "left").select(
        F.col(key), F.col(parent).alias("_up"),
        F.coalesce("_root", F.lit(False)).alias("_hit"))
    state = materialise(state, "closure")
    looking = ~F.col("_hit") & F.col("_up").isNotNull()
    settled, open_ = state.filter(~looking), state.filter(looking)
    n_rows, reach = state.count(), 1
    # once the reach covers the table, a row still looking is on a cycle without a root
    while reach <= n_rows and not open_.isEmpty():
        above = settled.unionByName(open_).select(F.col(key).alias("_at"), F.col("_up").alias("_next"),
                             F.col("_hit").alias("_found"))
        moved = (open_.join(above, F.col("_up") == F.col("_at"), "left")
                 .select(F.col(key), F.col("_next").alias("_up"),
                         F.coalesce("_found", F.lit(False)).alias("_hit")))
        moved = materialise(moved, "closure")
        settled, open_ = settled.unionByName(moved.filter(~looking)), moved.filter(looking)
        reach *= 2
    return settled.filter("_hit").select(key)


def cascade_closure(tables: dict[str, DataFrame], keys: dict[str, tuple[str, ...]],
                    references: Sequence[Reference], roots: dict[str, DataFrame]
                    ) -> dict[str, DataFrame]:
    """Keys that a cascading delete of ``roots`` would remove, per table.

    Tables are visited parents first, each joined to what its parents lose.  A reference
    of a table to itself must be a single key column and is followed to the end.
    """
    lost: dict[str, DataFrame] = {}
    for table in load_order(references):
        key = list(keys[table])
        parts = [roots[table].select(*key)] if table in roots else []
        own = None
        for ref in references:
            if ref.child != table:
                continue
            if ref.parent == table:
                own = ref
            elif ref.parent in lost:
                gone = lost[ref.parent].select(
                    *[F.col(p).alias(c) for p, c in zip(ref.parent_key, ref.columns)])
                parts.append(tables[table].join(gone, list(ref.columns), "left_semi")
                             .select(*key))
        if not parts:
            continue
        gone = parts[0]
        for part in parts[1:]:
            gone = gone.unionByName(part)
        if own is not None:
            gone = descendants(tables[table], own.parent_key[0], own.columns[0], gone)
        lost[table] = gone.distinct()
    return lost
