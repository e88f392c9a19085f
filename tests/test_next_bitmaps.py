"""Followers across parts of a table, and sets as bitmaps."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from starquill.operators.bitmaps import key_set, merged, missing_keys, set_sizes
from starquill.operators.rows import with_next
from starquill.sources.inline import values


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("hot", [0.0, 0.9, 1.0])
def test_next_by_brute_force(spark, hot):
    rng = random.Random(3)
    data = [(i, None if rng.random() < 0.1 else 1 if rng.random() < hot else rng.randrange(9),
             dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randrange(200)),
             rng.choice([None, "a", "b"])) for i in range(300)]
    df = values(spark, data, "id int, k int, at timestamp_ntz, v string").repartition(5)
    got = with_next(df, ["k"], ["at", "id"], "v", "then")
    assert got.columns == ["id", "k", "at", "v", "then"]
    want, last = [], {}
    for i, k, at, v in sorted(data, key=lambda r: (r[2], r[0]), reverse=True):
        want.append((i, k, at, v, last.get(k)))
        last[k] = v
    assert sorted(rows(got)) == sorted(want)


def test_next_of_no_keys_and_nothing(spark):
    df = values(spark, [(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    assert sorted(rows(with_next(df, [], ["k"], "v"))) == [
        (1, "a", "b"), (2, "b", "c"), (3, "c", None)]
    assert rows(with_next(df.limit(0), ["k"], ["v"], "v")) == []


NUMBERS = [0, 1, 2, 32767, 32768, 32769, 65536, -1, -32768, 10 ** 12, None, 1, 0]


def test_sets(spark):
    df = values(spark, [(n, i % 2) for i, n in enumerate(NUMBERS)], "n long, part int")
    assert rows(set_sizes(key_set(df, "n"))) == [(len(set(NUMBERS) - {None}),)]
    parts = key_set(df, "n", ["part"])
    assert sorted(rows(set_sizes(parts, ["part"]))) == [
        (p, len({n for i, n in enumerate(NUMBERS) if i % 2 == p} - {None})) for p in (0, 1)]
    assert rows(set_sizes(merged(parts))) == rows(set_sizes(key_set(df, "n")))
    assert rows(set_sizes(key_set(df.limit(0), "n"))) == [(0,)]


def test_missing_keys(spark):
    facts = values(spark, [(n,) for n in NUMBERS], "n long")
    held = values(spark, [(n,) for n in (0, 2, 32768, 65536, None, 7)], "id int")
    assert sorted(rows(missing_keys(facts, "n", held, "id"))) == sorted(
        (n, NUMBERS.count(n)) for n in set(NUMBERS) - {0, 2, 32768, 65536, None})
    assert rows(missing_keys(held, "id", facts.unionByName(held.selectExpr("id AS n")), "n")) == []
    assert len(rows(missing_keys(facts, "n", held.limit(0), "id"))) == 10
