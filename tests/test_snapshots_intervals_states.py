"""Snapshots, folder-wise deletes, run-time pruning, interval joins, state comparison, vectors."""

from __future__ import annotations

import datetime as dt
import os
import random
import re
from decimal import Decimal as d
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starquill.bindings import function_queries, source_queries
from starquill.functions.periods import period_end, period_start
from starquill.operators.intervals import interval_join, micros
from starquill.plans import jobs
from starquill.plans import table_functions as tf
from starquill.session import new_table_path
from starquill.sources import files
from starquill.sources.inline import values
from starquill.sources.snapshots import Snapshot
from test_table_functions import SALES


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# snapshots

def test_snapshot_stays_and_goes(spark):
    path = new_table_path(spark, "source")
    values(spark, [(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    with Snapshot(spark.read.parquet(path).filter("k = 1"), "pinned_rows") as pinned:
        values(spark, [(1, "changed")], "k int, v string").write.mode("overwrite").parquet(path)
        assert rows(spark.sql("SELECT * FROM pinned_rows")) == [(1, "a")]
        assert rows(pinned.rows()) == [(1, "a")]
        assert rows(spark.read.parquet(path)) == [(1, "changed")]
        assert os.path.exists(pinned.path)
    assert not os.path.exists(pinned.path)
    with pytest.raises(AnalysisException):
        spark.table("pinned_rows")


def test_snapshot_goes_after_a_failure(spark):
    with pytest.raises(ZeroDivisionError):
        with Snapshot(spark.range(3), "failing") as pinned:
            1 / 0
    assert not os.path.exists(pinned.path) and not spark.catalog.tableExists("failing")


# folders

def listed(path):
    return {os.path.join(folder, f): os.path.getmtime(os.path.join(folder, f))
            for folder, _, found in os.walk(path) for f in found if f.endswith(".parquet")}


def folder_table(spark):
    path = new_table_path(spark, "folders")
    data = [(i, f"v{i}", ["x", "y", "a b:c%", None][i % 4]) for i in range(40)]
    table = values(spark, data, "k int, v string, part string")
    files.write_partitioned(table, path, "part", ["k"])
    return path, data


@pytest.mark.parametrize("condition,gone", [
    ("k % 8 = 0", lambda k, p: k % 8 == 0), ("part = 'y'", lambda k, p: p == "y"),
    ("part = 'a b:c%' OR k = 0", lambda k, p: p == "a b:c%" or k == 0),
    ("part IS NULL OR k = 5", lambda k, p: p is None or k == 5),
    ("part IS NULL AND k = 3", lambda k, p: p is None and k == 3),
    ("k < 0", lambda k, p: False), ("true", lambda k, p: True)])
def test_delete_by_folder(spark, condition, gone):
    path, data = folder_table(spark)
    before = listed(path)
    done = files.delete_where_by_folder(spark, path, F.expr(condition), "part")
    want = [r for r in data if not gone(r[0], r[2])]
    hit = {r[2] for r in data if gone(r[0], r[2])}
    assert set(done.rewritten) == hit & {r[2] for r in want}
    assert set(done.removed) == hit - {r[2] for r in want}
    if want:
        assert sorted(rows(spark.read.parquet(path).select("k", "v", "part"))) == sorted(want)
    after = listed(path)
    def value(file):
        text = unquote(os.path.basename(os.path.dirname(file)).partition("=")[2])
        return None if text.startswith("__HIVE_DEFAULT") else text
    untouched = {f for f in before if value(f) not in hit}
    assert {value(f) for f in untouched} == {r[2] for r in data} - hit
    assert all(after[f] == before[f] for f in untouched)
    assert len({os.path.dirname(f) for f in after}) == len({r[2] for r in want})


def test_folders_are_pruned_when_it_runs(spark):
    path, data = folder_table(spark)
    stored = spark.read.schema("k int, v string, part string").parquet(path)
    places = new_table_path(spark, "dimension")
    values(spark, [("x", 1), ("y", 2), ("zz", 1)], "part string, rank int").write.parquet(places)
    dimension = spark.read.parquet(places)
    found = files.pruned_by(stored, dimension.filter("rank = 1"), "part")
    assert "dynamicpruning" in plan_of(found)
    assert sorted(r[0] for r in rows(found.select("k"))) == [r[0] for r in data if r[2] == "x"]


def test_key_is_pruned_by_the_lines(spark, sf_dir):
    plan = plan_of(source_queries.pruned_by_dimension(spark, sf_dir))
    assert "dynamicpruning" in plan


# intervals

DAY = dt.datetime(2020, 1, 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join_by_brute_force(spark, seed):
    rng = random.Random(seed)
    step = [dt.timedelta(microseconds=1), dt.timedelta(seconds=1), dt.timedelta(days=1),
            dt.timedelta(days=40_000)]

    def moment():
        return DAY + rng.choice([-1, 1]) * rng.choice(step[:3]) * rng.randrange(500)
    facts = [(i, moment() if i % 9 else None) for i in range(200)]
    bounds = []
    for i in range(60):
        start = moment()
        end = start + rng.choice(step) * rng.randrange(-1, 20)
        bounds.append((i, None if i % 13 == 5 else start, None if i % 17 == 3 else end))
    bounds += [(100, DAY, DAY), (101, DAY, DAY + step[0]), (102, dt.datetime(1, 1, 1),
                                                           dt.datetime(9999, 12, 31))]
    got = interval_join(values(spark, facts, "f int, at timestamp_ntz"), "at",
                        values(spark, bounds, "b int, a timestamp_ntz, z timestamp_ntz"), "a", "z")
    assert got.columns == ["f", "at", "b", "a", "z"]
    want = [(f, b) for f, at in facts for b, a, z in bounds
            if at and a and z and a <= at < z]
    assert sorted(rows(got.select("f", "b"))) == sorted(want)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    none = interval_join(values(spark, facts, "f int, at timestamp_ntz"), "at", values(
        spark, [], "b int, a timestamp_ntz, z timestamp_ntz"), "a", "z")
    assert rows(none) == []


def test_micros(spark):
    at = [dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
          dt.datetime(2020, 2, 29, 13, 5, 7, 123456), dt.datetime(1, 1, 1)]
    df = values(spark, [(x,) for x in at], "at timestamp_ntz")
    assert rows(df.select(micros(F.col("at")))) == [
        ((x - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1),) for x in at]


def test_revenue_of_periods(rental, spark):
    texts = [" 2017-q1 ", "2017-Q1", "2017-Q2", None, "", "2017-Q5", "0000-Q1", "9999-Q4", "1-Q"]
    asked = values(spark, [(t,) for t in texts], "period string")
    args = [rental[t] for t in SALES]
    got = rows(tf.revenue_of_periods(*args, asked))
    assert sorted(got) == sorted(rows(tf.category_revenue(*args, "2017-Q1"))
                                 + rows(tf.category_revenue(*args, "2017-Q2")))
    bounds = asked.select(period_start(F.col("period")).alias("a"),
                          period_end(F.col("period")).alias("z")).filter("a IS NOT NULL")
    assert bounds.count() == 4


def test_periods_need_no_nested_loop(spark, sf_dir):
    plan = plan_of(function_queries.revenue_of_periods(spark, sf_dir))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# states

STATE = "k int, part string, a string, b decimal(5,2), last_update timestamp_ntz"
T0, T1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)


def test_states(spark):
    old = [(1, "x", "a", d("1.00"), T0), (2, "x", None, None, T0), (3, "x", "1:", None, T0),
           (4, None, "same", None, T0), (5, "x", "gone", None, None), (1, None, "", None, T0)]
    new = [(1, "x", "a", d("1.00"), None), (2, "x", "", None, None), (3, "x", "1", None, None),
           (4, None, "same", None, T1), (6, None, "new", None, T1), (1, None, None, None, T0)]
    before, after = values(spark, old, STATE), values(spark, new, STATE)
    changes = rows(jobs.compare_states(before, after, ["k", "part"]).select(
        "k", "part", "a", "change"))
    assert sorted(changes, key=repr) == sorted([
        (2, "x", "", "updated"), (3, "x", "1", "updated"), (5, "x", "gone", "deleted"),
        (6, None, "new", "inserted"), (1, None, None, "updated")], key=repr)
    loaded = jobs.stamp_changes(before, after, ["k", "part"], T1)
    assert sorted(rows(loaded.state), key=repr) == sorted([
        (1, "x", "a", d("1.00"), T0), (2, "x", "", None, T1), (3, "x", "1", None, T1),
        (4, None, "same", None, T0), (6, None, "new", None, T1), (1, None, None, None, T1)],
        key=repr)


def test_states_that_are_alike_or_empty(spark):
    old = values(spark, [(1, "x", "a", None, T0)], STATE)
    assert rows(jobs.compare_states(old, old, ["k"])) == []
    assert [r["change"] for r in jobs.compare_states(old.limit(0), old, ["k"]).collect()] == [
        "inserted"]
    assert [r["change"] for r in jobs.compare_states(old, old.limit(0), ["k"]).collect()] == [
        "deleted"]


# token vectors

TEXTS = [(1, "Zwei zwei, DREÍ x1y zwei"), (2, ""), (3, None), (4, "... 12"), (5, "中 a A"),
         (6, "a b " * 300)]


def vector(text):
    words = [w.lower() for w in re.findall("[^\\W\\d_́]+(?:́)*", text or "")]
    return [(t, [i for i, w in enumerate(words, 1) if w == t]) for t in sorted(set(words))]


def vectors(df):
    return {r["id"]: [(e["term"], e["positions"]) for e in r["vector"]] for r in df.collect()}


def test_token_vectors(spark):
    docs = values(spark, TEXTS, "id int, text string")
    made = jobs.token_vectors(docs, "id", "text")
    assert "Exchange" not in plan_of(made)
    assert vectors(made) == {i: vector(t) for i, t in TEXTS}


def test_postings_are_merged(spark):
    docs = values(spark, TEXTS, "id int, text string")
    held = jobs.postings_of(jobs.token_vectors(docs, "id", "text"), "id")
    changed = [(1, "neu"), (4, "jetzt da"), (5, None), (7, "zwei")]
    now = jobs.merge_postings(held, jobs.token_vectors(
        values(spark, changed, "id int, text string"), "id", "text"), "id")
    want = [(t, i, p) for i, text in {**dict(TEXTS), **dict(changed)}.items()
            for t, p in vector(text)]
    assert sorted(rows(now)) == sorted(want)
