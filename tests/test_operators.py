from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starquill import session
from starquill.functions import scalars as sc
from starquill.operators import aggregates as agg
from starquill.operators import rows as ops
from starquill.sources.inline import values


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key."""
    rng = random.Random(5)
    data = [(0 if rng.random() < 0.34 else rng.randrange(1, 40), f"v{rng.randrange(500):03d}", i)
            for i in range(3000)]
    df = spark.createDataFrame(data, "g int, v string, i long").repartition(6)
    return df, data


def test_first_per_key(skewed):
    df, data = skewed
    got = rows(ops.first_per_key(df, ["g"], [F.desc("v"), "i"]))
    best = {}
    for g, v, i in sorted(data, key=lambda r: r[2]):
        if g not in best or v > best[g][1]:
            best[g] = (g, v, i)
    assert got == sorted(best.values(), key=repr)


def test_first_per_key_limits_rows_ahead_of_the_shuffle(skewed):
    plan = ops.first_per_key(skewed[0], ["g"], ["i"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan


def test_number_rows(skewed):
    df, data = skewed
    got = {r["i"]: r["row_num"] for r in ops.number_rows(df, ["v", "i"], after=100).collect()}
    assert got == {i: n + 101 for n, (_, i) in enumerate(sorted((v, i) for _, v, i in data))}


def test_number_rows_within_groups(skewed):
    df, data = skewed
    got = {r["i"]: r["n"] for r in ops.number_rows(df, ["v", "i"], "n", within=["g"]).collect()}
    want, seen = {}, {}
    for g, v, i in sorted(data):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert got == want


def test_number_rows_spreads_a_single_group(spark):
    one = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    numbered = ops.number_rows(one, ["v"], "n", within=["g"])
    assert rows(numbered.select("v", "n")) == rows(one.select("v", F.col("v") + 1))
    empty = ops.number_rows(one.limit(0), ["v"], "n")
    assert empty.isEmpty()


@pytest.mark.parametrize("part_size", [None, 7, 10_000])
def test_text_concat(skewed, part_size):
    df, data = skewed
    got = agg.text_concat(df, ["g"], "v", ["v", "i"], ", ", part_size)
    texts = {}
    order = ["g"] if part_size is None else ["g", "part_no"]
    for r in got.orderBy(*order).collect():
        n = r["texts"].count(",") + 1
        assert part_size is None or n <= part_size
        texts[r["g"]] = texts[r["g"]] + ", " + r["texts"] if r["g"] in texts else r["texts"]
    want = {}
    for g, v, _ in sorted(data):
        want.setdefault(g, []).append(v)
    assert texts == {g: ", ".join(vs) for g, vs in want.items()}


def test_text_concat_skips_null(spark):
    df = values(spark, [(1, "b"), (1, None), (1, "a"), (2, None)], "g int, v string")
    assert rows(agg.text_concat(df, ["g"], "v", ["v"], "' | ", None)) == [(1, "a' | b")]


def test_conditional_distinct_counts(skewed):
    df, data = skewed
    conditions = {"low": F.col("v") < "v100", "none": F.lit(False)}
    got = rows(agg.conditional_distinct_counts(df, "g", "v", conditions))
    want = [(g, len({v for h, v, _ in data if h == g and v < "v100"}), 0)
            for g in {r[0] for r in data}]
    assert got == sorted(want, key=repr)


def test_extremum_keeps_ties(spark):
    df = values(spark, [(1, 5), (2, 7), (3, 7), (4, None), (5, 5)], "k int, n int")
    assert rows(ops.at_extremum(df, "n")) == [(2, 7), (3, 7)]
    assert rows(ops.at_extremum(df, "n", greatest=False)) == [(1, 5), (5, 5)]
    assert rows(ops.at_extremum(df.filter("n IS NULL"), "n")) == []


def test_hot_join_key_is_split(spark):
    """The joins ahead of the grouping must leave AQE free to split a hot key."""
    from starquill.plans import reports

    n = 120_000
    links = spark.range(n, numPartitions=6).select(
        (F.col("id") % 5000).alias("actor_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).alias("film_id"))
    film = spark.range(900).select(F.col("id").alias("film_id"),
                                   (F.col("id") % 20 + 2000).alias("release_year"))
    actor = spark.range(5000).select(F.col("id").alias("actor_id"), F.lit("a").alias("first_name"),
                                     F.lit("b").alias("last_name"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        df = reports.busiest_actors_cte(actor, links, film, 2000)
        got = [tuple(r) for r in df.collect()]
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == [(i, "a", "b", n // 5000) for i in range(5)]


def test_fallback(spark):
    df = values(spark, [(1,)], "n int")
    other = values(spark, [(9,)], "n int")
    assert rows(ops.with_fallback(df, other)) == [(1,)]
    assert rows(ops.with_fallback(df.filter("n > 1"), other)) == [(9,)]


def test_picks(spark):
    df = values(spark, [(3,), (1,), (2,)], "n int")
    assert rows(ops.pick_first(df, "n")) == [(1,)]
    assert rows(ops.pick_random(df, 3)) == rows(ops.pick_random(df, 3))
    assert {rows(ops.pick_random(df, s))[0][0] for s in range(25)} == {1, 2, 3}


def test_scalars(spark):
    df = spark.sql("""SELECT * FROM VALUES
        ('1 Main', NULL), ('1 Main', ''), ('1 Main', 'Flat 2'), (NULL, 'x') AS t(a, b)""")
    assert [r[0] for r in df.select(sc.address_text(df.a, df.b)).collect()] == [
        "1 Main", "1 Main", "1 Main, Flat 2", None]
    days = spark.sql("""SELECT timestamp_ntz'2020-02-28 10:00:00' AS s, e FROM VALUES
        (timestamp_ntz'2020-02-28 10:00:00'), (timestamp_ntz'2020-02-28 10:00:01'),
        (timestamp_ntz'2020-02-29 10:00:00'), (timestamp_ntz'2020-03-01 09:00:00'),
        (timestamp_ntz'2020-02-27 10:00:00'), (timestamp_ntz'2020-02-27 11:00:00') AS t(e)""")
    assert [r[0] for r in days.select(sc.whole_days(days.s, days.e)).collect()] == [
        0, 1, 1, 2, -1, 0]
    slug = spark.range(1).select(sc.name_slug("client_", F.lit("Mary-Ann"), F.lit("O' Neil")))
    assert slug.first()[0] == "client_mary_ann_o_neil"
    slug = spark.range(1).select(sc.name_slug("client_", F.lit("Jan."), F.lit("Poe")))
    assert slug.first()[0] == "client_jan__poe"


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    assert folder == named if named else folder
    assert session.new_table_path(spark, "x") != session.new_table_path(spark, "x")
