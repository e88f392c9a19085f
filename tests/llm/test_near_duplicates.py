"""The n-gram Jaccard join and connected components against brute force."""

from __future__ import annotations

import os
import random
import re
import time
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starquill.llm import near_duplicates, queries
from starquill.llm.components import connected
from starquill.session import discard, materialise


def shingle_set(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    size = min(words, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def least(values):
    known = [v for v in values if v is not None]
    return min(known) if known else None


def brute(rows, words, percent):
    """Set size and component id of each row."""
    sets = [shingle_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    return [(key, len(s), least(groups[find(i)])) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at:at + rng.randrange(2)] = [f"new{rng.randrange(10**6)}"] * rng.randrange(3)
    return words


def made_rows(seed, n_bases=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for base in range(n_bases):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 8, 40, 90, 400, 900)))]
        if base % 3 == 0:
            words += passage
        for _ in range(rng.randrange(1, 12)):
            copy = edited(rng, words, rng.randrange(0, 1 + len(words) // 25)) if len(words) > 9 else words
            rows.append((rng.randrange(10**6), rng.choice((" ", "\n", " \t")).join(copy)))
    rows += [(7, None), (7, ""), (8, " \n\t"), (None, rows[0][1]), (None, None), (None, "solo text here now"),
             (9, "A b"), (10, "a B"), (11, "É b"), (12, "é b"), rows[1], rows[1], (13, "x " * 200),
             (14, "x " * 300)]
    return rows


@pytest.mark.parametrize("words, percent, tile_rows, crowded", [
    (4, 85, 1024, 2), (5, 80, 8, 0), (2, 50, 1024, 0.2), (3, 100, 4, 2)])
def test_components_equal_brute_force(spark, monkeypatch, words, percent, tile_rows, crowded):
    monkeypatch.setattr(near_duplicates, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(near_duplicates, "CROWDED", crowded)
    rows = made_rows(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    got = near_duplicates.near_duplicates(docs, words, percent)
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows, words, percent))


def test_one_of_each_group_stays(spark):
    rows = made_rows(99)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n": F.lit("x"), "_other": F.length("text")})
    got = near_duplicates.distinct_documents(docs, 5, 80)
    assert got.columns == docs.columns
    want = Counter()
    seen = set()
    for (key, text), (_, n, component) in zip(rows, brute(rows, 5, 80)):
        if not n:
            want[key] += 1
        elif (component, n if component is None else 0) not in seen:
            seen.add((component, n if component is None else 0))
            want[component] += 1
    assert Counter(r["doc_id"] for r in got.collect()) == want


def test_query_equals_sql(spark, sf_dir, duck):
    got = queries.op2_ngram_jaccard(spark, sf_dir)
    want = duck.execute(queries.ORACLES["op2_ngram_jaccard"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("words, percent, tile_rows", [(4, 85, 1024), (2, 50, 8)])
def test_links_equal_brute_force(spark, monkeypatch, words, percent, tile_rows):
    monkeypatch.setattr(near_duplicates, "TILE_ROWS", tile_rows)
    rng = random.Random(words)
    base = [f"v{rng.randrange(500)}" for _ in range(200)]
    crowd = [(2000 + i, " ".join(edited(rng, base, 2))) for i in range(40)]  # near copies
    rows = made_rows(words) + crowd
    sets = [frozenset(shingle_set(t, words)) for _, t in rows]

    def similar(x, y):
        return bool(x & y) and 100 * len(x & y) >= percent * len(x | y)
    pairs, members = near_duplicates.links(spark.createDataFrame(rows, "doc_id long, text string"), words, percent)
    members = members.collect()
    want = [sum(similar(x, y) for j, y in enumerate(sets) if i != j) for i, x in enumerate(sets)]
    assert Counter((r["doc_id"], r["n_shingles"], r["n_links"]) for r in members) == Counter(
        (key, len(x), n) for (key, _), x, n in zip(rows, sets, want))
    heads = {x: least([key for (key, _), y in zip(rows, sets) if x == y]) for x in sets if x}
    distinct = list(heads)
    expected = Counter(frozenset((heads[x], heads[y])) for i, x in enumerate(distinct)
                       for y in distinct[:i] if similar(x, y))
    got = pairs.collect()
    assert Counter(frozenset((r["doc_id"], r["other_id"])) for r in got) == expected
    size = Counter(r["set_id"] for r in members if r["set_id"] is not None)
    assert len(size) == len(distinct) and all(r["set_id"] < r["other_set"] for r in got)
    assert (sum(n * (n - 1) // 2 for n in size.values())
            + sum(size[r["set_id"]] * size[r["other_set"]] for r in got)) == sum(want) // 2


def test_links_equal_sql(spark, sf_dir, duck):
    got = queries.op2_ngram_links(spark, sf_dir)
    want = duck.execute(queries.ORACLES["op2_ngram_links"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates.near_duplicates(docs).count() == 0
    assert near_duplicates.distinct_documents(docs).count() == 0


@pytest.mark.parametrize("times", [1, near_duplicates.WIDER])
def test_bitmaps_bound_the_difference(times):
    rng = np.random.default_rng(2)
    for n in (1, 30, 200, 700, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.r_[a[: n // 2], rng.integers(0, 2**63, n // 3 + 1).astype(np.uint64)])
        x, y = (np.frombuffer(near_duplicates.bitmap(s, times), np.uint64) for s in (a, b))
        size = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
        apart = int(np.bitwise_count(x ^ y).sum())
        assert (len(a) + len(b) - apart) // 2 >= len(np.intersect1d(a, b))


@pytest.mark.parametrize("parts, buckets, percent", [(1, 1, 85), (4, 7, 80), (30, 64, 50)])
def test_shared_prefixes(parts, buckets, percent):
    rng = np.random.default_rng(parts)
    hot = rng.integers(0, 2**63, 40).astype(np.int64)
    nodes = []
    for node in range(120):
        own = rng.integers(-2**63, 2**63, rng.integers(0, 9), dtype=np.int64)
        prefix = np.unique(np.r_[own, rng.choice(hot, rng.integers(0, 4)), hot[:node % 3 == 0]])
        nodes.append((node << 33, int(rng.integers(1, 60)), prefix.tolist()))
    schema = pa.schema({"node": pa.int64(), "n": pa.int32(), "prefix": pa.list_(pa.int64())})
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in nodes[i::parts]], schema)
               for i in range(parts)]
    dealt = pa.Table.from_batches([near_duplicates._deal([b], buckets) for b in batches])
    got = near_duplicates._shared(dealt.sort_by("bucket"), percent).to_pylist()
    holders = {}
    for node, n, prefix in nodes:
        for key in prefix:
            holders.setdefault(key, []).append((node, n))
    more = Counter(frozenset(h) for h in holders.values() if len(h) > 2)
    pairs = {tuple(sorted(node for node, _ in h)) for h in holders.values()
             if len(h) == 2 and 100 * min(h[0][1], h[1][1]) >= percent * max(h[0][1], h[1][1])}
    found = {}
    for row in got:
        if row["partner"] is None:
            found.setdefault(row["key"], []).append((row["node"], row["n"]))
    assert all(len(set(h)) == len(h) for h in found.values())
    assert Counter(map(frozenset, found.values())) == more
    assert {(r["node"], r["partner"]) for r in got if r["partner"] is not None} == pairs


def test_nothing_to_deal():
    batch = pa.RecordBatch.from_pydict({"node": pa.array([5], pa.int64()), "n": pa.array([0], pa.int32()),
                                        "prefix": pa.array([[]], pa.list_(pa.int64()))})
    dealt = near_duplicates._deal([batch], 4)
    assert dealt.num_rows == 0
    assert near_duplicates._shared(pa.Table.from_batches([dealt]), 80).num_rows == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    edges += [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if (root[a], root[b]) != (low, low):
                root[a] = root[b] = low
                changed = True
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}


@pytest.fixture
def written(spark, monkeypatch):
    """Label, folder, columns, number of rows and shuffle files left of each table that is written."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tables, others = [], set()

    def shuffles():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().toString()))

    def spied(df, label):
        others.update(shuffles())
        table = materialise(df, label)
        for _ in range(100):  # files are deleted in the background
            if not (left := shuffles() - others):
                break
            time.sleep(0.1)
        folders = {os.path.dirname(unquote(urlparse(f).path)) for f in table.inputFiles()}
        tables.append((label, folders, set(table.columns), table.count(), left))
        return table

    monkeypatch.setattr(near_duplicates, "materialise", spied)
    return tables


def small_run(seed, tries=4000):
    """Five words whose shingle comes early in the order of hashes."""
    rng = random.Random(seed)
    found = [" ".join(f"r{rng.randrange(10**6)}" for _ in range(5)) for _ in range(tries)]
    return min(found, key=lambda run: int(near_duplicates.shingles(run.encode(), 5)[0]))


@pytest.mark.parametrize("crowded", [near_duplicates.CROWDED, 10**6])
def test_sets_of_unrelated_documents_do_not_move(spark, monkeypatch, written, crowded):
    monkeypatch.setattr(near_duplicates, "CROWDED", crowded)
    rng = random.Random(4)
    run = small_run(1).split()
    rows = [(i, " ".join([*run, *(f"w{rng.randrange(10**9)}" for _ in range(255))]))
            for i in range(80)]  # 256 shingles and 128 bits each: about one pair in eight passes
    rows.append((80, rows[3][1] + " more"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = near_duplicates.distinct_documents(docs, 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(80))
    rows = {label: n for label, _, _, n, _ in written}
    assert rows["first-pairs"] > 20
    assert rows["sets"] == 2


def test_what_is_read_no_more_is_gone(spark, written):
    docs = spark.createDataFrame(made_rows(3), "doc_id long, text string")
    kept = near_duplicates.distinct_documents(docs, 5, 80)
    assert {"prefix", "hashes", "key"} <= set().union(*(columns for _, _, columns, _, _ in written))
    assert not [label for label, folders, columns, _, _ in written
                if columns & {"prefix", "hashes", "key", "fine"} and any(map(os.path.exists, folders))]
    assert [label for label, _, _, _, left in written if left] == []
    assert kept.count() == kept.count() > 0  # what it still reads is there


def test_only_own_tables_are_discarded(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/input")
    with pytest.raises(ValueError):
        discard(spark.read.parquet(f"{tmp_path}/input"))
    assert spark.read.parquet(f"{tmp_path}/input").count() == 3


def test_difference_of_pairs_is_a_lower_bound():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 60, 130, 250, 300, 900)]
    pairs = [(x, np.r_[x[::2], y[::3]]) for x in sets for y in sets]
    maps = [[near_duplicates.bitmap(np.unique(s), near_duplicates.FINER) for s in side]
            for side in zip(*pairs)]
    assert len({(len(x), len(y)) for x, y in zip(*maps)}) > 5
    apart = near_duplicates._apart(*maps)
    assert all(0 < n <= len(np.setxor1d(x, y)) for n, (x, y) in zip(apart, pairs) if len(np.setxor1d(x, y)))
    assert (near_duplicates._apart(maps[0], maps[0]) == 0).all()
    assert len(near_duplicates._apart([], [])) == 0
