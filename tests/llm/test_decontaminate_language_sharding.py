"""Decontamination, language identification and sharding against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starquill.llm import decontaminate, language, queries, sharding

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, window):
    doc = words(text)
    hit, found = set(), set()
    for name, body in items:
        item = words(body)
        size = min(window, len(item))
        for s in range(len(item) - size + 1) if item else ():
            for p in range(len(doc) - size + 1):
                if doc[p:p + size] == item[s:s + size]:
                    hit.update(range(p, p + size))
                    found.add("" if name is None else str(name))
    return len(doc), len(hit), sorted(found)


ITEMS = [(1, "one two three four five"), (2, "Three FOUR five six"), (3, "é!ß x"), (4, ""), (5, None),
         (None, "a a a a"), (7, "one two three four five"), (8, "two")]
DOCS = [(1, "zero one two three four five six"), (2, None), (3, ""), (4, "One--two, three four"),
        (5, "a a a a a a b a a a a"), (6, "É!ß X é ß x"), (None, "three four five six two"),
        (8, "three four five"), (8, "three four five"), (9, "nothing here")]


@pytest.mark.parametrize("window", [3, 4, 10])
@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_matches_equal_brute_force(spark, monkeypatch, window, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("n_words", F.lit("x"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_matches(docs, items, window=window).collect()
    want = Counter((k, t, *map(str, brute_hits(t, ITEMS, window))) for k, t in DOCS)
    assert Counter((r["doc_id"], r["text"], str(r["n_words"]), str(r["n_hit"]), str(r["item_ids"]))
                   for r in found) == want
    bodies = dict(("" if k is None else str(k), words(t)) for k, t in ITEMS)
    for r in found:
        assert r["contaminated"] == (r["n_hit"] > 0)
        for m in r["matches"]:
            a, b, n = m["doc_start"], m["item_start"], m["n_words"]
            assert words(r["text"])[a:a + n] == bodies[m["item_id"]][b:b + n] and n > 0
    kept = decontaminate.decontaminate(docs, items, window=window)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        k for k, t in DOCS if not brute_hits(t, ITEMS, window)[1])
    assert decontaminate.find_matches(docs.limit(0), items).count() == 0
    assert {r["n_hit"] for r in decontaminate.find_matches(docs, items.limit(0)).collect()} == {0}


def brute_matches(text, items, window):
    doc, best = words(text), {}
    for name, body in items:
        item = words(body)
        for p in range(len(doc)):
            for s in range(len(item)):
                n = 0
                while p + n < len(doc) and s + n < len(item) and doc[p + n] == item[s + n]:
                    n += 1
                if n >= min(window, len(item)):
                    found = (-n, "" if name is None else str(name), s)
                    best[p] = min(best.get(p, found), found)
    kept, reach = [], 0
    for p, (n, name, s) in sorted(best.items()):
        if p - n > reach:
            reach = p - n
            kept.append((name, s, p, -n))
    return kept


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_matches_are_the_longest(spark, monkeypatch, seed, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 60)
    rng = np.random.default_rng(seed)

    def text(n):
        return " ".join(rng.choice(list("abcd"), n))
    items = [(i, text(int(rng.integers(1, 25)))) for i in range(10)]
    items += [(20, items[1][1]), (20, items[2][1]), (21, "a b c d"), (22, "b c d a b d c"),
              (23, "a " * 40)]
    docs = [(i, text(int(rng.integers(0, 60)))) for i in range(20)]
    docs += [(30, "b c d a b d c"), (31, f"x {items[3][1]} y {items[4][1]}"), (32, "a " * 60 + "b " + "a " * 45),
             (33, items[5][1] + " " + items[5][1])]
    found = decontaminate.find_matches(
        spark.createDataFrame(docs, "row long, text string").withColumn("_ROW", F.lit("K")),
        spark.createDataFrame(items, "item_id long, text string"), window=5).collect()
    assert len(found) == len(docs) and {r["_ROW"] for r in found} == {"K"}
    for r in found:
        got = [(m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in r["matches"]]
        assert got == brute_matches(r["text"], items, 5), r["text"]


def test_suffixes_in_order():
    ids = [3, 1, 2, 0, 1, 2, 3, 1, 0, 2]
    starts, _ = decontaminate.suffix_array(decontaminate.np.array(ids), 1, 3, 2, 4)

    def suffix(s):
        end = ids.index(0, s) if 0 in ids[s:] else len(ids)
        return ids[s:min(end, s + 3)]
    assert sorted(starts.tolist()) == [i for i, x in enumerate(ids) if x]
    assert [suffix(s) for s in starts] == sorted(suffix(s) for s in starts)


def test_language_held_out(spark, sf_dir, duck):
    rows = queries.op8_language_id(spark, sf_dir).collect()
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert held and right / len(held) > 0.97


def test_language_scores_equal_counting(spark):
    model = language.Model(("x", "y"), language.np.log(language.np.vstack(
        [language.np.random.default_rng(1).dirichlet([1] * 256, 2).T, [[0.25, 0.75]]])), 2)
    texts = ["abc", "É fİ g", None, "", "123", "z" * 50, "Σας ΣΑΣ"]
    names, scores = language.score_batch(texts, model)
    for text, name, score in zip(texts, names, scores):
        if not text or not any(map(str.isalpha, text)):
            assert (name, score) == ("und", 0.0)
            continue
        total = model.log_p[-1].copy()
        low = text.lower()
        for n in (1, 2):
            for i in range(len(low) - n + 1):
                found = [b for b, _ in language.buckets_of([low[i:i + n]], n, 8)][-1]
                total += model.log_p[found[0]]
        share = language.np.exp(total - total.max())
        share /= share.sum()
        assert name == model.languages[total.argmax()] and abs(score - share.max()) < 1e-9


def test_language_odd_tables(spark):
    rows = [(1, "der hund und die katze", "de"), (2, None, "de"), (3, "", "en"), (4, "the dog", "en"),
            (5, "12 34", None), (None, "the cat", None), (5, "the cat", None), (5, "the cat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    model = language.fit(docs)
    assert model.languages == ("de", "en")
    got = language.identify(docs, model).collect()
    assert [r["lang_pred"] for r in got] == ["de", "und", "und", "en", "und", "en", "en", "en"]
    assert language.identify(docs.limit(0), model).count() == 0
    none = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}


def test_sharding_query(spark, sf_dir, texts):
    rows = queries.op10_sharding(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert 0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16)
        slots[r["shard"]].append(r["slot"])
    assert any(r["grown_shard"] == 16 for r in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def _assigned(spark, tree, n=20_000):
    keys = spark.range(n).select("id", sharding.assign_shard(F.col("id"), tree).alias("s"))
    return {r["id"]: r["s"] for r in keys.collect()}


def test_weights_and_movement(spark):
    tree = sharding.even_tree(8)
    before = _assigned(spark, tree)
    assert max(abs(c - 2500) for c in Counter(before.values()).values()) < 250
    heavy = tuple(sharding.replace(x, weight=3.0) if x.shard == 5 else x for x in tree)
    after = _assigned(spark, heavy)
    place = {x.shard: x for x in tree}
    changed = {k for k in before if before[k] != after[k]}
    assert changed
    for k in changed:  # only into the region, the rack or the shard whose weight changed
        old, new = place[before[k]], place[after[k]]
        assert new.region == place[5].region
        if old.region == new.region:
            assert new.rack == place[5].rack
            if old.rack == new.rack:
                assert new.shard == 5
    assert abs(Counter(after.values())[5] - 6000) < 400
    grown = _assigned(spark, sharding.add_shard(tree, sharding.Leaf(8, "region2", "rack0", 2.0)))
    assert all(grown[k] in (before[k], 8) for k in before)
    assert abs(Counter(grown.values())[8] - 4000) < 350


def test_sharding_odd_rows(spark, tmp_path):
    rows = [(None, "a"), (None, None), (1, ""), (1, "é"), (1, "é"), (2, "b" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("x"))
    tree = sharding.even_tree(4)
    got = sharding.shard_documents(df, tree, sharding.add_shard(tree, sharding.Leaf(4, "r", "k")))
    out = got.collect()
    assert sorted(r["size"] for r in out) == [1, 1, 2, 3, 3, 100_001]
    assert len({(r["shard"], r["slot"]) for r in out}) == len(rows)
    assert len({r["shard"] for r in out if r["doc_id"] is None}) == 1
    assert sharding.shard_documents(df.limit(0), tree, tree).count() == 0
    sharding.write_shards(df, str(tmp_path / "s"), tree)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows)
    with pytest.raises(ValueError):
        sharding.add_shard(tree, sharding.Leaf(3, "r", "k"))


def test_rare_labels_are_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "LEAST_ROWS", 20)
    rows = [("the cat sat on the mat %d" % (i % 7), "en") for i in range(4000)]
    rows += [("same words each time", "eq")] * 3000   # one hot text
    rows += [("der hund schläft im haus %d" % i, "de") for i in range(15)]
    rows += [("", "none"), ("", "none")] + [("", "de")] * 5000
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    model = language.fit(docs, sample_rows=400)
    assert model.languages == ("de", "en", "eq")  # a label without n-grams has no column
    names, _ = language.score_batch(["der hund im haus", "the cat on the mat", "same words"], model)
    assert names == ["de", "en", "eq"]
    # of single characters, each row of a label adds its length: the sample's sizes can be told
    model = language.fit(docs, orders=1, sample_rows=400, smoothing=1e-9)
    share = np.exp(model.log_p[:-1])
    assert np.allclose(share.sum(axis=0), 1)
    alone = language.fit(docs.filter("lang = 'de'"), orders=1, smoothing=1e-9)
    assert np.allclose(share[:, 0], np.exp(alone.log_p[:-1, 0]))  # all rows of the rare label
    assert np.allclose(np.exp(model.log_p[-1]), np.array([5015, 4000, 3000]) / 12015)


def test_equal_rows_are_picked_one_by_one(spark):
    docs = spark.createDataFrame([("aaaa", "eq")] * 5000 + [("b", "x")] * 5000, "text string, lang string")
    # with smoothing s over 2^8 buckets a column of k rows of n characters tells k
    model = language.fit(docs, orders=1, bits=8, sample_rows=1000, smoothing=1.0)
    chance = np.exp(model.log_p[:-1]).max(axis=0)
    n = (256 * chance - 1) / (1 - chance)
    for rows in (n[0] / 4, n[1]):
        assert 400 < rows < 600


@pytest.mark.parametrize("counts, total, most", [
    ([250, 10_000_000], 40_000, 39_750), ([5, 5], 100, 200), ([1000] * 1000, 40_000, 200),
    ([30_000, 30_000, 100], 40_000, 19_950), ([20_000, 20_000], 40_000, 20_000)])
def test_quota(counts, total, most):
    assert language.quota(counts, total) == most
