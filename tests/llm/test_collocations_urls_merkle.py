from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starquill.llm import collocations, merkle, queries, url_rules
from starquill.sources.inline import values
from tools.check import rows_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("key", ["op11_collocations", "op12_url_filters", "op13_merkle_manifest"])
def test_against_sql(spark, sf_dir, duck, key):
    df = queries.QUERIES[key](spark, sf_dir)
    result = duck.execute(queries.ORACLES[key])
    want = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


# phrases

def pieces_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in (re.findall(r"[^\x20\x09]+", p)
                        for p in re.split(r"[.,;:!?\x0a-\x0d]+", text)) if w]


def mined(docs, least, first):
    """The contract word for word."""
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for m in range(1, 6):
                for s in range(len(words) - m + 1):
                    counts[lang, tuple(words[s:s + m])] += 1
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    rows = {}
    for (lang, words), a in found.items():
        longer = (b for (other, more), b in found.items() if other == lang and len(more) > len(words)
                  and any(more[i:i + len(words)] == words for i in range(len(more))))
        if any(100 * b >= 100 * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append(
            (-score, -a, " ".join(words).encode(), left, right, totals[lang]))
    return sorted((lang, i, p.decode(), -a, le, ri, n, -score) for lang, own in rows.items()
                  for i, (score, a, p, le, ri, n) in enumerate(sorted(own)[:first], 1))


def phrases(df):
    return sorted(tuple(r) for r in df.collect())


def random_docs(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "c", "d\u00e9", "\u4e2d", "x'y", "\u00a0z"]
    fixed = "once upon a time there was a long line of words that is here again and again"
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(fixed if rng.random() < 0.3 else " ".join(
                rng.choices(words, weights=[9, 5, 4, 3, 2, 2, 1], k=rng.randrange(12))))
            parts.append(rng.choice([". ", ",", "\n", "\t", " ", "?!", ";  "]))
        docs.append((rng.choice(["en", "fr", None, "", "und"]), "".join(parts)))
    return docs


@pytest.mark.parametrize("seed,least", [(1, 3), (2, 1), (3, 40)])
def test_phrases_by_brute_force(spark, seed, least):
    docs = [*random_docs(seed), ("en", None), (None, None), ("en", ""), ("xx", " .,\n")]
    df = values(spark, [(t, la, "clash") for la, t in docs], "text string, lang string, phrase string")
    assert phrases(collocations.mine(df, least, 25)) == mined(docs, least, 25)


def test_phrases_of_small_blocks(spark, monkeypatch):
    """Slices, buckets and passages far smaller than their contents change nothing."""
    docs = random_docs(4)
    docs.append(("en", "la li lu " * 400))
    long_line = " ".join(f"w{i}" for i in range(300))
    docs += [("en", long_line)] * 4
    want = mined(docs, 4, 1000)
    df = values(spark, [(t, la) for la, t in docs], "text string, lang string").repartition(3)
    for name, small in (("BUCKET_KEYS", 10), ("PASSAGE_EDGES", 16), ("SALTS", 3)):
        monkeypatch.setattr(collocations, name, small)
    # tasks have the module as it stands, so what they run is called here
    edges = Counter()
    for _, text in docs:
        for part in collocations.slices((text or "").encode(), 200):
            group = collocations.words_of("x", [part])
            left = group
            for width in (2, 3):
                joined = collocations._whole(left.index, width)
                runs = collocations.cut(left.index, joined, width)
                left = collocations.reduced(left, runs)
            edges.update(collocations.edges_of(left.vocabulary, collocations.cut(
                left.index, joined=collocations._whole(left.index, 3), width=3)))
    assert edges == Counter((len(w[i:i + 5]), " ".join(w[i:i + 5]).encode()) for _, t in docs
                            for w in pieces_of(t) for i in range(len(w) - 1))
    assert phrases(collocations.mine(df, 4, 1000)) == want


def test_passages_are_compacted(spark):
    line = " ".join(f"w{i}" for i in range(40))
    docs = [("en", line)] * 3 + [("en", "w3 w4 w5 w6 w7 w8 ends")] * 2
    df = values(spark, [(t, la) for la, t in docs], "text string, lang string")
    graph = collocations.build_graph(df, 2)
    found = {(r["text"], r["n"]) for r in collocations.compact(graph.phrases).collect()}
    words = line.split()
    assert found == {(" ".join(words[0:7]), 3), (" ".join(words[3:9]), 5),
                     (" ".join(words[5:]), 3), ("w5 w6 w7 w8 ends", 2)}


def test_no_phrases(spark):
    empty = values(spark, [], "text string, lang string")
    assert collocations.mine(empty).collect() == []
    few = values(spark, [("one two", "en"), (None, None)], "text string, lang string")
    assert collocations.mine(few, 2).collect() == []
    with pytest.raises(ValueError):
        collocations.mine(few, 0)


# URLs

URLS = [
    "http://net/", "http://a.net", "http://a.net?x=/", "HTTP://A.NET/x#y", "x://example.net/en/",
    "http://www.example.net/en/1?u=://net/", "http://example.net/en", "http://example.net/EN/",
    "http://myexample.com/de/", "http://my.example.com/de/5", "http://example.com/de",
    "http://w.org/fr/", "http://org/fr/x", "http://worg/fr/", "://b.org/fr/", "net/", "", None,
    "http://net:80/", "http://me@a.net/", "http://a.net./", "http://\u00c4.net/\n/en/",
    "http://a.net//en/", "http://a.net/en/://example.net/en/"]


def judged(url, rules, default="allow"):
    at = -1 if url is None else url.find("://")
    rest = "" if at < 0 else url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = []
    for rule, verdict in rules:
        if rule is None or verdict is None or not host:
            continue
        own, own_path = re.match(r"(?s)([^/]*)(.*)", rule).groups()
        like = "[^.]*".join(map(re.escape, own.lower().split("*")))
        path_like = "(?s:.*)".join(map(re.escape, own_path.split("*")))
        if (not own or re.search(rf"(^|\.){like}\Z", host)) and re.match(path_like, path):
            fitting.append((-len(rule), rule, verdict != "block", verdict))
    best = min(fitting, default=None)
    return (host, path, best and best[1], best[3] if best else default)


@pytest.mark.parametrize("rules", [
    url_rules.RULES, (),
    (("/", "block"), ("*/en/", "allow"), ("example.*/", "block"), ("a.net", "block"),
     ("a.net", "allow"), ("Net/*/x", "allow"), ("b.(org/", "block"), (None, "block"),
     ("org/", None), ("net/en/*e", "block"))])
def test_urls_by_brute_force(spark, rules):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (3, URLS[3], "x")]
    pages = values(spark, rows, "page_id long, url string, rule string")
    got = url_rules.judge_urls(pages, url_rules.rule_table(spark, rules))
    want = [(i, *judged(u, rules)) for i, u, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_urls_fetch_by_the_rarest_token(spark):
    pages = values(spark, [(i, f"http://h{i % 3}.net/en/{i}") for i in range(30)],
                   "page_id long, url string")
    rules = url_rules.rule_table(spark, [("h1.net/en/", "block"), ("net/en/5", "block"),
                                         ("gone.net/", "block"), ("*/", "block")])
    seen = pages.select(url_rules.host_of(F.col("url")).alias("_host"),
                        url_rules.path_of(F.col("url")).alias("_path"))
    seen = seen.select(F.concat(url_rules._host_tokens(F.col("_host")),
                                url_rules._path_tokens(F.col("_path"))).alias("_tokens"))
    tokens = {(r["rule"], r["token"]) for r in url_rules.rule_index(rules, seen).collect()}
    assert {t for t in tokens if t[0] != "*/"} == {
        ("h1.net/en/", ".h1"), ("net/en/5", ".net"), ("gone.net/", ".gone")}
    assert len({t for t in tokens if t[0] == "*/"}) == url_rules.SALTS


def test_urls_need_no_python(spark):
    pages = values(spark, [(1, "http://a.net/")], "page_id long, url string")
    df = url_rules.judge_urls(pages, url_rules.rule_table(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("Python", "Arrow", "Pandas", "CartesianProduct",
                                       "BroadcastNestedLoopJoin"))
    assert url_rules.judge_urls(pages.limit(0), url_rules.rule_table(spark)).collect() == []


# manifests

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*vals):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def climbed(nodes):
    """Levels of a tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def route(levels, pos):
    """Siblings before and behind, level by level."""
    steps = []
    for level in levels[:-1]:
        first = pos // 3 * 3
        steps.append((level[first:pos], level[pos + 1:first + 3]))
        pos //= 3
    return steps


def manifested(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        touched = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        given = leaf(doc_id, source, lang, n_chars,
                     text.replace("\n", "") if touched and text is not None else text)
        trees.setdefault(source, []).append(
            ((doc_id is not None, doc_id or 0), own, given, doc_id))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: climbed([x[1] for x in sorted(trees[s], key=lambda x: x[:2])]) for s in names}
    upper = climbed([built[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for pos, (_, own, given, doc_id) in enumerate(sorted(trees[s], key=lambda x: x[:2])):
            steps = route(built[s], pos) + route(upper, at)
            node = given
            for before, behind in steps:
                node = h("".join([*before, node, *behind]))
            proof = "".join(x for before, behind in steps for x in (*before, *behind))
            out.append((doc_id, own, built[s][-1][0], upper[-1][0], h(proof), node,
                        node == upper[-1][0]))
    return sorted(out, key=repr)


def tampered():
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(touched, F.replace("text", F.lit("\n"), F.lit("")))
            .otherwise(F.col("text"))}


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4, 9, 10, 1), (2187, 2188, 3), (30,) + (2,) * 30])
def test_manifest_by_brute_force(spark, sizes):
    rows = []
    for s, size in enumerate(sizes):
        name = None if s == 0 else ["", "s", "\u00e9", "z", "n"][s] if s < 5 else f"src{s}"
        rows += [(10_000 * s + i, f"t{i}\nu\u00e9" if i % 3 else None, [None, "en"][i % 2], name, i)
                 for i in range(size)]
    rows += [(None, "a\nb", None, "s", None), rows[0], rows[0], (rows[0][0], "", None, None, 0)]
    df = values(spark, [(*r, "clash") for r in rows], DOCS + ", leaf string").repartition(3)
    got = merkle.manifest(df, tampered(), height=1 if len(sizes) > 9 else merkle.HEIGHT)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == manifested(rows)


def test_proofs_of_blocks():
    for total in (1, 2, 3, 4, 9, 10, 28, 100):
        nodes = [h(str(i)) for i in range(total)]
        levels = climbed(nodes)
        for height in (1, 2, 7):
            size = 3 ** height
            for start in range(0, total, size):
                own = nodes[start:start + size]
                inside = merkle.interiors(own, total, height)
                for i in range(len(own)):
                    steps = route(levels, start + i)
                    proof = "".join(x for b, a in steps for x in (*b, *a))
                    rest = "".join(x for b, a in steps[len(inside) - 1:] for x in (*b, *a))
                    assert merkle.expand(inside, i, rest) == proof
                    assert merkle.fold(own[i], start + i, total, proof) == (levels[-1][0],
                                                                            len(proof))
                    assert len(merkle.missing(start + i, total)) * merkle.DIGEST == len(proof)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(values(spark, [], DOCS), {}).collect() == []


def test_proofs_are_told(spark):
    df = values(spark, [(i, "t", "en", "s", 1) for i in range(5)], DOCS)
    for r in merkle.manifest(df, {}, proofs=True, height=1).collect():
        node, _ = merkle.fold(r["leaf"], r["doc_id"], 5, r["proof"])
        assert node == r["root"] == r["subroot"] and r["verified"]
        assert merkle.digest(r["proof"]) == r["proof_sha256"]
