"""Chat formatting, top-k search, HTML rendering and language-model scores."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from starquill.llm import chat, html_text, queries, scoring, top_k
from starquill.session import materialise

# -- chat formatting


def rendered(turns):
    """Text and learned spans of turns (role, text)."""
    out, spans = "", []
    for role, text in turns:
        out += f"<|im_start|>{(role or '').replace('<|', '< |')}\n"
        begin = len(out)
        out += (text or "").replace("<|", "< |") + "<|im_end|>\n"
        if role == "assistant":
            spans.append((begin, len(out)))
    return out, spans


def brute_pair(chosen, rejected):
    def order(turns):
        key = lambda v: (v is not None, v if v is not None else 0)
        return [(r, t) for _, r, t in sorted(turns, key=lambda x: (key(x[0]), key(x[1]) if x[1] is None else (True, x[1]), (x[2] is not None, x[2] or "")))]
    a, b = order(chosen), order(rejected)
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return rendered(a[:n])[0], *rendered(a[n:]), *rendered(b[n:]), n, len(a) - n, len(b) - n


CHOSEN = {
    1: [(0, "system", "be <|im_end|> kind"), (1, "user", "hi"), (2, "assistant", "hello"), (3, "user", "more")],
    2: [(0, "user", "x"), (1, "assistant", "same")],
    3: [(0, "user", None), (1, "assistant", "a")],
    4: [(0, "user", "only chosen")],
    5: [(0, "user", "long")] + [(i, "assistant", f"t{i}") for i in range(1, 12)],
    6: [(None, "user", "a"), (0, None, "b"), (0, None, "b")],
}
REJECTED = {
    1: [(0, "system", "be <|im_end|> kind"), (1, "user", "hi"), (2, "assistant", "go away")],
    2: [(0, "user", "x"), (1, "assistant", "same"), (2, "user", "y"), (3, "assistant", "z")],
    3: [(0, "user", ""), (1, "assistant", "a")],
    5: [(0, "user", "long")] + [(i, "assistant", f"t{i if i != 9 else 'x'}") for i in range(1, 12)],
    6: [(None, "user", "a"), (0, None, "b"), (0, None, "b")],
    7: [(0, "user", "only rejected")],
}


@pytest.mark.parametrize("segment_turns", [256, 2])
def test_preferences_equal_brute_force(spark, segment_turns):
    def df(sides):
        rows = [(k, *t) for k, turns in sides.items() for t in turns] + [(None, 0, "user", "x")]
        return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string").withColumn(
            "prompt", F.lit(1))
    got = {}
    rows = chat.format_preferences(df(CHOSEN), df(REJECTED), segment_turns=segment_turns).collect()
    for r in sorted(rows, key=lambda r: (r["pair_id"], r["segment"])):
        texts, spans, counts = got.setdefault(r["pair_id"], ([""] * 3, [[], []], r[-3:]))
        for i, side in enumerate(("chosen", "rejected")):
            spans[i] += [(len(texts[i + 1]) + s["start"], len(texts[i + 1]) + s["end"])
                         for s in r[f"{side}_spans"]]
        for i, part in enumerate(("prompt", "chosen", "rejected")):
            texts[i] += r[part]
        assert segment_turns > 2 or r["chosen"].count("<|im_start|>") <= 2
    assert set(got) == set(CHOSEN) & set(REJECTED)
    for key, (texts, spans, counts) in got.items():
        want = brute_pair(CHOSEN[key], REJECTED[key])
        assert (texts[0], texts[1], spans[0], texts[2], spans[1], *counts) == want, key
    empty = df({})
    assert chat.format_preferences(empty.limit(0), df(REJECTED)).count() == 0


def test_preference_query_equals_sql(spark, sf_dir, duck):
    got = queries.op1_preference_format(spark, sf_dir)
    result = duck.execute(queries.ORACLES["op1_preference_format"])
    names = [c[0] for c in result.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(result.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_conversation_has_a_row(spark, sf_dir, duck):
    rows = [(7, 0, "user", "a"), (7, 1, "assistant", "r7"), (7, 2, "user", "end"),
            (90, 0, "user", "b"), (90, 1, "assistant", "r90"), (90, 3, "assistant", None),
            (-5000, 0, "user", "c"), (-5000, 1, "assistant", "r5000"), (8, 0, "user", "silent"),
            (8, 1, "user", "still"), (None, 0, "assistant", "x")]
    schema = "conv_id long, turn long, role string, text string"
    chosen, rejected = chat.with_next_reply(spark.createDataFrame(rows, schema))
    got = {r["pair_id"]: r for r in chat.format_preferences(chosen, rejected).collect()}
    convs = {k: [r[1:] for r in rows if r[0] == k] for k in (7, 8, 90, -5000)}
    twins = {-5000: [(0, "user", "c"), (1, "assistant", "r7")], 7: [(0, "user", "a"), (1, "assistant", "")],
             90: [(0, "user", "b"), (1, "assistant", "r90"), (3, "assistant", "r5000")], 8: convs[8]}
    assert set(got) == set(twins)
    for key, twin in twins.items():
        row, want = got[key], brute_pair(convs[key], twin)
        assert (row["prompt"], row["chosen"], row["rejected"]) == (want[0], want[1], want[3]), key
        assert [tuple(x) for x in row["rejected_spans"]] == want[4], key
    assert got[8]["chosen"] == got[8]["rejected"] == ""
    nothing = chat.format_preferences(*chat.with_next_reply(spark.createDataFrame([], schema)))
    assert nothing.count() == 0

    got = queries.op1_preference_all(spark, sf_dir)
    result = duck.execute(queries.ORACLES["op1_preference_all"])
    names = [c[0] for c in result.description]
    found = sorted(map(tuple, got.select(*names).collect()))
    assert found == sorted(result.fetchall())
    assert len(found) == duck.execute("SELECT count(DISTINCT conv_id) FROM conversations").fetchone()[0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- top-k


def brute_top(rows, asks, k):
    usable = [(i, key, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, (key, v) in enumerate(rows)
              if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, key, v in usable:
        if asks(key):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), other) for j, other, w in usable
                            if j != i and len(w) == len(v))
            out += [(key, n + 1, other, -s) for n, (s, other) in enumerate(scores[:k])]
    return Counter(out)


@pytest.mark.parametrize("proven, shard_rows", [(0, 8192), (64, 40), (4, 150)])
def test_top_k_equals_brute_force(spark, monkeypatch, proven, shard_rows):
    monkeypatch.setattr(top_k, "PROVEN", proven)
    monkeypatch.setattr(top_k, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 8).round(1 + i % 3).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(300, None), (310, [float("nan")] * 8), (320, [None] * 8), (330, [float("inf")] * 8),
             (340, []), (350, [1.0, 2.0]), (360, [-1.0, 0.5]), (None, rows[0][1]), (370, [0.0] * 8),
             (20, rows[20][1]), (20, rows[21][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("x"))
    got = top_k.top_k(df, F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, got.collect())) == brute_top(rows, lambda key: key % 10 == 0, 10)
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert top_k.top_k(df, F.lit(None).cast("boolean")).count() == 0


def test_search_stops_early():
    rng = np.random.default_rng(0)
    vectors = np.floor(1024 * rng.normal(0, 0.1, (3000, 6))).astype(np.int64)
    vectors[:50] *= 4
    shard = top_k.Shard(vectors)
    for i in range(40):
        scores, members = shard.search(vectors[i], i, 10)
        exact = vectors @ vectors[i]
        exact[i] = -10**15
        best = np.lexsort((np.arange(3000), -exact))[:10]
        assert members.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()


@pytest.mark.parametrize("width, share", [(6, 0.5), (64, 0.75)])
def test_search_leaves_postings(width, share):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 1, (4000, width))
    vectors = np.floor(1024 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    shard = top_k.Shard(vectors)
    for i in range(20):
        scores, _ = shard.search(vectors[i], i, 10)
        assert scores.tolist() == sorted(np.delete(vectors @ vectors[i], i).tolist())[:-11:-1]
    assert 0 < shard.processed < share * 20 * vectors.size


def test_search_of_great_numbers_and_zeros():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-2**27, 2**27, (500, 16))
    shard = top_k.Shard(vectors)
    for query in (vectors[3], vectors[4] * (np.arange(16) % 3 == 0), np.zeros(16, np.int64)):
        scores, members = shard.search(query, 3, 10)
        exact = [(-int(s), i) for i, s in enumerate(vectors @ query) if i != 3]
        assert list(zip((-scores).tolist(), members.tolist())) == sorted(exact)[:10]


# -- HTML


class Plain(HTMLParser):
    """Words of the visible text, without a tree: enough for well-nested hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.words = [], []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.HIDDEN and not (self.hidden and tag == "head"):
            self.hidden.append(tag)

    def handle_endtag(self, tag):
        if self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()

    def handle_data(self, data):
        if not self.hidden:
            self.words += re.split(r"[ \t\n\r\f]+", data)


def test_pages_keep_all_visible_words(spark, sf_dir, duck):
    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    got = {r["page_id"]: r["text"] for r in queries.op7_html_text(spark, sf_dir).collect()}
    assert set(got) == set(pages)
    for key, page in pages.items():
        plain = Plain()
        plain.feed(page)
        plain.close()
        ours = re.sub(r"(?m)^ *(- |\d+\. )", "", got[key])
        assert "".join(ours.split()) == "".join("".join(plain.words).split()), key


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain  text\n here", "plain text here"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("<head><title>t</title><body>x", "x"), ("<b>bo</b>ld <i> it</i>", "bold it"),
    ("<p hidden>no</p><p style='display: none'>no</p>yes<script>a<b</script><!-- c -->", "yes"),
    ("<ul><li>a<li>b<ol start=3><li>c</li><li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>x<td>22</table>",
     "name       n\nlong name  1\nx          22"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide cell<tr><td>e<td>f</table>",
     "a  b\n   c\nwide cell\ne  f"),
    ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"), ("x &amp; y &lt;z&gt;&nbsp;&eacute;", "x & y <z>\xa0é"),
    ("a < b <3 </nothing> c", "a < b <3 c"), ("<details><summary>s</summary>inner</details>t", "s\nt"),
    ("<details open><summary>s</summary>inner</details>", "s\ninner"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"), ("<p a='>'>x</p", "x"),
    ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"), ("<td>loose", "loose"),
    ("<nav><ul><li>a</ul></nav>b", "- a\n\nb"), ("<script>never ends", ""), ("<!-- never ends", ""),
    ("<textarea>a\n b</textarea>", "a\n b"), ("<select><option>a<option>b</select>", "a\nb"),
])
def test_layout(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<table><tbody><form><tr><td>a</td></tr></form></tbody></table>", "a"),
    ("<table><form><tr><td>a<td>b</tr></form><tr><td>cc<td>d</table>", "a   b\ncc  d"),
    ("<table><tr><form><td>a<td>b</form><tr><td>cc<td>d</table>", "a   b\ncc  d"),
    ("<table><tbody>loose<tr><td>a</td></tr>more</tbody></table>", "loose\nmore\na"),
    ("<table><tbody><div>x</div><b>y</b> z<tr><td>a</table>", "x\ny z\na"),
    ("<table><thead><tr><td>h<tbody><caption>c</caption><tr><td>a</table>", "c\nh\na"),
    ("<table><tbody><div><span><tr><td>a</td><td>b</td></tr></span></div></table>", "a  b"),
    ("<table><tfoot><tr><td>f</tfoot>s<tbody><tr>t<td>a</table>u", "s\nt\na\nf\n\nu"),
    ("<table><colgroup><col><col><tr><td>a<td>b</table>", "a  b"),
    ("<table><colgroup>s<tbody><td>a<td>b</table>", "s\na  b"),
    ("<table><tbody hidden>no<tr><td>no</tbody><tr hidden><td>no<tr><td>a</table>", "a"),
    ("<table><tr><td>a<template><tr><td>no</template><td>b</table>", "a  b"),
    ("<table><tbody><p hidden>no</p><script>no</script><tr><td>a</table>", "a"),
])
def test_tables_keep_stray_content(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ('<a href="x"">link</a><b class="y">z', "linkz"), ("<a title=don't>text</a> it's", "text it's"),
    ("<p a='>' b = \">\" c=x>y", "y"), ('<p "a>b" c>d', 'b" c>d'), ("<p =\"x>y\">z", 'y">z'),
    ("<p a=>b", "b"), ("<p a=b'c'>d</p ' >e", "d\n\ne"), ("<p/a='b>'/>c", "c"),
    ("<p hidden\">yes", "yes"), ("<p style='display:none'hidden>no</p>yes", "yes"),
    ("x<b a='never ends>y", "x"), ("<a\xa0b>c", "c"),
])
def test_quotes_open_values_only(page, text):
    assert html_text.visible_text(page) == text


@pytest.mark.parametrize("tag", ["font", "b", "span", "div"])
@pytest.mark.parametrize("deep", [10, 149, 150, 3000])
def test_depth_changes_nothing(tag, deep):
    page = ("<p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f<tr><td>gg<td>h</table><i>i</i>"
            f"<div hidden>no<{tag}>no</{tag}>no</div><div style='display:none'><div>no</div>no</div>"
            "<pre>j\n  <b>k</b></pre><ol start=4><li>l</ol>m")
    assert html_text.visible_text(f"<{tag}>" * deep + page) == html_text.visible_text(f"<{tag}>" + page)
    assert html_text.visible_text(f"<{tag}>" * deep + f"x</{tag}>" * deep).count("x") == deep


def test_deep_pages_end():
    n = 20_000
    assert html_text.visible_text("<b>" * n + "<p>x</i></p>" * n).count("x") == n
    assert html_text.visible_text("<p><table><b>" + "<b>" * n + "x</p>" * n).count("x") == n
    assert html_text.visible_text("<table><tr><td>" * 2000 + "x").strip() == "x"
    assert html_text.visible_text("<pre>" + "<b>" * n + "x") == "x"
    assert html_text.visible_text("<ul><li>x" * 2000).count("- x") == 2000
    assert html_text.visible_text("<ul><li>" * 2000 + "x") == "- " * 2000 + "x"
    assert html_text.visible_text("<blockquote>x" * 2000).count("x") == 2000


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, None), (2, ""), (None, "<p>x"), (3, deep), (3, deep), (4, "<td>" * 3000 + "y"),
            (5, "<a b='" * 2000), (6, "w " * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1))
    got = [(r["page_id"], r["text"]) for r in html_text.extract(df).collect()]
    assert got[:5] == [(1, None), (2, ""), (None, "x"), (3, "deep"), (3, "deep")]
    assert got[5][1] == "y" and len(got[7][1]) == 599_999
    assert html_text.extract(df.limit(0)).count() == 0


# -- language-model scores


def words(text):
    return [*(text or "").encode().lower().split(), None]


def brute_scores(rows, held, order, prior):
    counts = [Counter() for _ in range(order + 1)]
    texts = 0
    for (key, text), away in zip(rows, held):
        if away:
            continue
        texts += 1
        tokens = ["^"] * (order - 1) + words(text)
        for i in range(order - 1, len(tokens)):
            for n in range(1, order + 1):
                counts[n][tuple(tokens[i - n + 1:i + 1])] += 1
    total, distinct = sum(counts[1].values()), len(counts[1])
    out = []
    for (key, text), away in zip(rows, held):
        tokens = ["^"] * (order - 1) + words(text)
        base = score = 0.0
        known = 0
        for i in range(order - 1, len(tokens)):
            c = counts[1][tuple(tokens[i:i + 1])]
            p = (c + 1) / (total + distinct + 1)
            base += math.log10(p)
            known += c > 0
            for n in range(2, order + 1):
                before = tuple(tokens[i - n + 1:i])
                seen = texts if set(before) == {"^"} else counts[n - 1][before]
                p = (counts[n][tuple(tokens[i - n + 1:i + 1])] + prior * p) / (seen + prior)
            score += math.log10(p)
        out.append((key, bool(away), len(words(text)), known, total, round(base, 6), round(score, 6)))
    return Counter(out)


@pytest.mark.parametrize("order, block_bytes, bucket_keys", [(1, 1 << 20, 1 << 20), (2, 300, 50), (3, 2000, 100)])
def test_scores_equal_brute_force(spark, monkeypatch, order, block_bytes, bucket_keys):
    monkeypatch.setattr(scoring, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(scoring, "BUCKET_KEYS", bucket_keys)
    rng = random.Random(order)
    vocabulary = ["the", "The", "über", "Ä", *[f"w{i}" for i in range(30)]]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(30)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "the w1\tw2"), (5, "the the"), (5, "the the"), (62, "\x1cx y")]
    held = [i % 4 == 1 for i in range(len(rows))]
    df = spark.createDataFrame([(*r, h) for r, h in zip(rows, held)], "doc_id long, text string, h boolean")
    got = scoring.score_texts(df.withColumn("score", F.lit(1)), F.col("h"), order, 2.5).collect()
    assert Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got) == brute_scores(rows, held, order, 2.5)
    nothing = scoring.score_texts(df, F.lit(True), order).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in nothing} == {(0, 0, 0.0)}
    assert scoring.score_texts(df.limit(0), F.col("h"), order).count() == 0


def test_probabilities_of_a_state_sum_to_one():
    """Over all known tokens and one unknown, after every kind of state."""
    counts = [np.array([5, 3, 2, 0]), np.array([2, 1, 0])]  # of tokens, of pairs
    total = 0.0
    for token, pair in ((0, 0), (1, 1), (2, 2), (3, 2)):    # after token 1, seen 3 times
        grams = [np.array([1, token]), np.array([2, pair])]
        chance, _ = scoring.traverse(grams, counts, np.array([0]), 10, 3, 4, 1.5)
        total += 10 ** chance[1]
    assert abs(total - 1) < 1e-12


@pytest.mark.parametrize("piece", [1, 2, 5, 1000])
@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_walk_equals_counting(monkeypatch, order, piece):
    """Pieces of any length, against the recursion over the counts of each token."""
    monkeypatch.setattr(scoring, "PIECE", piece)
    rng = np.random.default_rng(order)
    texts = [[*rng.integers(0, 6, rng.integers(0, 40)).tolist(), -1] for _ in range(40)]
    trains = [i % 3 > 0 for i in range(40)]
    seen = Counter()

    def before(text, i, width):
        return tuple(([-2] * order + text)[i + order - width:i + order])
    for text, counts_ in zip(texts, trains):
        for i, token in enumerate(text):
            for width in range(order):
                seen[before(text, i, width) + (token,)] += counts_
                seen["before", before(text, i, width)] += counts_
    grams, counts = [], []
    for width in range(order):
        all_ = [before(text, i, width) + (token,) for text in texts for i, token in enumerate(text)]
        names = sorted(set(all_))
        grams.append(np.array([names.index(g) for g in all_]))
        counts.append(np.array([seen[g] for g in names]))
    n_tokens, n_distinct = int(counts[0].sum()), int((counts[0] > 0).sum())
    lengths = [len(t) for t in texts]
    starts = np.cumsum([0, *lengths[:-1]])
    chance, lowest = scoring.traverse(grams, counts, starts, n_tokens, n_distinct, sum(trains), 1.5)
    at = 0
    for text in texts:
        for i, token in enumerate(text):
            want = (seen[(token,)] + 1) / (n_tokens + n_distinct + 1)
            assert abs(lowest[at] - math.log10(want)) < 1e-12
            for width in range(1, order):
                context = before(text, i, width)
                want = (seen[context + (token,)] + 1.5 * want) / (seen["before", context] + 1.5)
            assert abs(chance[at] - math.log10(want)) < 1e-9
            at += 1


def test_score_query(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in queries.op9_lm_scores(spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    held = [zlib.crc32(str(k).encode()) % 7 == 2 for k in texts]
    want = brute_scores(list(texts.items()), held, scoring.ORDER, scoring.PRIOR)
    assert Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in rows.values()) == want
    away = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in away) > sum(r["base_score"] for r in away)


def test_squeezed_arrays_return():
    for kind in (np.uint64, np.uint32, np.int64):
        values = np.random.default_rng(3).integers(0, 10**9, 1000).astype(kind)
        assert (scoring.unsqueeze(scoring.squeeze(values), kind) == values).all()


def test_questions_of_a_width_are_gone_before_the_next(spark, monkeypatch):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    widths, others = [], set()

    def shuffles():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().toString()))

    def spied(df, label):
        others.update(shuffles())
        written = materialise(df, label)
        for _ in range(100):  # files are deleted in the background
            if not (left := shuffles() - others):
                break
            time.sleep(0.1)
        found = written.filter("block IS NOT NULL").select("width").distinct().collect()
        widths.append((sorted(r[0] for r in found), left))
        return written

    monkeypatch.setattr(scoring, "materialise", spied)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key, None)
    df = spark.createDataFrame([(1, "a b a b c"), (2, "b a b"), (3, None)], "doc_id long, text string")
    scoring.score_texts(df, F.lit(False), 3)
    assert widths == [([1], set()), ([2], set()), ([3], set())]
    assert spark.conf.get(key, None) == kept
