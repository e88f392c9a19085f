"""Token counts and packing against the library on whole texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starquill.llm import packing, queries, tokens
from starquill.llm.byte_bpe import Encoder

PATH = public_tokenizers.path(queries.VOCABULARY)
ODD = ["", " ", "\n", "a", " a", "a ", "\n\n", "a  b", "a\t b", "a\t\t b", "a\n\t\tb", "a \n b",
       "x<|endoftext|>y", "a <|endoftext|> b", "<|endoftext|>", "it's we'll '", "don' t", "²½ x²",
       "a\0b c", "é ՘x, ​ y", "日本語 テキスト,です", "a\x1c b", "　a b", "Ⅷ٣ ab1,c",
       "tab\tend\t", "über, naïve! Größe.", "\r\n x\r\ny", "😀 😀😀 a😀", "᠎ a b᠎ c"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_library(library, texts):
    encode = Encoder(PATH)
    for text in [*ODD, "".join(ODD), " ".join(ODD), *texts.values()]:
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == library(text), text[:80]
        words, ids = encode.pieces(text)
        assert "".join(words) == text and b"".join(ids) == encode.ids(text)


def test_encoder_on_many_letters(library):
    encode = Encoder(PATH)
    rng = random.Random(5)
    points = [*range(1, 0x600), *rng.sample(range(0x600, 0xD800), 2500),
              *rng.sample(range(0xE000, 0x20000), 1500)]
    for c in map(chr, points):
        text = f"a{c}1 {c}{c} b{c}, ab{c}\n{c}"
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == library(text), hex(ord(c))


def test_counts(spark, sf_dir, texts, library):
    got = {r["doc_id"]: r for r in queries.op4_token_counts(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for key, text in texts.items():
        assert (got[key]["n_bytes"], got[key]["n_tokens"]) == (len(text.encode()), len(library(text)))
        assert got[key]["over_limit"] == (got[key]["n_tokens"] > 512)


def test_huge_texts_are_spliced(spark, library, texts):
    rng = random.Random(3)
    joined = " ".join(texts.values())
    rows = [(i, joined[s:s + 3000 + i]) for i, s in enumerate(range(0, 60_000, 2000))]
    rows += [(100, "x" * 4000), (101, "日本語" * 2000), (102, "\n" * 3000 + "a b" + " " * 2500),
             (103, None), (104, ""), (105, "a <|endoftext|> " * 400), (None, joined[:5000]),
             (7, joined[:5000]), (7, joined[:5000]),
             (106, "".join(rng.choice("ab \n\t,.1é") for _ in range(6000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", tokens.F.lit("x"))
    got = tokens.count_tokens(df, PATH, chunk=700, overlap=24)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = Counter((k, len((t or "").encode()), len(library(t or ""))) for k, t in rows)
    assert Counter(map(tuple, got.collect())) == want
    assert tokens.count_tokens(df.limit(0), PATH).count() == 0


def check_pieces(rows, docs, library, capacity):
    """The properties of a packing; ``docs`` has distinct keys."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for key, pieces in by_doc.items():
        ids = [*library(docs[key] or ""), packing.END_ID]
        pieces.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(-(-len(ids) // capacity)))
        at = 0
        for p in pieces:
            part = ids[p["start"]:p["start"] + p["length"]]
            assert p["start"] == at and len(part) == p["length"]
            assert p["piece"] == 0 or p["length"] == capacity
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark, sf_dir, texts, library):
    rows = queries.op5_best_fit_packing(spark, sf_dir).collect()
    used = check_pieces(rows, texts, library, 1024)
    lengths = Counter(r["length"] for r in rows)
    plan = packing.place(lengths)
    assert used == plan.n_sequences
    assert plan.bound - 1e-6 <= used <= 1.03 * plan.bound + 1


def test_packing_odd_rows(spark, library):
    rows = [(None, "a b c"), (1, None), (2, ""), (3, "word " * 300), (4, "x"), (5, "y z " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", packing.F.lit(0))
    got = packing.pack(df, PATH, capacity=64, with_ids=True).collect()
    check_pieces(got, dict(rows), library, 64)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    twice = packing.pack(df.union(df), PATH, capacity=64).collect()
    assert len(twice) == 2 * len(got)
    assert len({(r["sequence_id"], r["offset"]) for r in twice}) == len(twice)
    assert packing.pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("low, high, n", [(1, 64, 500), (20, 64, 300), (33, 64, 50), (5, 6, 1000)])
def test_plan_holds_the_demand(low, high, n):
    rng = random.Random(n)
    counts = Counter(rng.randint(low, high) for _ in range(n))
    demand = np.zeros(65, np.int64)
    for size, c in counts.items():
        demand[size] = c
    solution, bound = packing.solve(demand)
    held = np.zeros(65)
    for config, amount in solution.items():
        assert sum(config) <= 64
        for s in config:
            held[s] += amount
    assert (held >= demand - 1e-6).all()
    got = np.zeros(65, np.int64)
    for config, copies in packing.rounded(solution, demand):
        assert sum(config) <= 64 and copies > 0
        for s in config:
            got[s] += copies
    assert (got == demand).all()
    assert sum(c for _, c in packing.rounded(solution, demand)) >= bound - 1e-6


def test_price_is_optimal():
    values = np.array([0, 0, 3, 4, 7, 0, 9], float)
    best, choice = packing.price(values)
    assert best[6] == 10 and sorted(packing._filling(choice, 6)) == [2, 4]
