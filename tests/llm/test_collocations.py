"""Phrase collocations against counting every phrase: ranks and hashes, dense and sparse tiles, seeds, the query and its edge cases."""

import random

import numpy as np
import pytest

from pednet.llm import collocations
from pednet.llm.queries import queries
from tests.llm.brute import collocations as brute

MIDDLE = "/root/testdata/sf0.01"


def texts(n, seed=2):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "日本", "a-b", "x'y"] + [f"w{i}" for i in range(30)]
    fixed = ["New York City hall", "in spite of", "la la la la la la", "ad hoc"]
    out = []
    for i in range(n):
        w = [r.choice(fixed) if r.random() < 0.2 else r.choice(vocabulary) + r.choice(["", "", "", ",", ".", "!\n", "\t", "  ", "\r\n", ": ;"]) for _ in range(r.randrange(0, 60))]
        out.append((r.choice(["en", "fr", "und", None, ""]), " ".join(w)))
    return out + out[:7] + [(None, None), ("en", ""), ("en", " \n "), ("fr", "la " * 5000), (None, "." * 1000)]


@pytest.mark.parametrize("ranks, held, words", [(1 << 20, 1 << 21, 1 << 19), (9, 300, 20), (1, 1 << 21, 10), (0, 500, 1 << 19)])
def test_brute(spark, monkeypatch, ranks, held, words):
    for name, value in (("RANKS", ranks), ("HELD", held), ("WORDS", words)):
        monkeypatch.setattr(collocations, name, value)
    rows = texts(150)
    docs = spark.createDataFrame([(x, t, "p", 1) for x, t in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = sorted(tuple(r) for r in collocations.best(collocations.phrases(docs, least=8, longest=4), 25).collect())
    assert got == brute(rows, least=8, longest=4, top=25) and len(got) > 20


@pytest.mark.parametrize("tile, dense", [(512, 1 / 16), (16, 0.1), (64, 0), (512, 1e9)])
def test_tiles(monkeypatch, tile, dense):
    """Dense and sparse counts are those of all pairs."""
    monkeypatch.setattr(collocations, "TILE", tile)
    monkeypatch.setattr(collocations, "DENSE", dense)
    rng = np.random.default_rng(1)
    big = collocations.HASHED + rng.integers(0, 5, 100)
    x = np.concatenate([rng.integers(0, 40, 200_000), rng.integers(0, 10**6, 5000), big, rng.integers(0, 9, 100)])
    y = np.concatenate([rng.integers(500, 530, 200_000), rng.integers(0, 10**6, 5000), rng.integers(0, 9, 100), big])
    got = collocations.tiles(x, y)
    u, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    assert sorted(zip(*(c.tolist() for c in got), strict=True)) == sorted(zip(*u.tolist(), n.tolist(), strict=True))


def test_colliding_hashes(spark, monkeypatch):
    """A hash that a frequent word shares is seen, and another seed is taken."""
    rows = [(1, "en", "a", 5), (1, "en", "a", 4), (1, "fr", "b", 1), (2, "en", "c", 20), (3, "en", "d", 1), (3, "fr", "e", 2), (4, "fr", "f", 3)]
    got = {tuple(r) for r in collocations.settled(spark.createDataFrame(rows, "p long, lang string, word string, n long"), 10).select("p", "lang", "words", "n").collect()}
    assert {(p, words, n) for p, _, words, n in got if p} == {(1, 2, 10), (2, 1, 20)}
    assert {x for x in got if x[0] is None} == {(None, "en", 1, 1), (None, "fr", 1, 5)}
    count, seeds = collocations.count_words, []

    def first_fails(docs, least, seed):
        seeds.append(seed)
        return collocations.common.written(count(docs, least, seed).withColumn("words", collocations.F.lit(2 if seed == 0 else 1)), "words")

    monkeypatch.setattr(collocations, "count_words", first_fails)
    text = [("en", "one two three " * 20)]
    assert sorted(tuple(r) for r in collocations.best(collocations.phrases(spark.createDataFrame(text, "lang string, text string"), least=5)).collect()) == brute(text, least=5)
    assert seeds == [0, 1]


def test_large_numbers(spark):
    row = ("en", "p q", 3 * 10**12, 10**13, [3 * 10**12 + 1], [3 * 10**12 + 7])
    df = spark.createDataFrame([row], "lang string, phrase string, a long, n long, pre array<long>, suf array<long>")
    assert collocations.scores(df).first()["score"] == 1000 * row[2] * row[3] // (row[4][0] * row[5][0])


def test_query(spark):
    df = queries()["op11_collocations"](spark, MIDDLE)
    assert df.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in df.collect()) == brute(rows)


def test_none(spark):
    docs = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    for df in (docs, docs.limit(0)):
        assert collocations.phrases(df).collect() == []
    got = collocations.phrases(spark.createDataFrame([("en", "a b. c " * 9)], "lang string, text string"), least=9).collect()
    assert [tuple(r)[:3] for r in got] == [("en", "a b", 9)]
