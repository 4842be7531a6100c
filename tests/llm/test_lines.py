"""Line dedup against all pairs compared one by one, and its parts by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pednet.llm import common, lines
from tests.conftest import SMALL


def brute(rows):
    """(id, nth) of the lines kept: all pairs of different normal forms are compared."""
    first = {}
    for i, text in rows:
        for nth, line in enumerate((text or "").split("\n")):
            if norm := lines.normal(line):
                first[norm] = min(first.get(norm, (i, nth)), (i, nth))
    forms = sorted(first)
    sets, done = [lines.shingle_set(x) for x in forms], common.Sets(len(forms))
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i and 5 * len(sets[j]) >= 4 * len(s) and 5 * len(s) >= 4 * len(sets[j])}:
            if lines.similar(s, sets[j]):
                done.join(i, j)
    best = {}
    for i, x in enumerate(forms):
        c = done.find(i)
        best[c] = min(best.get(c, first[x]), first[x])
    return set(best.values())


def variants(r, n, words=30, edits=1):
    base = [f"{r.choice('abcdefgh')}{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = base.copy()
        for i in r.sample(range(words), edits):
            w[i] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def kept(df):
    return {(r["id"], k) for r in lines.kept_lines(df).collect() for k in r["kept"]}


def test_equals_brute_force_on_real_texts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").where("length(text) < 20000")
    want, got = brute([tuple(r) for r in docs.collect()]), kept(docs)
    assert len(want ^ got) <= 0.005 * len(want)


@pytest.mark.parametrize("small", [False, True])
def test_families(spark, monkeypatch, small):
    """Families of near copies; small: blocks, ranges and hot keys so small that every way through the operator is taken."""
    if small:
        for name, value in (("BLOCK", 8), ("HOT", 3), ("RANGE", 64), ("SALTS", 2), ("HELD", 50)):
            monkeypatch.setattr(lines if name == "BLOCK" else common, name, value)
    r = random.Random(4)
    texts = [x for n in (2, 3, 40, 90) for x in variants(r, n)] + variants(r, 60, edits=2) + [" ".join(f"u{r.randrange(10**9)}" for _ in range(20)) for _ in range(60)]
    r.shuffle(texts)
    df = spark.createDataFrame([(i, "\n".join(texts[i : i + 4])) for i in range(0, len(texts), 4)], "doc_id long, text string").repartition(3)
    want, got = brute([tuple(x) for x in df.collect()]), kept(df)
    assert len(want) < len(texts) - 60 and len(want ^ got) <= 2


def test_recall_of_bands():
    r = random.Random(7)
    for length in (40, 150, 600):
        hit = n = 0
        while n < 400:
            a = "".join(r.choice("abcdefghij ") for _ in range(length))
            b = list(a)
            for _ in range(max(1, round(0.02 * length))):
                b[r.randrange(length)] = r.choice("klmnop")
            x, y = lines.shingle_set(a), lines.shingle_set("".join(b))
            if 0.8 <= len(x & y) / len(x | y) < 0.84:
                _, sig = lines.bands([a, "".join(b)])
                hit, n = hit + bool((sig[0] == sig[1]).any()), n + 1
        assert hit / n >= 0.98


def test_overlaps_and_pairs_equal_sets():
    r = random.Random(3)
    texts = variants(r, 30, words=12, edits=5) + ["abc", "abcde", "abcdeabcde", "日本語日本語日本語", "éé éé éé éé", ""] + variants(r, 400, words=14, edits=1)
    shingle, first = lines.shingles_of(texts)
    sets = [lines.shingle_set(x) for x in texts]
    assert np.diff(first).tolist() == [len(s) for s in sets]
    both = lines.overlaps(shingle, first)
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(len(texts)) for j in range(len(texts)) if i != j)
    part = lines.overlaps(shingle, first[10:20])
    assert (part == both[10:19, 10:19])[~np.eye(9, dtype=bool)].all()
    at = np.array([0, 7, 30, 33, 35, 40, 200, 431])
    want = [i for i in at.tolist() if lines.similar(sets[i], sets[i + 1])]
    assert lines.pairs_of(texts, shingle, first, at).tolist() == want and len(lines.pairs_of(texts, shingle, first, at[:0])) == 0
    to = lines.joined(texts, np.arange(len(texts)), shingle, first)
    done = common.Sets(len(texts))
    for i in range(len(texts)):
        for j in range(i):
            if lines.similar(sets[i], sets[j]):
                done.join(max(done.find(i), done.find(j)), min(done.find(i), done.find(j)))
    assert to.tolist() == [done.find(i) for i in range(len(texts))]


def test_lines_edge_cases(spark):
    a = " ".join(f"word{i}" for i in range(30))
    data = [(None, a, 1), (3, None, 2), (2, "", 3), (7, f"{a}\n\n \t\nab", 4), (7, f"{a}\n\n \t\nab", 5), (7, "ab\x00cd ef", 6), (1, f"x{a}", 7), (9, "\n".join([a] * 300), 8)]
    df = spark.createDataFrame(data, "doc_id long, text string, bands int").withColumnRenamed("bands", "root")
    got = {(r["id"], r["n_lines"]): r["kept"] for r in lines.kept_lines(df).collect()}
    assert got == {(None, 1): [0], (7, 2): [3], (7, 1): [0], (1, 1): [], (9, 300): []}
    out = lines.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect() if r["text"]) == [(0, a), (7, "\n \t\nab"), (7, "\n \t\nab"), (7, "ab\x00cd ef")]


def test_bands_of_nothing():
    which, sig = lines.bands(["", "abc"])
    assert len(which) == 0 and sig.shape == (0, lines.BANDS)
    which, _ = lines.bands(["abc", "abcdef", "", "ghijk"])
    assert which.tolist() == [1, 3] and np.array_equal(lines.codes_of(["a"])[1], np.zeros(0)) and pa.array(which.tolist()).null_count == 0


def test_whole_groups():
    r = random.Random(5)
    for _ in range(200):
        keys = sorted(r.randrange(6) for _ in range(r.randrange(1, 25)))
        cuts = sorted(r.randrange(len(keys) + 1) for _ in range(3))
        batches = [pa.record_batch([pa.array(keys[a:b], pa.int64())], names=["k"]) for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True)]
        got = [t.column("k").to_pylist()[a:b] for t, e in common.whole_groups(batches, "k") for a, b in zip(e[:-1], e[1:], strict=True)]
        assert got == [[k] * keys.count(k) for k in sorted(set(keys))]
