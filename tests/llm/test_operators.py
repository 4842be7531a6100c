"""Each operator against a plain version on small fixtures: nulls, empty and long texts, ties, repeated rows, extra columns, empty tables."""

import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pednet.llm import common, jaccard, language, lines, mixing, packing, pii, quality, repair, substrings, tokens, vafile
from tests.conftest import SMALL
from tests.llm.brute import WORD, document, jaccard_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, kept boolean, score string, size int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    texts = [document(120), document(120), document(120, {5: "other"}), document(120, {i: f"x{i}" for i in range(0, 120, 9)}), document(60), None, "", " \n ", "one", "one two", "a" * 300_000, document(4000), "It's, e.g. <|endoftext|> ñandú—日本\n\n" + document(40)]
    texts += [document(80, {r.randrange(80): f"w{i}", r.randrange(80): f"v{i}"}) for i in range(20)]
    out = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "ä")[i % 4], None, 7, "x", True, "s", 3) for i, t in enumerate(texts)]
    return out + [out[0]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(name, rows):
    t = Tokenizer.from_file(tokens.tokenizer_path(name))  # as the contract names it: nothing else is set
    return [x.ids + [1] for x in t.encode_batch([t or "" for t in rows], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name, rows):
    import pyarrow as pa

    texts = [r[1] for r in rows] + ["a  b", " a", "a ", "it's  x. y\n\nz  .á. ́b é.", "x  y 　z", "É, ×. ÷. ñ."]
    texts += ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>.b <|startoftext|>, c <|endoftext|", "<|startoftext|> <|endoftext|>  z", "end.<|endoftext|>End"]
    r = random.Random(11)
    bits = ["<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", ".", ",", "'s", "a", "B", "é", "ß", "9", "日", "\u00a0", "\u0301", "!", "word", "-"]
    texts += ["".join(r.choice(bits) for _ in range(r.randrange(1, 14))) for _ in range(3000)]
    e = tokens.Encoder(tokens.tokenizer_path(name))
    for _ in range(2):  # cold, then from the table
        got, n = tokens.with_end(*e.encode(*common.utf8(pa.array(texts))))
        assert [x.tolist() for x in np.split(got, np.cumsum(n)[:-1])] == ids_of(name, texts)


def test_repair_round_trip(docs, none, rows):
    shards = repair.encode(docs, tokens.tokenizer_path("word_bpe_49k.json"))
    order = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    want, start = [], 0
    for r, ids in zip(order, ids_of("word_bpe_49k.json", [r[1] for r in order]), strict=True):
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, repair.decode(shards).collect())) == want
    flat = np.concatenate(ids_of("word_bpe_49k.json", [r[1] for r in order]))
    one = shards.orderBy("part", "shard").first()
    assert repair.decode_range(one.asDict(), 3, 40).tolist() == flat[3:43].tolist()
    assert repair.decode(repair.encode(none, tokens.tokenizer_path("word_bpe_49k.json"))).count() == 0


def test_repair_compresses_runs():
    ids = np.array([5] * 999 + [1] + [7, 8, 9] * 400 + [1], np.uint16)
    g = repair.compress(ids, np.array([1000, 2201]))
    assert len(g["symbols"]) < len(ids) / 10
    assert repair.expand(g, g["symbols"]).tolist() == ids.tolist()


def test_repair_goes_on_until_no_pair_pays():
    r = np.random.default_rng(4)
    ids = np.concatenate([r.integers(0, 40, 20_000), np.tile(r.integers(0, 1000, 37), 60), np.full(3000, 7)]).astype(np.uint16)
    ends = np.arange(97, len(ids), 97)
    ends = np.append(ends, len(ids))
    g = repair.compress(ids, ends)
    assert repair.expand(g, g["symbols"]).tolist() == ids.tolist()
    inside = np.ones(len(g["symbols"]), bool)
    inside[g["document_ends"] - 1] = False
    s, count, i = g["symbols"].tolist(), Counter(), 0
    while i + 1 < len(s):  # pairs of one symbol don't overlap
        if inside[i]:
            count[s[i], s[i + 1]] += 1
            i += s[i] == s[i + 1] and i + 2 < len(s) and s[i + 2] == s[i] and inside[i + 1]
        i += 1
    assert max(count.values()) < repair.LEAST_COUNT + 1 and len(g["left"]) > 100
    used = Counter(s) + Counter(g["left"].tolist()) + Counter(g["right"].tolist())
    assert all(used[len(g["terminals"]) + k] for k in range(len(g["left"])))


def test_packing(docs, none, rows):
    out = packing.pack(packing.cut(docs, tokens.tokenizer_path("byte_bpe_50k.json"))).collect()
    want = Counter((r[0], len(x)) for r, x in zip(rows, ids_of("byte_bpe_50k.json", [r[1] for r in rows]), strict=True))
    total = Counter()
    for r in out:
        total[(r["doc_id"], r["doc_tokens"])] += r["length"]
    assert total == Counter({k: k[1] * n for k, n in want.items()})
    by = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by.get(r["sequence_id"], 0)
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by.values()) <= packing.WINDOW
    assert packing.pack(packing.cut(none, tokens.tokenizer_path("byte_bpe_50k.json"))).count() == 0


def test_plan_uses_up_the_histogram():
    h = np.zeros(257, np.int64)
    h[[256, 100, 156, 56, 200, 3]] = [5, 40, 40, 40, 7, 11]
    plan = packing.plan(h)
    used = np.zeros(257, np.int64)
    for filling, n in plan:
        assert sum(filling) <= 256
        np.add.at(used, filling, n)
    assert (used == h).all() and sum(n for _, n in plan) <= 5 + 40 + 40 + 7


def test_least_squares_places_nearly_all():
    r = np.random.default_rng(1)
    for n, share in ((1000, 0.6), (10_000, 0.9), (90_000, 0.97)):
        length = np.clip(np.exp(r.normal(5.5, 1, n)), 1, packing.WINDOW).astype(int)
        left = np.bincount(-(-length // packing.STEP), minlength=257)
        whole = left.copy()
        placed = sum(len(f) * k for f, k in packing.solved(left))
        assert placed >= share * n and (left >= 0).all() and left.sum() == n - placed
        assert sum(k for _, k in packing.plan(whole)) <= 1.01 * (whole * np.arange(257)).sum() / 256 + 1


def test_solve_is_least_squares():
    r = np.random.default_rng(2)
    columns, times = packing.combinations(12)
    assert ((columns * times).sum(1) == 12).all() and len({(tuple(a), tuple(b)) for a, b in zip(columns.tolist(), times.tolist(), strict=True)}) == len(columns)
    for _ in range(20):
        h = r.integers(0, 30, 13)
        h[0] = 0
        a = np.zeros((13, len(columns)))
        np.add.at(a, (columns.ravel(), np.repeat(np.arange(len(columns)), 3)), times.ravel())
        a[0] = 0
        x, best = packing.solve(columns, times, h), np.ones(len(columns))
        for _ in range(20_000):  # projected gradient
            best = np.maximum(0, best - 0.002 * (a.T @ (a @ best - h)))
        assert (x >= 0).all() and np.abs(a @ x - h).max() < 0.5 or ((a @ x - h) ** 2).sum() <= ((a @ best - h) ** 2).sum() * 1.01 + 1e-6


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_in_groups(name):
    """Words go to the library many at a time, with the ids that each has alone; a group that comes back in other parts goes word by word."""
    e = tokens.Encoder(tokens.tokenizer_path(name))
    words = [" " + a + b + c for a in ("Größ", "and", "ÀÖ", "straß", "x", "The") for b in ("", "e", "ÿ", "IT", "ing") for c in ("", "n", "ß", "Tion", "é")]
    pieces = [*words, "first", " 12", " don't", " a-b", ",", " x.y", " \u00aa", " \u0130", " e\u0301", "\n\n", "", " <|endoftext|>"]
    alone = [x.ids for x in e.t.encode_batch_fast(pieces, add_special_tokens=False)]

    class Counted:
        def __init__(self, parts):
            self.n, self.parts = 0, parts

        def encode_batch(self, texts, add_special_tokens):
            self.n += len(texts)
            return [SimpleNamespace(ids=x.ids, word_ids=self.parts(x.word_ids)) for x in real.encode_batch(texts, add_special_tokens=add_special_tokens)]

        def encode_batch_fast(self, texts, add_special_tokens):
            self.n += len(texts)
            return real.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    real = e.t
    for parts, most in ((lambda w: w, 20), (lambda w: [0] * len(w), 1000)):
        e.t = Counted(parts)
        assert e.each(pieces) == alone and e.t.n < most


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_at_symbols_and_lines(name):
    """Words before symbols and after lines' ends are pieces of their own, with the ids of the whole text."""
    e = tokens.Encoder(tokens.tokenizer_path(name))
    texts = ["a\nThe\n\nÉt the*** x&&& ý\n Q", "d#$%&*e \nß\n\r\nA\nB", "it's 5\n'll go\n", "a**b &amp; c%d\n\n\nzé$$$ \tq\nÀ×À÷\nñ", "", "\n", "x\u0301y n\u0301\nn", "* a ##b# #\n#c", "\n\na"]
    ids, n = e.encode(*common.utf8(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [x.ids for x in e.t.encode_batch(texts, add_special_tokens=False)]
    data, off = common.utf8(pa.array(["a word*** and.\nmore"]))
    assert e.cuts(data, off)[0].tolist() == [0, 1, 6, 9, 13, 15]


def test_batches_of_long_rows(spark):
    """What a worker gets at once is bounded in bytes too, not in rows only."""
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["size"])

    common.ready(spark)
    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("text"))
    got = [r["size"] for r in rows.mapInArrow(sizes, "size long").collect()]
    assert sum(got) >= 400 * 50_000 and max(got) < 5_000_000


def test_mixing(spark, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({"absent": F.lit(1), "size": F.lit(2)})
    out = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        key = (r["absent"], r["src"])
        size[key] += r["size"]
        taken[key] += r["size"] * r["copies"]
        target[key] = r["target"]
        assert 0 <= r["copies"] <= 2
    budget, weight = 1.5 * sum(size.values()), {k: (3, 1, 2)[i % 3] for i, k in enumerate(sorted(size))}
    want, open_ = {}, set(size)
    while True:
        level = (budget - sum(want.values())) / sum(weight[k] for k in open_)
        full = {k for k in open_ if level * weight[k] > 2 * size[k]}
        if not full:
            break
        want |= {k: 2.0 * size[k] for k in full}
        open_ -= full
    want |= {k: level * weight[k] for k in open_}
    for k in size:
        assert target[k] == pytest.approx(want[k])
        assert abs(taken[k] - target[k]) <= max(0.05 * target[k], 400)
    assert mixing.mix(none).count() == 0
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["copies"] for r in out)


def test_mixing_nulls(docs, rows):
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    assert {r["size"] for r in out if r["doc_id"] in (5, 6, 7)} == {0}


def test_top_k(spark):
    r = np.random.default_rng(3)
    data = [(i, r.normal(size=16).astype(np.float32).tolist()) for i in range(700)] + [(700, None), (701, [float("nan")] * 16), (702, [None] + [0.0] * 15), (703, [0.5] * 16), (704, [0.5] * 16), (None, [1.0] * 16), (703, [0.5] * 16), (800, [0.25] * 4)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = {}
    for x in vafile.top_k(df, F.col("id") % 100 == 0).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    whole = [(i, np.pad(np.floor(1024 * np.array(v, np.float64)).astype(np.int64), (0, 16 - len(v)))) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all()]
    for q in {i for i, _ in whole if i % 100 == 0}:
        v = next(x for i, x in whole if i == q)
        best = sorted((-int(v @ x), i) for i, x in whole if i != q)[:10]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert vafile.top_k(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_top_k_of_few(spark):
    """Fewer candidates than k, ties, and columns with the operator's names."""
    df = spark.createDataFrame([(0, [1.0, 0.5], 1, 2, 3), (100, [1.0, 0.5], 1, 2, 3), (7, [0.25, -1.0], 1, 2, 3)], "vec_id long, embedding array<float>, score int, rank int, id int")
    got = sorted(tuple(r) for r in vafile.top_k(df, F.col("id") % 100 == 0).collect())
    assert got == [(0, 1, 100, 1024 * 1024 + 512 * 512), (0, 2, 7, 1024 * 256 - 512 * 1024), (100, 1, 0, 1024 * 1024 + 512 * 512), (100, 2, 7, 1024 * 256 - 512 * 1024)]


def test_mixing_rows_without_id(spark):
    """Rows without an id go by their text, so a source of such rows meets its target too."""
    rows = [(None, document(20 + i % 7, {0: f"a{i}"}), "a") for i in range(400)] + [(i, document(25, {0: f"b{i}"}), "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    for s in "ab":
        mine = [r for r in out if r["src"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 0.02 * mine[0]["target"]
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(df).collect()))


def test_mixing_gaps(spark):
    """Gaps close by many exchanges at once, over repeated rows too, and joins make a row a document and step, not one for each round."""
    rows = [(i % 900, document(20 + i % 900 % 37, {0: f"a{i % 900}"}), "a") for i in range(1800)] + [(1000 + i, document(9 + i % 5, {0: f"b{i}"}), "b") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    for s in "ab":
        mine = [r for r in out if r["src"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= max(mixing.CLOSE * mine[0]["target"], 20)
    for i in range(900):
        assert len({r["copies"] for r in out if r["doc_id"] == i}) == 1
    cells = [(False, "a", w, 5, 2, 1e5, 1e6) for w in range(1, 400)] + [(False, "b", w, 3, 1, -777.0, 1e6) for w in (7, 50, 333, 900)] + [(False, "c", 9, 1, 1, 4.0, 10.0)]
    steps = mixing.exchanges(spark.createDataFrame(cells, "absent boolean, src string, words long, up long, down long, gap double, goal double")).collect()
    left = {s: next(c[5] for c in cells if c[1] == s) - sum(r["step"] * r["words"] for r in steps if r["src"] == s) for s in "abc"}
    assert abs(left["a"]) <= 100 and abs(left["b"]) <= 400 and left["c"] == 4.0
    assert all(-c[4] <= r["step"] <= c[3] for r in steps for c in cells if (c[1], c[2]) == (r["src"], r["words"]))


def test_language(spark, docs, none):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(real.where(~language.held_out()).select("text", "lang"))
    out = language.predict(real.where(language.held_out()), model).where("lang is not null").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97 and all(0 <= r["score"] <= 1 for r in out)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert {got[i]["lang_pred"] for i in (5, 6, 7)} == {"und"} and got[0]["lang_pred"] == "en"
    assert language.predict(none, model).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.train(none.select("text", "lang"))).collect()} == {"und"}


def test_quality(spark, docs, none, rows):
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 1, 0), (2, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.model(docs, labels)
    out = {r["doc_id"]: r for r in quality.rules(docs.where("doc_id <> 0"), m).collect()}
    for i, t, *_ in rows[1:-1]:
        t = t or ""
        w = WORD.findall(t)
        c = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        cover = {k for j in range(len(w) - 7) if c[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        held = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(held) - len(set(held)), len(cover))
        assert tuple(out[i][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert out[i]["base_failed"] == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert not out[5]["kept"]
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = quality.rules(real, quality.model(real, given)).where("not base_failed").join(given, "doc_id").collect()
    assert np.mean([r["kept"] for r in scored if r["quality"] == 1]) == 1
    assert np.mean([r["kept"] for r in scored if r["quality"] == 0]) < 0.5
    every = quality.rules(real, quality.model(real, given))
    assert every.where("kept").count() == sum(r["kept"] for r in every.select("kept").collect()) > 0
    assert quality.rules(none, m).count() == 0 and quality.model(none, labels) == [0.0] * quality.BUCKETS


def test_quality_repeats(spark):
    a = document(10)
    df = spark.createDataFrame([(1, f"{a} b c {a} z\n{a}\n{a}")], "doc_id long, text string")
    r = quality.rules(df, [0.0] * quality.BUCKETS).first()
    assert (r["n_words"], r["n_dup_lines"]) == (43, 1) and r["n_repeat_words"] >= 40


def test_quality_filters_stay_linear(spark):
    words = [f"w{i % 7001}" for i in range(20_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, document(30)), (3, None)], "doc_id long, text string")
    out = quality.rules(df, [1.0] * quality.BUCKETS)
    assert [r["doc_id"] for r in out.where("kept").collect()] == [2]
    r = out.where("base_failed and n_words > 0").first()
    assert (r["doc_id"], r["n_words"], r["n_repeat_words"]) == (1, 20_000, 20_000) and r["score"] == pytest.approx(1.0)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_base_spans_equal_the_patterns():
    r = random.Random(12)
    bits = ["a", "B.", "@", "x.y", "-", "+", "1", "23", "4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", ".", " ", "(", ")", "300.1.1.1", "é", "\n", "_", "%", "+49 30 1234567", "00", "0" * 30]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(1, 16)))
        want = []
        for k, (name, pattern) in enumerate(BASE.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub(r"[^0-9]", "", m[0])
                ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else True, "card": 12 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0, "phone": 9 <= len(digits) <= 15}[name]
                if ok:
                    want.append((m.start(), k, m.end()))
        assert pii.base_spans(text) == sorted(want), text
    assert pii.base_spans("0" * 5000 + "1.1.1.1") == [(0, 1, 5007)] and pii.base_spans("1" * 6000 + ".1.1.1") == []


def test_sanitised(spark, docs, none):
    data = [(i, f"{document(20, {k: f'q{i}{k}' for k in range(20)})} Zorkulan7 of ann@mail.example.com {document(9)}", "x") for i in range(8)] + [(100 + i, document(30, {k: f"z{i}{k}" for k in range(30)}), "y") for i in range(1500)] + [(9000, None, "z"), (9001, "", "z")]
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(spark.createDataFrame(data, "doc_id long, text string, spans string")).collect()}
    assert len(out) == len(data) and out[9000] is None and out[9001] == ""
    assert all("Zorkulan7" not in out[i] and "ann@" not in out[i] and "[email]" in out[i] for i in range(8))
    assert all(out[i] == t for i, t, _ in data if 100 <= i < 9000)
    assert pii.rewritten("abc def ghi 12", [(0, 4, 3), (4, 5, 7), (5, 0, 9), (12, 4, 14)]) == "[term] hi [number]"
    assert pii.sanitised(docs).columns == docs.columns and pii.sanitised(none).count() == 0


def test_personal_data(spark, docs, none):
    text = "Mail a.b@x.example.com or +49 (30) 123456-78, card 4111 1111 1111 1111, no 4111 1111 1111 1112, ip 10.0.0.256 and 10.0.0.25 @@ x@y é"
    df = spark.createDataFrame([(1, text), (2, None), (3, "a" * 200_000 + "@"), (4, "1" * 100_000 + ".1.1.1")], "doc_id long, text string")
    got = {r["id"]: [(pii.KINDS[s["kind"]], (text if r["id"] == 1 else "")[s["start"] : s["end"]]) for s in r["base"]] for r in pii.personal_data(df).collect()}
    assert got == {1: [("email", "a.b@x.example.com"), ("phone", "+49 (30) 123456-78"), ("card", "4111 1111 1111 1111"), ("ip", "10.0.0.25")], 2: [], 3: [], 4: []}
    assert pii.personal_data(docs).count() == 34 and pii.personal_data(none).count() == 0


def test_revealing_terms(spark):
    near = [f"{document(30, {i: f'k{n}{i}' for i in range(30)})} zorkulan wrote from who{n % 2}@mail.example.com {document(10, {0: f'q{n}'})}" for n in range(0, 16, 2)]
    far = [document(40, {i: f"z{n}{i}" for i in range(30)}) for n in range(1000)]
    df = spark.createDataFrame(list(enumerate(near + far)), "doc_id long, text string")
    out = {r["id"]: r["spans"] for r in pii.personal_data(df).collect()}
    texts = near + far
    for i in range(8):
        assert "zorkulan" in [texts[i][s["start"] : s["end"]] for s in out[i] if s["kind"] >= 4]
    assert all(not s for i, s in out.items() if i >= 8)


@pytest.mark.parametrize("held", [2, 400_000])
def test_owners_names(spark, monkeypatch, held):
    """Names in local parts are marked wherever they stand if few others bear them: the same as PMI / IC of plain counts; common words, digits and short parts aren't."""
    import math

    monkeypatch.setattr(pii, "HELD", held)
    filler = [document(25, {i: f"w{n % 211}x{i}" for i in range(20)}) for n in range(1500)]
    plant = {
        3: "Write to Quennevar.Osteldian-1985@mail.example.com today", 40: "we saw Quennevar, and (OSTELDIAN) left", 41: "about osteldian: gone",
        50: "send it to hello.it@mail.example.com or it@x.example.com", 60: "ask Brüselda_vann@mail.example.com", 61: "so Brüselda! came", 70: "in 1985 it was",
    }
    plant |= {n: "hello there" for n in range(100, 400)}
    texts = [f"{t} {plant[n]}" if n in plant else t for n, t in enumerate(filler)]
    df = spark.createDataFrame([*enumerate(texts), (9000, None), (9001, "")], "doc_id long, text string").repartition(5)
    out = {r["id"]: [(texts[r["id"]][s["start"] : s["end"]].lower(), pii.KINDS[s["kind"]]) for s in r["spans"] if s["kind"] >= 4] for r in pii.personal_data(df).collect()}
    parts = lambda t: {p for p in re.split(r"[^0-9a-z\u0080-\uffff]+", t.lower()) if len(p.encode()) >= 3}
    count = Counter(p for t in texts for p in parts(t))
    mails = Counter(m for t in texts for m in set(re.findall(r"[\w.%+-]+@[\w.-]+", t.lower())))
    n, share = len(texts) + 2, {}
    for m, of in mails.items():
        for p in parts(m.split("@")[0]):
            if not p.isdigit():
                share[p] = max(share.get(p, 0), math.log2(n / count[p]) / math.log2(n / of))
    want = {p: "remove" if x >= pii.REMOVE else "generalise" for p, x in share.items() if x >= pii.GENERALISE}
    assert {"quennevar", "brüselda"} <= set(want) and "hello" in share and "hello" not in want
    for i, t in enumerate(texts):
        alone = re.sub(r"[\w.%+-]+@[\w.-]+", " ", t)
        assert sorted(out[i]) == sorted((w.lower(), want[w.lower()]) for w in re.findall(r"[^\W_]+", alone) if w.lower() in want)


def test_line_dedup(spark, docs, none):
    a, b = document(20), document(20, {3: "changed"})
    df = spark.createDataFrame([(1, f"{a}\nunique first\n\n{a}"), (2, f"{b}\nother line here"), (3, f"  {a.upper()} "), (4, None), (5, "abc"), (5, "abc"), (6, "abd")], "doc_id long, text string")
    got = {r["id"]: (r["n_lines"], r["kept"]) for r in lines.kept_lines(df).collect()}
    assert got == {1: (3, [0, 1]), 2: (2, [1]), 3: (1, []), 5: (1, [0]), 6: (1, [0])}
    left = {r["doc_id"]: r["text"] for r in lines.deduplicated(df).collect()}
    assert left == {1: f"{a}\nunique first\n", 2: "other line here", 4: None, 5: "abc", 6: "abd"}
    assert lines.deduplicated(docs).columns == docs.columns and lines.kept_lines(none).count() == 0


def test_jaccard_join(docs, none, rows):
    want = jaccard_components([(r[0], r[1]) for r in rows])
    got = jaccard.join(docs).collect()
    assert len(got) == len(rows) and {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({v[1] for v in want.values()}) < len(want) and jaccard.join(none).count() == 0


def test_jaccard_repeated_ids_and_hot_tokens(spark, monkeypatch):
    """Rows that share a doc_id are one document; ranges, hot keys and blocks so small that every way is taken."""
    for name, value in (("HOT", 3), ("RANGE", 64), ("SALTS", 2), ("HELD", 50), ("PACK", 400)):
        monkeypatch.setattr(common, name, value)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "GROUP", 8)
    r = random.Random(6)
    a, b = document(60), document(60, {i: f"b{i}" for i in range(60)})
    data = [(3, a), (5, a), (5, b), (9, b), (11, None), (None, a)]
    data += [(100 + i, document(150, {r.randrange(150): f"w{i}" for _ in range(r.randrange(4))})) for i in range(60)]
    got = {}
    for x in jaccard.join(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect():
        got.setdefault(x["doc_id"], set()).add(x["component_id"])
    assert got[3] == got[5] == got[9] == {3} and got[11] == {11} and got[None] == {3}
    want = jaccard_components([x for x in data if (x[0] or 0) >= 100])
    assert {i: got[i] for i in want} == {i: {c} for i, (_, c) in want.items()}


def test_parts_never_miss_a_link():
    r = np.random.default_rng(1)
    for n in (12, 19, 20, 57, 58, 200, 590):
        for _ in range(30):
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            gone = r.integers(0, jaccard.most_apart(2 * n) + 1)
            b = np.unique(np.concatenate([a[gone // 2 :], r.integers(0, 1 << 63, gone - gone // 2, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both):
                k = set(jaccard.levels_of(len(a))) & set(jaccard.levels_of(len(b)))
                assert k or np.array_equal(a, b)
                for level in k:
                    (x, need), (y, _) = jaccard.parts(a, level), jaccard.parts(b, level)
                    if need > 0:
                        assert ((x == y) & (x != 0)).sum() >= need


def test_parts_need_many_tokens():
    """At 80 %, a set of any size needs a good part of its tokens, so that a few that many sets have open no group."""
    r, percent = np.random.default_rng(2), 80
    for n in (90, 133, 140, 285, 300, 570, 575, 1140, 1150, 2300):
        u = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        for level in jaccard.levels_of(len(u), percent):
            sig, need = jaccard.parts(u, level, percent)
            assert need >= 0.3 * (sig != 0).sum(), (n, level, need)


def test_substrings(spark, docs, none):
    r = random.Random(2)
    filler = lambda n: " ".join(f"f{r.randrange(10**9)}" for _ in range(n))
    p = document(60, {i: f"p{i}" for i in range(60)})
    edited = p.split()
    edited[20] = "typo"
    data = [(1, f"{filler(30)} {p} {filler(25)}"), (2, f"{filler(12)} {p.upper()}"), (3, f"{filler(9)} {' '.join(edited)} {filler(70)}"), (4, filler(200)), (5, None), (6, f"{p.rsplit(' ', 25)[0]} {filler(60)}")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {x["id"]: [(s["start"], s["end"]) for s in x["passages"]] for x in substrings.passages(df).collect()}
    assert got == {1: [(30, 90)], 2: [(12, 72)], 3: [(9, 69)], 4: [], 5: [], 6: []}
    assert substrings.passages(docs).count() == 34 and substrings.passages(none).count() == 0


def test_substrings_around_unrelated_text(spark):
    """Exact passages around unrelated text of many lengths, and a near copy with a rewritten paragraph."""
    r = random.Random(5)
    filler = lambda n: [f"f{r.randrange(10**9)}" for _ in range(n)]
    data, want = [], {}
    for n, gap in ((60, 40), (60, 80), (60, 120), (200, 300), (200, 500), (185, 130)):
        p, q = filler(n), filler(n)
        for i in (len(data), len(data) + 1):
            lead = r.randrange(20)
            data.append((i, " ".join([*filler(lead), *p, *filler(gap), *q, *filler(30)])))
            want[i] = [(lead, lead + n), (lead + n + gap, lead + 2 * n + gap)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {x["id"]: [(s["start"], s["end"]) for s in x["passages"]] for x in substrings.passages(df).collect()}
    assert got == want


@pytest.mark.parametrize("copies", [1, 12])
def test_substrings_with_several_partners(spark, copies):
    """A passage whose halves stand in other documents first, once or in many; and one that stands twice in the first document."""
    r = random.Random(7)
    filler = lambda n: [f"f{r.randrange(10**9)}" for _ in range(n)]
    p, q = filler(80), filler(60)
    data = [[*filler(9), *p[:40], *filler(9)] for _ in range(copies)] + [[*filler(9), *p[40:], *filler(9)] for _ in range(copies)]
    data += [[*filler(20), *p, *filler(7)], [*filler(5), *p, *filler(8)]]
    data += [[*filler(11), *q, *filler(200), *q, *filler(9)], [*filler(30), *q]]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(data)], "doc_id long, text string")
    got = {x["id"]: [(s["start"], s["end"]) for s in x["passages"]] for x in substrings.passages(df).collect()}
    n = 2 * copies
    assert got == {i: [] for i in range(n)} | {n: [(20, 100)], n + 1: [(5, 85)], n + 2: [(11, 71), (271, 331)], n + 3: [(30, 90)]}


def test_substrings_with_edited_words(spark):
    """Passages of 64 words of which every 8th, or 15 % at random, are others."""
    r = random.Random(8)
    filler = lambda n: [f"f{r.randrange(10**9)}" for _ in range(n)]
    data = []
    for k in range(40):
        p = filler(64)
        q = p.copy()
        for i in range(4, 64, 8) if k % 2 else r.sample(range(1, 63), 9):
            q[i] = f"e{r.randrange(10**9)}"
        data += [(2 * k, " ".join([*filler(20), *p, *filler(20)])), (2 * k + 1, " ".join([*filler(20), *q, *filler(20)]))]
    got = {x["id"]: [(s["start"], s["end"]) for s in x["passages"]] for x in substrings.passages(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    for i, spans in got.items():
        assert spans == [(20, 84)] if i // 2 % 2 else len(spans) == 1 and 20 <= spans[0][0] <= spans[0][1] - 50 <= 34, (i, spans)
    assert len(got) == 80


def test_common_words():
    r = random.Random(6)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for w in a:
            last = 0
            for j, v in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if w == v else max(row[j], row[j - 1])
        assert substrings.common_words(a, b) == row[-1]


def test_chains_follow_both_orders():
    x, y = [0, 10, 20, 30, 400], [100, 110, 5, 130, 500]
    best = max(substrings.chains(x, y), key=len)
    assert best == [0, 1, 3]


def test_components(spark):
    r = random.Random(9)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    up = {}

    def find(v):
        while up.setdefault(v, v) != v:
            v = up[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {x["id"]: x["root"] for x in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: find(v) for v in linked}
