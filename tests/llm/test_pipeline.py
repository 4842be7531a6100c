"""The pipeline's own rules against plain versions."""

import random
from collections import Counter

import corpus_pipeline
from pednet.llm import lines
from tests.conftest import SMALL
from tests.llm.brute import WORD, document, jaccard_components
from tests.llm.test_lines import brute


def test_jaccard_stage(spark):
    """Copies of a document with more and more words changed: those of five-word similarity 0.8 or more go, with no need of 0.9."""
    r = random.Random(3)
    rows = [(0, document(300))]
    for i in range(1, 30):
        rows.append((i, document(300, {j: f"w{i}x{j}" for j in r.sample(range(300), i // 3)})))
    rows += [(40, None), (41, "one two three"), (42, "one two three"), (None, "no id")]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = sorted(x["doc_id"] for x in corpus_pipeline.jaccard_join(spark, df, "").where("doc_id is not null").collect())
    of = jaccard_components([x for x in rows if x[0] is not None], k=5, percent=80)
    assert got == sorted(i for i, (_, c) in of.items() if c == i)
    loose = jaccard_components([x for x in rows if x[0] is not None])
    assert len(got) != sum(c == i for i, (_, c) in loose.items())


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, kept boolean, score string, size int, k1 long"


def test_stages_follow_one_another(spark):
    """Each stage on what the one before kept, against plain versions; then run() itself."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = corpus_pipeline.language_id(spark, docs, SMALL).cache()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["text"] for r in known.collect()}
    assert known.columns == docs.columns and kept.items() <= texts.items()
    gone = set(texts) - set(kept)
    assert all(not any(c.isalpha() for c in texts[i] or "") for i in gone) or len(gone) < 0.1 * len(texts)
    slim = corpus_pipeline.line_dedup(spark, known, SMALL).cache()
    stay = brute(list(kept.items()))
    want = {}
    for i, t in kept.items():
        held = [(k, x) for k, x in enumerate((t or "").split("\n"))]
        real = [k for k, x in held if lines.normal(x)]
        left = [x for k, x in held if not lines.normal(x) or (i, k) in stay]
        if not real or any((i, k) in stay for k in real):
            want[i] = t if all((i, k) in stay for k in real) else "\n".join(left)
    got = {r["doc_id"]: r["text"] for r in slim.collect()}
    assert len(set(got.items()) ^ set(want.items())) <= 0.02 * len(want) and slim.columns == docs.columns
    single = corpus_pipeline.jaccard_join(spark, slim, SMALL).cache()
    of = jaccard_components(list(got.items()), k=5, percent=80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, (_, c) in of.items() if c == i)
    mixed = corpus_pipeline.mix_sources(spark, single, SMALL).cache()
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in single.collect()}
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(copies) <= set(size) and max(copies.values()) <= 2
    assert abs(sum(size[i] * n for i, n in copies.items()) - 1.5 * sum(size.values())) < 0.05 * sum(size.values())
    packed = corpus_pipeline.pack(spark, mixed, SMALL).collect()
    total = Counter()
    for r in packed:
        total[r["doc_id"]] += r["length"]
    assert total == {i: n * next(r["doc_tokens"] for r in packed if r["doc_id"] == i) for i, n in copies.items()}
    assert sorted((r["doc_id"], r["start"]) for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted((r["doc_id"], r["start"]) for r in packed)


def test_edge_cases(spark, tmp_path):
    """Nulls in any column, repeated rows, columns with the operators' names, and an empty table."""
    text = document(90)
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (None, document(70, {i: f"n{i}" for i in range(60)}), "en", None), (4, document(80, {i: f"v{i}" for i in range(80)}), None, "b"), (5, " \n", "en", "b")]
    df = spark.createDataFrame([(*r, 1, 2, "x", True, "y", 3, 4) for r in rows], SCHEMA)
    for name, data in (("some", df), ("none", df.limit(0))):
        data.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r["doc_id"] for r in out} <= {1, 4, None} and bool(out) == (name == "some")
