"""Personal data: base patterns, and information-theoretic sanitisation of the terms that reveal them (Sanchez and Batet 2016).

Base: emails, IP addresses, cards and phones by fixed patterns, in linear time for any text. Each distinct value is a protected entity.
Corpus counts over all documents: df(e), documents that hold an entity; df(t), that hold a term; df(t, e), that hold the term within
CONTEXT terms of the entity; terms are runs of letters and digits. A term's disclosure of an entity is PMI(t, e) / IC(e), the share of the entity's information that the term
gives away: 1 where the term occurs nowhere else. So that a chance meeting doesn't count as much as many, the share of a term's documents
that hold the entity enters PMI by its lower confidence bound (Wilson's, at SURE standard deviations, over the different texts that have
both). A term of an email's own local part, such as its owner's name, does not meet it by chance: every document that holds the email
holds the term, and df(t) counts those where it stands alone too, so its PMI is that of the counts themselves: a name that few others
bear is marked wherever it stands, a common word isn't. Terms that disclose an entity by REMOVE or more are marked for removal wherever they stand, by GENERALISE or more for a general
word. sanitised() rewrites the texts: base spans and terms to generalise give way to the name of their class, terms to remove go.

Candidates and marked terms reach the passes over texts as Bloom filters of fixed size; exact joins decide afterwards.
Edge cases: null text is empty; a text without spans has an empty list; rows that repeat a doc_id and text are scored alike and each
counts as a document; ties don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pednet.llm import common
from pednet.llm.terms import gaps, split

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
CONTEXT = 8
SURE = 1.96
REMOVE = 0.95
GENERALISE = 0.9
LEAST_BYTES = 3
#: Counts of terms that a task holds before it hands them on.
HELD = 400_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: What stands between terms: all ASCII but letters and digits.
_GAPS = gaps("".join(chr(c) for c in range(128) if not chr(c).isalnum()))
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str):
    """Each run of local characters before an @, if a domain follows; the same as the pattern's leftmost matches, in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in code points."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def entity(kind: int, value: str) -> int:
    plain = value.lower() if kind < 2 else re.sub(r"[^0-9]", "", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def row_key(text: str | None) -> int:
    return int.from_bytes(common.digest((text or "").encode("utf-8", "replace"))[:8], "little", signed=True)


def terms(text: pa.Array) -> tuple[np.ndarray, ...]:
    """The texts' bytes and offsets; start, end and hash of each term, and for each text where its terms begin (one more at the end)."""
    data, off = common.utf8(text)
    begin, end, h, _ = split(data, off, _GAPS)
    return data, off, begin, end, h, np.searchsorted(begin, off)


def found(docs: DataFrame) -> DataFrame:
    """id, row (hash of the text), base spans, and (entity, term) pairs that stand together; own: the term is part of the entity."""

    def run(batches):
        for batch in batches:
            for b in common.slices(batch):
                texts = b.column("text").to_pylist()
                spans = [base_spans(t or "") for t in texts]
                data, off, begin, end, h, first = terms(b.column("text"))
                near = []
                for i, s in enumerate(spans):
                    pairs = {}
                    if s:
                        lead = np.flatnonzero((data[off[i] : off[i + 1]] & 0xC0) != 0x80)
                        lead = np.append(lead, off[i + 1] - off[i]) + off[i]
                        w = slice(first[i], first[i + 1])
                        ws, we, wh = begin[w], end[w], h[w]
                        own = np.zeros(len(ws), bool)
                        places = [(int(np.searchsorted(we, lead[x], "right")), int(np.searchsorted(ws, lead[y], "left")), entity(k, texts[i][x:y])) for x, k, y in s]
                        for x, y, _ in places:
                            own[x:y] = True
                        fine = ~own & (we - ws >= LEAST_BYTES)
                        for x, y, e in places:
                            for j in [*range(max(0, x - CONTEXT), x), *range(y, min(len(ws), y + CONTEXT))]:
                                if fine[j]:
                                    pairs.setdefault((e, int(wh[j].view(np.int64))), False)
                            pairs[e, 0] = False
                        for x, k, y in s:
                            if k == 0:
                                e, local = entity(k, texts[i][x:y]), texts[i].index("@", x)
                                for j in range(int(np.searchsorted(we, lead[x], "right")), int(np.searchsorted(we, lead[local], "right"))):
                                    if we[j] - ws[j] >= LEAST_BYTES and not data[ws[j] : we[j]].tobytes().isdigit():
                                        pairs[e, int(wh[j].view(np.int64))] = True
                    near.append([{"e": e, "t": t, "own": own} for (e, t), own in pairs.items()])
                yield pa.record_batch(
                    [b.column("id"), pa.array([row_key(t) for t in texts], pa.int64()), pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in x] for x in spans], SPANS), pa.array(near, pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64()), ("own", pa.bool_())])))],
                    names=["id", "row", "spans", "near"],
                )

    return docs.mapInArrow(run, "id long, row long, spans array<struct<start:int,kind:int,end:int>>, near array<struct<e:bigint,t:bigint,own:boolean>>")


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def term_filter(terms: DataFrame) -> np.ndarray:
    """A Bloom filter of term hashes, which are mixed already: their own bits are the places."""
    bits = common.BLOOM_BITS
    at = [F.shiftrightunsigned("t", 25 * i).bitwiseAND(F.lit(bits - 1).cast("long")) for i in range(2)]
    rows = terms.select(F.explode(F.array(*at)).alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[rows["w"].to_numpy()] = rows["m"].to_numpy().view(np.uint64)
    return out


def maybe(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for i in range(2):
        p = ((h >> np.uint64(25 * i)) & np.uint64(common.BLOOM_BITS - 1)).astype(np.int64)
        ok &= ((words[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return ok


def term_counts(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """t and df(t) of the terms that may be in the filter; a task adds up what it has read."""
    sent, most = docs.sparkSession.sparkContext.broadcast(words), HELD

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def added():
            u, inv = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return u, np.bincount(inv, np.concatenate([n for _, n in held])).astype(np.int64)

        def batch_of(u, n):
            return pa.record_batch([pa.array(common.as_long(u)), pa.array(n)], names=["t", "n"])

        for batch in batches:
            for b in common.slices(batch):
                *_, h, first = terms(b.column("text"))
                at = np.flatnonzero(maybe(h, sent.value))
                doc = np.searchsorted(first, at, "right") - 1
                order = np.lexsort((doc, h[at]))
                t, d = h[at][order], doc[order]
                new = np.ones(len(t), bool)
                new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
                u, n = np.unique(t[new], return_counts=True)
                held.append((u, n.astype(np.int64)))
                if sum(len(x) for x, _ in held) > most:
                    held = [added()]
                    if len(held[0][0]) > most // 2:
                        yield batch_of(*held.pop())
        if held:
            yield batch_of(*added())

    return docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("df"))


def term_places(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """id, row, t, start and end (code points) of the terms that may be in the filter."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches):
        for batch in batches:
            for b in common.slices(batch):
                data, off, begin, end, h, first = terms(b.column("text"))
                at = np.flatnonzero(maybe(h, sent.value))
                doc = np.searchsorted(first, at, "right") - 1
                cp = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                texts = b.column("text")
                key = {i: row_key(texts[i].as_py()) for i in np.unique(doc).tolist()}
                cols = [b.column("id").take(pa.array(doc)), pa.array([key[i] for i in doc.tolist()], pa.int64()), pa.array(common.as_long(h[at])), pa.array((cp[begin[at]] - cp[off[doc]]).astype(np.int32)), pa.array((cp[end[at]] - cp[off[doc]]).astype(np.int32))]
                yield pa.record_batch(cols, names=["id", "row", "t", "start", "end"])

    return docs.mapInArrow(run, "id long, row long, t long, start int, end int")


def revealing(base: DataFrame, docs: DataFrame) -> DataFrame:
    """t and kind (of KINDS) of the terms whose disclosure of some entity reaches a threshold. base: near and row of each document, as found."""
    n = base.count()
    near = base.select("row", F.explode("near").alias("x")).select("row", "x.*")
    least = base.select(F.explode(F.array_distinct("near.t")).alias("t")).groupBy("t").agg(F.count("*").alias("least"))  # of df(t): documents where it stands by an entity
    pairs = near.groupBy("e", "t").agg(F.count("*").alias("both"), F.countDistinct("row").alias("texts"), F.max("own").alias("own"))
    pairs = common.written(pairs, "pairs")
    of = pairs.where("t = 0").select("e", F.col("both").alias("of_e")).where(F.col("of_e") < n)
    # with so few texts, or so many documents beside those of the entity, no term can reach the threshold, even if all that hold it hold the entity
    share = lambda p: 1 + F.log2(p) / F.log2(F.lit(float(n)) / F.col("of_e"))
    told = lambda df: share(F.when(F.col("own"), F.col("both") / df).otherwise(lower_bound(F.col("both") / df, F.col("texts"))))
    candidates = pairs.where("t <> 0").join(of, "e").join(least, "t").where(told(F.col("least")) >= GENERALISE)
    candidates = common.written(candidates.drop("least"), "candidates")
    common.drop(pairs)
    df = term_counts(docs, term_filter(candidates.select("t").distinct()))
    rows = candidates.join(df, "t").withColumn("share", told(F.col("df")))
    rows = rows.groupBy("t").agg(F.max("share").alias("share"))
    return rows.where(F.col("share") >= GENERALISE).select("t", F.when(F.col("share") >= REMOVE, 5).otherwise(4).alias("kind"))


def lower_bound(p, n):
    """Wilson's lower bound of a share p seen n times."""
    z = SURE * SURE
    return (p + z / (2 * n) - SURE * F.sqrt((p * (1 - p) + z / (4 * n)) / n)) / (1 + z / n)


def spans_of(docs: DataFrame) -> DataFrame:
    """id, row (hash of the text), base (spans of the patterns) and spans (these and revealing terms), sorted by start, then kind. docs: id, text."""
    base = common.written(found(docs), "base")
    marked = common.written(revealing(base, docs), "marked")
    places = term_places(docs, term_filter(marked.select("t"))).join(marked, "t").select("id", "row", F.struct("start", "kind", "end").alias("s")).distinct()
    places = places.groupBy("id", "row").agg(F.collect_list("s").alias("terms"))
    same = base["id"].eqNullSafe(places["id"]) & (base["row"] == places["row"])
    out = base.join(places, same, "left")
    inside = lambda s: F.exists(F.col("spans"), lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
    terms = F.filter(F.coalesce("terms", F.array().cast("array<struct<start:int,kind:int,end:int>>")), lambda s: ~inside(s))
    return out.select(base["id"], base["row"], F.col("spans").alias("base"), F.array_sort(F.concat("spans", terms)).alias("spans"))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, base (spans of the patterns) and spans (these and revealing terms), sorted by start, then kind."""
    common.ready(docs.sparkSession)
    return spans_of(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))).drop("row")


def general(term: str) -> str:
    """A class that a term belongs to: how it is written is all that stays."""
    if any(c.isdigit() for c in term):
        return "[number]" if not any(c.isalpha() for c in term) else "[code]"
    return "[name]" if term[:1].isupper() else "[term]"


def rewritten(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text without what its spans (start, kind, end) reveal. Overlapping spans are one, of the class of the first."""
    out, at = [], 0
    for s, kind, e in sorted(spans):
        if s >= at:
            out.append(text[at:s])
            out.append("" if kind == 5 else general(text[s:e]) if kind == 4 else f"[{KINDS[kind]}]")
        at = max(at, e)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with the text rewritten; nulls stay. All columns pass."""
    common.ready(docs.sparkSession)
    spans = spans_of(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")))
    spans = common.written(spans.where(F.size("spans") > 0).select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("spans").alias("__spans")).distinct(), "spans")

    def number(batches):
        for b in batches:
            keys = [row_key(t) for t in b.column(text_column).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(keys, pa.int64())], names=[*b.schema.names, "__row"])

    def rewrite(batches):
        for b in batches:
            texts = [rewritten(t, [(s["start"], s["kind"], s["end"]) for s in x]) if x else t for t, x in zip(b.column(text_column).to_pylist(), b.column("__spans").to_pylist(), strict=True)]
            yield b.set_column(b.schema.get_field_index(text_column), text_column, pa.array(texts, pa.string())).drop_columns(["__spans"])

    marked = docs.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField("__row", T.LongType())]))
    same = marked[id_column].cast("long").eqNullSafe(spans["__id"]) & (marked["__row"] == spans["__row"])
    return marked.join(spans, same, "left").select(*[marked[c] for c in docs.columns], "__spans").mapInArrow(rewrite, docs.schema)


def text_of(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    out = personal_data(common.documents(spark, sf_dir))
    count = [F.size(F.array_remove(F.col("base.kind"), k)) for k in range(4)]
    count = [(F.size("base") - c).cast("long").alias(f"n_{k}") for c, k in zip(count, KINDS, strict=False)]
    return out.select(F.col("id").alias("doc_id"), *count, F.sha2(text_of(F.col("base")), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"), F.size("base").cast("long").alias("n_base"), F.size("spans").cast("long").alias("n_spans"))
