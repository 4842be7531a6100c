"""N-gram Jaccard join by a token-group matrix (Li et al. 2021, adapted): all links of similarity 0.9 or more, exactly.

A document's set is that of its distinct word shingles, hashed to 64 bits. Two sets link when 100 |A and B| >= PERCENT |A or B|, so they
differ in at most (|A| + |B|) (100 - PERCENT) / (100 + PERCENT) elements. Each set is cut by hash range into m parts (m by its size, a
power of two above that number, below 90 % of at least twice that number); a part's hash is a compound token. Sets that link agree in all parts
but as many as they differ in: with twice as many parts, a set needs about half its tokens in a group, and a few that many sets have open none.

1. Equal sets are one class. A class of whose tokens fewer than needed occur in any other class links with nothing and is left out.
2. The others are partitioned into groups of similar classes: by the token of theirs that most classes have, large ones split by hash into
   about GROUP classes, and these into blocks of about BLOCK.
3. The token-group matrix holds each group's union of tokens. The tokens a query shares with that union bound those it shares with any
   member, so only groups with as many as needed are opened; others can't hold a link. Pivots enter first; the others (5) without the tokens
   that only classes of their own component have in a group, so near copies that are connected by then don't meet token by token.
4. First each block is verified with a few pivots of its group, and the pivots with those of the groups that they may have links in.
   Distributed union-find joins these links.
5. Then the rest, but for what is connected by then: pairs of blocks of a group that is in several components, and blocks of opened groups
   with their visitors. In each such unit token counts choose the pairs to verify exactly; pairs already connected within it are skipped,
   so a unit gives fewer links than it has classes. Union-find over all links gives components.
   Units are put together in as many slices, one after another, as their sets are larger than all sets once: disk goes with the input.

Edge cases: null or blank text has no set and links with nothing; sets of one to eight shingles link with equal sets only (at 90 %); rows that
share a doc_id are one document, so all their sets are in one component; a null doc_id gets a null component unless equal texts have an id;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common

SHINGLE = 3
PERCENT = 90
BLOCK = 128
GROUP = 1024
#: Of a group, the sets that every block of it is compared with first.
PIVOTS = 2


def most_apart(sizes, percent: int = PERCENT):
    """In how many elements linked sets of these sizes together can differ."""
    return sizes * (100 - percent) // (100 + percent)


def largest(level: int, percent: int = PERCENT) -> int:
    """The largest set that 2 ** level parts serve: two of them share two parts at least; below 90 %, where a part is so small that many sets have it
    by chance, half of the parts."""
    return ((1 << level - 1) if percent < 90 else (1 << level) - 2) * (100 + percent) // (2 * (100 - percent))


def levels_of(n: int, percent: int = PERCENT) -> list[int]:
    """The levels of a set: its own, and the next where a larger partner may have that."""
    partner = n * 100 // percent
    if most_apart(n + partner, percent) < 1:
        return []
    k = 2
    while largest(k, percent) < n:
        k += 1
    return [k, k + 1] if partner > largest(k, percent) else [k]


def parts(u: np.ndarray, level: int, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The compound tokens of a sorted set (0: an empty part), and how many non-empty ones a partner at this level must share."""
    m = 1 << level
    edge = np.searchsorted(u >> np.uint64(64 - level), np.arange(m + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(u), dtype=np.uint64)])
        sig = common.mix(run[edge[1:]] - run[edge[:-1]] + np.arange(m, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level)) | np.uint64(1)
    empty = edge[1:] == edge[:-1]
    sig[empty] = 0
    partner = min(len(u) * 100 // percent, largest(level, percent))
    return sig, m - int(most_apart(len(u) + partner, percent)) - int(empty.sum())


def tokens_of(sig: np.ndarray, need: int, level: int) -> np.ndarray:
    """What a set enters into the matrix: its non-empty parts, and the empty ones only where it could do without the others."""
    if need > 0:
        return sig[sig != 0]
    with np.errstate(over="ignore"):
        empty = common.mix(np.arange(len(sig), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(level)) | np.uint64(1)
    return np.where(sig == 0, empty, sig)


def sets_of(text: pa.Array, k: int = SHINGLE):
    """Each document's sorted distinct shingle hashes."""
    data, off = common.utf8(text)
    _, _, h, first = common.words(data, off, lower=True)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(common.shingles(h[a:b], k))


def owner_of(id_: np.ndarray, level: np.ndarray) -> np.ndarray:
    """What stands for a set at a level, in 64 bits."""
    with np.errstate(over="ignore"):
        return common.as_long(common.mix(common.mix(id_.astype(np.int64).view(np.uint64)) + level.astype(np.uint64)))


def classes(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """A row for each document and level (level 0 where none): id, k (digest of the set), n, main, level, need, owner."""

    def build(batches):
        for batch in batches:
            for b in common.slices(batch):
                ids, rows = b.column("id").to_pylist(), []
                for i, u in enumerate(sets_of(b.column("text"), shingle)):
                    d = common.digest(u.tobytes())
                    for j, level in enumerate(levels_of(len(u), percent) or [0]):
                        rows.append((ids[i], d, len(u), j == 0, level, max(1, parts(u, level, percent)[1]) if level else 1))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()]
                owner = owner_of(np.array([i or 0 for i in cols[0]], np.int64), np.array(cols[4], np.int64))
                yield pa.record_batch([*(pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)), pa.array(owner)], names=["id", "k", "n", "main", "level", "need", "owner"])

    return docs.mapInArrow(build, "id long, k binary, n long, main boolean, level int, need int, owner long")


def tokens(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """owner and keys: the compound tokens of each document at each of its levels."""

    def build(batches):
        for batch in batches:
            for b in common.slices(batch):
                ids, owners, keys = b.column("id").to_pylist(), [], []
                for i, u in enumerate(sets_of(b.column("text"), shingle)):
                    for level in levels_of(len(u), percent):
                        owners.append((ids[i], level))
                        keys.append(tokens_of(*parts(u, level, percent), level).tobytes())
                o = np.array(owners, np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(owner_of(o[:, 0], o[:, 1])), pa.array(keys, pa.binary())], names=["owner", "keys"])

    return docs.mapInArrow(build, "owner long, keys binary")


def shared_tokens(docs: DataFrame, bits: int, shingle: int, percent: int) -> DataFrame:
    """owner, t and c (how many have it, where they met) of the tokens that several sets have, or may have. A token met often may come twice
    for an owner: counts that are too high open more groups, and lose none."""

    def rows(key, owner, _):
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(np.append(new, len(key)))
        return pa.record_batch([pa.array(owner), pa.array(common.as_long(common.mix(key))), pa.array(np.repeat(n, n))], names=["owner", "t", "c"])

    return common.meet(common.pack(tokens(docs, shingle, percent), bits), rows, "owner long, t long, c long")


def full_sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """id, level, and the set itself with its bytes."""

    def build(batches):
        for batch in batches:
            for b in common.slices(batch):
                ids, rows, us = b.column("id").to_pylist(), [], []
                for i, u in enumerate(sets_of(b.column("text"), shingle)):
                    for level in levels_of(len(u), percent):
                        rows.append((ids[i], level))
                        us.append(u.tobytes())
                cols = list(zip(*rows, strict=True)) if rows else [[], []]
                size = pa.array([len(u) for u in us], pa.int64())
                yield pa.record_batch([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.int32()), size, pa.array(us, pa.binary())], names=["id", "level", "bytes", "u"])

    return docs.mapInArrow(build, "id long, level int, bytes long, u binary")


def open_units(units: DataFrame, percent: int) -> DataFrame:
    """Verified links of each unit. units: unit, own (whether its members are compared too), role (0 member, 1 visitor), id, level, u; sorted."""

    def run(batches):
        for g in common.groups_of(batches, "unit"):
            role, ids = g.column("role").to_numpy(), g.column("id").to_numpy()
            us = [np.frombuffer(x, np.uint64) for x in g.column("u").to_pylist()]
            level = g.column("level")[0].as_py()  # a group's sets are of one level
            sig = [parts(u, level, percent)[0] for u in us]
            size = np.array([len(u) for u in us])
            m = np.stack(sig)
            done, links = common.Sets(len(ids)), []
            members = np.flatnonzero(role == 0)
            pairs = []
            for i in range(len(ids)):
                if role[i] == 0 and not g.column("own")[i].as_py():
                    continue
                other = members[members > i] if role[i] == 0 else members
                if not len(other):
                    continue
                share = (m[other] == m[i]).sum(1)
                ok = share >= m.shape[1] - most_apart(size[other] + size[i], percent)
                pairs += [(-int(s), i, int(j)) for s, j in zip(share[ok], other[ok], strict=True)]
            for _, i, j in sorted(pairs):
                a, b = done.find(i), done.find(j)
                if a == b:
                    continue
                both = len(np.intersect1d(us[i], us[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    done.join(i, j)
                    if ids[i] != ids[j]:
                        links.append((int(ids[i]), int(ids[j])))
            if links:
                yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return units.mapInArrow(run, "a long, b long")


def join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Each document's id, n_shingles and component_id."""
    common.ready(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    every = common.written(classes(rows, shingle, percent), "sets")
    one = every.where("level > 0 and id is not null").groupBy("k", "level").agg(F.min_by(F.struct("id", "owner", "need"), "id").alias("o")).select("level", "o.*")
    one = common.written(one, "classes")
    members = every.where("main").select("id", "k", "n")
    # 1: classes with enough tokens that another class has too; about one token a part, a part of some percent of a set
    size = every.agg(F.sum(F.expr("shiftleft(1L, level)"))).first()[0] or 0
    met = common.written(shared_tokens(common.about(rows, one.select("id").distinct(), "id"), common.range_bits(size), shingle, percent), "met")
    active = met.groupBy("owner").agg(F.count("*").alias("n"), F.max(F.struct("c", "t")).alias("top")).join(one, "owner").where("n >= need")
    active = common.written(active.select("owner", "id", "level", "need", "top.t"), "active")
    # 2: groups, and blocks within them
    split = active.groupBy("level", "t").agg(F.count("*").alias("n")).withColumn("groups", F.ceil(F.col("n") / GROUP)).withColumn("blocks", F.ceil(F.col("n") / F.col("groups") / BLOCK).cast("int"))
    group = F.xxhash64("level", "t", F.pmod(F.xxhash64("id"), F.col("groups")))
    grouped = active.join(split, ["level", "t"]).select("owner", "id", "level", "need", group.alias("g"), "blocks", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int").alias("b"))
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.xxhash64("id", F.lit(2)), "id"))
    grouped = common.written(grouped.withColumn("pivot", place <= PIVOTS), "groups")
    # 3: the matrix, and the groups that pivots may have links in
    mine = common.written(met.select("owner", "t").join(grouped, "owner").select("t", "id", "level", "need", "g", "pivot"), "tokens")
    common.drop(met)
    matrix = mine.select("t", "g").distinct().select("t", F.col("g").alias("to"))

    def opened(rows: DataFrame, matrix: DataFrame, where: str = "true") -> DataFrame:
        """id, level and the groups that have as many of its tokens as it needs."""
        shared = rows.join(matrix, (rows["t"] == matrix["t"]) & F.expr(f"`to` > g and ({where})"))
        return shared.groupBy("id", "level", "need", "to").agg(F.count("*").alias("c")).where("c >= need").select("id", "level", F.col("to").alias("g"))

    qualify = common.written(opened(mine.where("pivot"), matrix), "qualify")
    sets = common.written(full_sets(common.restrict(rows, active.select("id").distinct(), "id"), shingle, percent), "full")
    once = sets.agg(F.sum("bytes")).first()[0] or 1
    tables: list[DataFrame] = []
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    unit = lambda *of: F.xxhash64(*of).alias("unit")
    as_host, as_guest, alike = ([F.lit(own).alias("own"), F.lit(role).alias("role"), "id", "level"] for own, role in ((False, 0), (False, 1), (True, 0)))

    def visiting(who: DataFrame, hosts: DataFrame, name: str) -> DataFrame:
        """Units of who (id, level, g) and hosts (id, level, g and block) of their groups, about BLOCK visitors in each."""
        visits = who.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("visits"), F.first("blocks").alias("n"))
        at = hosts.join(visits, "g").select("*", upto("visits").alias("v")).select(unit("g", "block", "v", F.lit(name)), *as_host)
        come = who.join(visits, "g").withColumn("v", F.pmod(F.xxhash64("id"), F.col("visits")).cast("int")).select("*", upto("n").alias("block"))
        return at.unionByName(come.select(unit("g", "block", "v", F.lit(name)), *as_guest))

    def links_in(units: DataFrame) -> DataFrame:
        """The links of units, a slice of them after another: the sets of one slice, about as many bytes as all sets have once, are on disk at once."""
        units, links = common.written(units, "units"), None
        placed = units.groupBy("id", "level").agg(F.count("*").alias("times")).join(sets.select("id", "level", "bytes"), ["id", "level"])
        slices = max(1, -(-(placed.agg(F.sum(F.col("times") * F.col("bytes"))).first()[0] or 0) // once))
        for i in range(slices):
            part = units.where(F.pmod(F.xxhash64("unit", F.lit("slice")), F.lit(slices)) == i)
            part = part.join(sets, ["id", "level"]).select("unit", "own", "role", "id", "level", "u")
            found = common.written(open_units(part.repartition("unit").sortWithinPartitions("unit", "role", "id"), percent), "links")
            links = found if links is None else links.unionByName(found)
            tables.append(found)
            common.freed(units.sparkSession)
        common.drop(units)
        return links

    # 4: each block with its group's pivots, and pivots with those of the groups that they may have links in
    pivots = grouped.where("pivot")
    units = grouped.select(unit("g", "b", F.lit("block")), *alike)
    units = units.unionByName(pivots.select("*", upto("blocks").alias("to")).where("b <> to").select(unit("g", "to", F.lit("block")), *alike))
    come = qualify.withColumn("blocks", F.lit(1))
    links = links_in(units.unionByName(visiting(come, pivots.select("id", "level", "g", F.lit(0).alias("block")), "pivots")))
    found = common.components(links)
    roots = found.withColumnRenamed("id", "r")
    rooted = common.written(grouped.join(roots, grouped["id"] == F.col("r"), "left").select("id", "level", "g", "blocks", "b", F.coalesce("root", "id").alias("root")), "rooted")
    common.drop(grouped, found)
    # 5: what isn't connected by then: pairs of blocks of a group of several components, and visitors of a group in which classes of other
    # components have the tokens
    mixed = rooted.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("blocks").alias("blocks"))
    apart = rooted.join(mixed.where("lo <> hi and blocks > 1").select("g"), "g", "left_semi").select("*", upto("blocks").alias("to")).where("b <> to")
    apart = apart.select(unit("g", F.least("b", "to"), F.greatest("b", "to")), F.lit(False).alias("own"), (F.col("b") > F.col("to")).cast("int").alias("role"), "id", "level")
    of = mine.join(rooted.select("id", "level", "root"), ["id", "level"])
    others = of.groupBy("t", F.col("g").alias("to")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    later = common.written(opened(of, others, "lo <> hi or root <> lo"), "qualify")
    common.drop(mine)
    come = later.join(mixed.select("g", "blocks"), "g").select("id", "level", "g", "blocks")
    more = links_in(apart.unionByName(visiting(come, rooted.select("id", "level", "g", F.col("b").alias("block")), "blocks")))
    # 6; rows that share a doc_id link their classes
    first = members.where("n > 0").groupBy("k").agg(F.min("id").alias("c"))
    several = members.where("n > 0 and id is not null").groupBy("id").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi").select("id")
    shared = members.where("n > 0").join(several, "id").join(first, "k").select(F.col("id").alias("a"), F.col("c").alias("b"))
    roots = common.components(links.unionByName(more).unionByName(shared))
    common.drop(one, active, qualify, later, sets, rooted, *tables)
    first = first.join(roots, first["c"] == roots["id"], "left").select("k", F.coalesce("root", "c").alias("root"))
    out = members.join(first, "k", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id"))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(common.documents(spark, sf_dir))
