"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find by stars.

Every element of a set of 5-word shingles draws, round by round, another slot of its own permutation of all slots, with
the round number as the whole part of its rank: ranks of one element are correlated, which lowers the variance. A
signature is done as soon as each slot holds a value below the round number, so long texts need two or three rounds.
Rounds run over all elements of a segment at once.

Rows with equal sets are one class before banding. For each class that shares a band with another, `common` counts its
shingles that any other such class holds; if they are too few, it is like none. Each class is compared with one leader: of
the leaders of its bands the one with the fewest shingles of its own, the text that the others were copied from. Classes
that stay alone choose leaders among themselves and are compared again, as long as that links a tenth of them. All of this is linear
in the classes of a group, however many copies it has.

What is left are pairs of classes that share a band and lie in different components. Two classes a, b of one leader L
have at most min(|a & L|, |b & L|) + e shingles in common, where e counts those outside L that both hold. One of them
isn't like L, so the first part suffices only where the other is shorter than L; all other pairs must share a shingle
outside L. These two kinds are found by joins on the band and on the shingle, and pairs of different leaders by a join on
the band under a bound by `common`; what the bounds don't refute is compared. With 32 bands of 4, a pair at the threshold
of 0.75 shares a band in all but 5 of a million cases. Links are confirmed on whole sets, of shingle hashes of 64 bits made from
word hashes that go lane by lane (common.lane_hashes): two different shingles of a pair of texts are taken for equal, and a
count is one off, once in 2**64 pairs of shingles.

Defined results: texts without words have no set and no links; fewer than five words are one shingle; a null id isn't
linked (its component is null, it stays); rows with the same id and the same text share their result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import segments as S
from .common import Rolling, Words, mix, stored
from .components import components

SHINGLE, BANDS, ROWS = 5, 32, 4
SLOTS = BANDS * ROWS


def shingle_sets(seg: S.Segment, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every document of a segment, sorted within each; and where each document's begin."""
    words = Words(seg.buf, seg.bounds, lower=True)
    hashes, n = words.hashes(), len(seg.keys)
    at = np.flatnonzero(words.room(width))
    roll = Rolling(hashes)
    few = np.flatnonzero((words.counts > 0) & (words.counts < width))
    h = np.concatenate([roll.spans(at, at + width), roll.spans(words.first[few], words.first[few + 1])])
    doc = np.concatenate([words.doc[at], few])
    by = np.lexsort([h, doc])
    h, doc = h[by], doc[by]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(n + 1))


def signatures(h: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, documents by slots, as floats; infinite for empty sets."""
    n = len(first) - 1
    out = np.full((n, slots), np.inf)
    flat = out.ravel()
    doc = np.repeat(np.arange(n), np.diff(first))
    element, swaps = h, np.tile(np.arange(slots, dtype=np.uint8), (len(h), 1)) if slots <= 256 else None
    for j in range(slots):
        if not len(element):
            break
        draw = mix(element + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64))
        rank = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + j
        k = j + ((mix(draw) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(element))
        slot = swaps[rows, k]
        swaps[rows, k] = swaps[:, j]
        np.minimum.at(flat, doc * slots + slot, rank)
        done = out.max(axis=1) <= j + 1  # later rounds bring larger values only
        go = ~done[doc]
        if not go.all():
            element, doc, swaps = element[go], doc[go], swaps[go]
    return out


def _describe(seg: S.Segment):
    """A row for each document: its place, set size, set fingerprint and band keys."""
    h, first = shingle_sets(seg)
    sizes = np.diff(first)
    n = len(sizes)
    bands = np.zeros((n, BANDS), np.int64)
    for a in range(0, n, 64):  # permutations of the elements of a few documents at a time
        for b, c in _slices(first, a, min(n, a + 64)):
            bits = np.ascontiguousarray(signatures(h[first[b] : first[c]], first[b : c + 1] - first[b])).view(np.uint64).reshape(c - b, BANDS, ROWS)
            key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (c - b, BANDS)).copy()
            for r in range(ROWS):
                key = mix(key * np.uint64(31) + bits[:, :, r])
            bands[b:c] = key.view(np.int64)
    prints = [Rolling(h, k).spans(first[:-1], first[1:]).view(np.int64) for k in (0, 1)]
    offsets = np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)
    ids = pa.array(seg.keys, mask=seg.keys == S.LAST)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, seg.seg)), pa.array(np.arange(n, dtype=np.int32)), ids, pa.array(sizes.astype(np.int64)), *map(pa.array, prints), pa.ListArray.from_arrays(offsets, bands.ravel())],
        names=["seg", "row", "id", "n_shingles", "print_a", "print_b", "bands"],
    )


def _slices(first: np.ndarray, a: int, b: int, most: int = 1 << 16):
    """Documents a to b in runs of at most `most` elements; one longer document is its own run."""
    while a < b:
        c = min(b, max(a + 1, int(np.searchsorted(first, first[a] + most, "right")) - 1))
        yield a, c
        a = c


def _deal_bands(n: int):
    def run(batches):
        for batch in batches:
            bands = batch.column(1).flatten().to_numpy().view(np.uint64)
            ids = np.repeat(batch.column(0).to_numpy(), BANDS)
            if len(bands):
                yield S.dealt(0, n, bands, {"band": bands, "id": ids})

    return run


def _shared_bands(table: pa.Table) -> pa.Table:
    """Of one hash bucket: the members of bands that have two at least."""
    bands, ids = S.gather(table, "band", np.uint64), S.gather(table, "id", np.int64)
    order = np.lexsort([ids, bands])
    bands, ids = bands[order], ids[order]
    same = np.zeros(len(bands) + 1, bool)
    same[1:-1] = bands[1:] == bands[:-1]
    many = same[:-1] | same[1:]
    return pa.table({"band": bands[many].view(np.int64), "id": ids[many]})


def _send_sets(seg: S.Segment, replies: pa.Table) -> pa.Table:
    rows, ids = replies.column("row").to_numpy(), replies.column("id").to_numpy()
    if not len(rows):
        return SETS.empty_table()
    h, first = shingle_sets(seg)
    return pa.table({"id": ids, "n": np.diff(first)[rows], "shingles": [h[first[r] : first[r + 1]].tobytes() for r in rows]}, schema=SETS)


SETS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])


def _deal_shingles(n: int):
    def run(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            h = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)
            if len(h):
                yield S.dealt(0, n, h, {"h": h, "id": np.repeat(batch.column(0).to_numpy(), sizes)})

    return run


def _count_common(n: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one hash bucket: for each class the number of shingles that another has, packed by buckets of classes."""
        h, ids = S.gather(table, "h", np.uint64), S.gather(table, "id", np.int64)
        order = np.argsort(h, kind="stable")
        h, ids = h[order], ids[order]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        id_, counts = np.unique(ids[same[:-1] | same[1:]], return_counts=True)
        return pa.Table.from_batches([S.dealt(0, n, mix(id_.view(np.uint64)), {"id": id_, "common": counts.astype(np.int64)})])

    return run


def _sum_common(table: pa.Table) -> pa.Table:
    ids, counts = S.gather(table, "id", np.int64), S.gather(table, "common", np.int64)
    id_, at = np.unique(ids, return_inverse=True)
    return pa.table({"id": id_, "common": np.bincount(at, counts, len(id_)).astype(np.int64)})


def _compare(batches):
    """Of a class and its leader with their sets: the shingles that both have, counted, and those that the leader lacks."""
    for batch in batches:
        inter, extra = [], []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            out = np.setdiff1d(a, b, assume_unique=True)
            inter.append(len(a) - len(out))
            extra.append(out.tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(inter, pa.int64()), pa.array(extra, pa.binary())], names=["id", "leader", "inter", "extra"])


def _deal_extras(n: int):
    def run(batches):
        for batch in batches:
            extra = batch.column(2).to_pylist()
            sizes = np.array([len(x) // 8 for x in extra], np.int64)
            h = np.frombuffer(b"".join(extra), np.uint64)
            if len(h):
                key = mix(h ^ mix(np.repeat(batch.column(1).to_numpy().view(np.uint64), sizes)))
                yield S.dealt(0, n, key, {"key": key, "id": np.repeat(batch.column(0).to_numpy(), sizes)})

    return run


def _shared_extras(table: pa.Table) -> pa.Table:
    """Of one hash bucket: the holders of shingles outside their leader that two classes of it have."""
    key, ids = S.gather(table, "key", np.uint64), S.gather(table, "id", np.int64)
    order = np.lexsort([ids, key])
    key, ids = key[order], ids[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    many = same[:-1] | same[1:]
    return pa.table({"key": key[many].view(np.int64), "id": ids[many]})


def _links(batches):
    for batch in batches:
        out = {"u": [], "v": []}
        for u, v, a, b in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= 75 * (len(a) + len(b) - both):
                out["u"].append(u)
                out["v"].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def _verify(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs u, v of classes those whose whole sets are alike."""
    a, b = (sets.select(F.col("id").alias(c), F.col("shingles").alias(d)) for c, d in (("u", "a"), ("v", "b")))
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")
    return stored(both.mapInArrow(_links, "u long, v long"), "links")


def _bound(inter: str, a: str, b: str) -> str:
    """That two sets of sizes a and b with at most `inter` shingles in common may be alike."""
    return f"100 * ({inter}) >= 75 * ({a} + {b} - ({inter}))"


#: Whether a pair may be alike, by the sizes of two sets and the shingles of each that occur elsewhere.
MAYBE = "100 * least(a.common, b.common) >= 75 * (greatest(a.common, b.common) + a.n - a.common + b.n - b.common)"


def _led(members: DataFrame) -> DataFrame:
    """id and leader of the classes that share a band with a class of fewer own shingles."""
    own = "struct((n - common) / n as own, id)"
    leaders = members.groupBy("band").agg(F.expr(f"min({own})").alias("l"), F.count("*").alias("k")).where("k > 1")
    led = members.join(leaders, "band").where("id <> l.id")
    return led.groupBy("id").agg(F.min("l").alias("l")).selectExpr("id", "l.id as leader")


def _pairs(a: DataFrame, b: DataFrame, on: str, also: str) -> DataFrame:
    """Pairs u < v of classes of different components that meet on a key."""
    met = a.alias("a").join(b.alias("b"), F.expr(f"a.{on} = b.{on} and a.component <> b.component and {also}"))
    return met.selectExpr("least(a.id, b.id) as u", "greatest(a.id, b.id) as v")


def find_groups(packed: S.Packed) -> DataFrame:
    """seg, row, id, n_shingles and component of every document of packed segments."""
    rows = stored(packed.ask(_describe, "seg long, row int, id long, n_shingles long, print_a long, print_b long, bands array<bigint>"), "described")
    linked = rows.where("n_shingles > 0 and id is not null")
    classes = linked.groupBy("print_a", "print_b", "n_shingles").agg(F.min(F.struct("id", "seg", "row")).alias("least"))
    classes = stored(classes.selectExpr("print_a", "print_b", "n_shingles", "least.id as id", "least.seg as seg", "least.row as row"), "classes")
    # An id that stands for several classes (rows with one id and several texts) is one node, of the place of one of them.
    places = stored(classes.groupBy("id").agg(F.min(F.struct("seg", "row")).alias("p")).selectExpr("id", "p.seg as seg", "p.row as row"), "places")
    n = packed.hash_buckets()
    banded = rows.select("seg", "row", "bands").join(places, ["seg", "row"]).select("id", "bands").mapInArrow(_deal_bands(n), "bucket long, seg long, band binary, id binary")
    members = stored(S.settle(banded, _shared_bands, "band long, id long"), "members")
    asked = members.select("id").distinct().join(places, "id").select("seg", "row", "id")
    sets = stored(packed.answer(asked, _send_sets, "id long, n long, shingles binary"), "sets")
    some = max(16, n // 16)
    counted = S.settle(sets.mapInArrow(_deal_shingles(n), "bucket long, seg long, h binary, id binary"), _count_common(some), "bucket long, seg long, id binary, common binary")
    common = S.settle(counted, _sum_common, "id long, common long")
    info = sets.select("id", "n").join(common, "id").where("100 * common >= 75 * n")  # else nothing is alike
    members = stored(members.join(info, "id"), "members")
    led = stored(_led(members), "led")
    shingles = sets.select("id", "shingles")
    both = led.join(shingles, "id").join(shingles.toDF("leader", "b"), "leader").select("id", "leader", "shingles", "b")
    compared = stored(both.mapInArrow(_compare, "id long, leader long, inter long, extra binary").join(sets.select("id", "n"), "id").join(sets.select(F.col("id").alias("leader"), F.col("n").alias("leader_n")), "leader"), "compared")
    tried = led.selectExpr("least(id, leader) as u", "greatest(id, leader) as v").distinct()
    links = compared.where(_bound("inter", "n", "leader_n")).selectExpr("least(id, leader) as u", "greatest(id, leader) as v").distinct()
    links = stored(links, "links")
    rest = members
    while True:
        rest = stored(rest.join(links.selectExpr("explode(array(u, v)) as id").distinct(), "id", "left_anti"), "rest")
        again = _led(rest).selectExpr("least(id, leader) as u", "greatest(id, leader) as v").distinct()
        again = stored(again.join(tried, ["u", "v"], "left_anti"), "again")
        if again.isEmpty():
            break
        more = _verify(sets, again)
        tried = tried.union(again)
        links = stored(links.union(more), "links")
        if 10 * more.count() < again.count():  # the rest is left to the joins below, which are exact
            break
    labels = stored(components(links), "labels")
    whole = members.select("id", "n", "common").distinct().join(compared.select("id", "leader", "inter", "leader_n"), "id", "left").join(labels.withColumnRenamed("node", "id"), "id", "left")
    whole = whole.select("id", "n", "common", F.coalesce("leader", "id").alias("leader"), F.coalesce("inter", "n").alias("inter"), F.coalesce("leader_n", "n").alias("leader_n"), F.coalesce("component", "id").alias("component"))
    whole = whole.join(labels.select(F.col("node").alias("leader"), F.col("component").alias("lc")), "leader", "left").withColumn("outside", F.expr("component <> coalesce(lc, leader)")).drop("lc")
    whole = stored(whole, "whole")
    of = members.select("band", "id").join(whole, "id")
    mixed = of.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.mode("leader", True).alias("main")).where("low < high").select("band", "main")
    of = stored(of.join(mixed, "band"), "of")
    # One leader, enough of it in both: the other is shorter than the leader.
    short = _pairs(of.where("outside"), of.where("n < leader_n"), "band", f"a.leader = b.leader and {_bound('least(a.inter, b.inter)', 'a.n', 'b.n')}")
    # One leader, and a shingle outside it that both have.
    extras = compared.select("id", "leader", "extra").join(of.select("id").distinct(), "id", "left_semi")
    held = S.settle(extras.mapInArrow(_deal_extras(n), "bucket long, seg long, key binary, id binary"), _shared_extras, "key long, id long")
    held = stored(held, "held")
    shared = held.groupBy("id").agg(F.count("*").alias("extra"))
    held = held.join(whole.join(shared, "id"), "id")
    alike = _bound("least(a.inter, b.inter) + least(a.extra, b.extra)", "a.n", "b.n")
    beyond = _pairs(held.where("outside"), held, "key", f"a.leader = b.leader and {alike}")
    # Different leaders: one of them isn't the band's most frequent.
    apart = _pairs(of.where("leader <> main"), of, "band", "a.leader <> b.leader and " + MAYBE)
    left = stored(short.union(beyond).union(apart).distinct(), "left")
    left = stored(left.join(tried, ["u", "v"], "left_anti"), "left")
    more = _verify(sets, left)
    if not more.isEmpty():
        labels = stored(components(links.union(more)), "labels")
    named = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").select("print_a", "print_b", "n_shingles", F.coalesce("component", "id").alias("component"))
    found = linked.select("seg", "row", "id", "n_shingles", "print_a", "print_b").join(named, ["print_a", "print_b", "n_shingles"]).select("seg", "row", "id", "n_shingles", "component")
    alone = rows.where("n_shingles = 0 or id is null").select("seg", "row", "id", "n_shingles", F.col("id").alias("component"))
    return found.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs."""
    found = find_groups(S.Packed(docs, id_col, text_col, [id_col]))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.expr("id <=> component").alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, all columns: of each group of near duplicates one stays, that with the smallest id (of equal rows, each)."""
    packed = S.Packed(docs, id_col, text_col, docs.columns)
    kept = stored(find_groups(packed).where("id <=> component").select("seg", "row"), "kept")
    kind = T.StructType(packed.carry)
    schema = to_arrow_schema(kind)

    def pick(seg: S.Segment, replies: pa.Table) -> pa.Table:
        rows = np.sort(replies.column("row").to_numpy()) if replies.num_rows else np.zeros(0, np.int64)
        return seg.rest().take(pa.array(rows)).cast(schema)

    return packed.answer(kept, pick, kind).toDF(*docs.columns)


def op3_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS x FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
j AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM j JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 75 * (a.n + b.n - k)),
c(node, label) AS (SELECT u, u FROM e UNION SELECT e.v, c.label FROM c JOIN e ON e.u = c.node WHERE c.label < e.v),
m AS (SELECT node, min(label) AS component FROM c GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(coalesce(component, w.doc_id), w.doc_id) AS component_id, least(coalesce(component, w.doc_id), w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.node = w.doc_id
"""
