"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Equal vectors are one entry that keeps as many ids as a result can need. Trees split by random directions at medians of
a bounded sample (`sample` vectors of smallest hash of the id); the sample fits the trees only, and every vector is
indexed. A query descends all trees at once through one priority queue, ordered by the squared distances to the split
planes it has crossed, and takes the `probe` share of a tree's number of leaves. Leaves meet their queries by a join;
what they hold is scored exactly, in double precision, on the original vectors.

On directionless data (random unit vectors, 64 dimensions) no index prunes much: recall above 0.9 at 20 takes more than half of
all vectors. Lower `probe` where vectors cluster. Leaves hold about `leaf_rows` vectors; if the sample is too small for so
many leaves, each is dealt over a grid of tasks: shares of its vectors (4 times `leaf_rows` at most) by shares of its
queries (`leaf_queries` on average), so neither side of a group grows with the table.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; equal scores go to the smaller id; rows with one id and several vectors are entries of their own; an empty table
gives no rows; a query's own id is never among its results. Other columns may have any names, those used here included.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, stored

TREES, LEAF_ROWS, LEAF_QUERIES, SAMPLE, PROBE = 8, 1000, 1 << 14, 1 << 16, 1.25
ROWS = 1 << 13  # rows that a task makes before it hands them on
RESULT = "query_id long, rank int, vec_id long, score double"


class Forest:
    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.planes = rng.standard_normal((trees, 2**depth - 1, sample.shape[1]))  # node v's children: 2v + 1 and 2v + 2
        self.planes /= np.linalg.norm(self.planes, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, 2**depth - 1))
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                for v in range(2**level - 1, 2 ** (level + 1) - 1):
                    own = np.flatnonzero(node == v)
                    side = sample[own] @ self.planes[t, v]
                    self.cuts[t, v] = np.median(side) if len(own) else 0.0
                    node[own] = 2 * v + 1 + (side > self.cuts[t, v])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered over the forest."""
        out = np.empty((len(vectors), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, self.planes[t, node])
                node = 2 * node + 1 + (side > self.cuts[t, node])
            out[:, t] = t * 2**self.depth + node - (2**self.depth - 1)
        return out

    def probe(self, query: np.ndarray, n: int) -> list[int]:
        """The n leaves that the shared queue yields first."""
        inner = 2**self.depth - 1
        side = (self.planes @ query - self.cuts).tolist()
        queue, out = [(0.0, t, 0) for t in range(self.trees)], []
        while queue and len(out) < n:
            cost, t, v = heapq.heappop(queue)
            if v >= inner:
                out.append(t * 2**self.depth + v - inner)
                continue
            s = side[t][v]
            heapq.heappush(queue, (cost, t, 2 * v + 1 + (s > 0)))
            heapq.heappush(queue, (cost + s * s, t, 2 * v + 1 + (s <= 0)))
        return out


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    parts = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.stack(parts).astype(np.float64) if parts else np.zeros((0, 0))


CALLS = pa.schema([("leaf", pa.int64()), ("q", pa.int64()), ("vector", pa.binary())])


def _dealt(forest: Forest, batches, trees: int, deal: int, shares: int, kind: str):
    """Every entry in its cells (a leaf of each tree, a share of its vectors, each share of its queries), ROWS rows at a time."""
    for batch in batches:
        each = max(1, ROWS // (trees * shares))  # entries of one output batch
        for at in range(0, batch.num_rows, each):
            part = batch.slice(at, each)
            v = np.stack(part.column(0).to_pylist()).astype(float)
            leaf = forest.leaves(v)[:, :trees]
            packed, which = pa.array([x.tobytes() for x in v.astype(kind)], pa.binary()), np.repeat(np.arange(len(v)), trees * shares)
            salt = np.random.default_rng(zlib.crc32(v.tobytes())).integers(0, deal, len(v))  # the same if the task runs again
            cell = (np.repeat(leaf.ravel(), shares) * deal + salt[which]) * shares + np.tile(np.arange(shares), leaf.size)
            yield pa.RecordBatch.from_arrays([pa.array(cell), part.column(1).take(pa.array(which)), packed.take(pa.array(which))], names=["leaf", "ids", "vector"])


def _calls(forest: Forest, batches, probes: int, deal: int, shares: int, kind: str):
    """Every query in the cells that it probes, ROWS rows at a time: a batch of queries makes millions where leaves are many."""

    def rows(cells: list, qs: list, vectors: list) -> pa.RecordBatch:
        which = pa.array(np.repeat(np.arange(len(qs)), [len(c) for c in cells]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(qs, pa.int64()).take(which), pa.array(vectors, pa.binary()).take(which)], schema=CALLS)

    for batch in batches:
        cells, qs, vectors, n = [], [], [], 0
        for q, turn, v in zip(batch.column(0).to_pylist(), _part(batch.column(0).to_numpy(), shares).tolist(), batch.column(1).to_pylist()):
            v = np.array(v, float)
            leaf = np.array(forest.probe(v, probes), np.int64)
            cell = ((leaf[:, None] * deal + np.arange(deal)) * shares + turn).ravel()
            for at in range(0, len(cell), ROWS):
                cells.append(cell[at : at + ROWS])
                qs.append(q)
                vectors.append(v.astype(kind).tobytes())
                n += len(cells[-1])
                if n >= ROWS:
                    yield rows(cells, qs, vectors)
                    cells, qs, vectors, n = [], [], [], 0
        if n:
            yield rows(cells, qs, vectors)


FOUND = pa.schema([("part", pa.int64()), *((c, pa.binary()) for c in ("q", "s", "id"))])


def _nearest(queries: pa.Table, entries: pa.Table, k: int, parts: int, kind: str) -> pa.Table:
    """For each query of a leaf its k nearest ids there: query, negative score and id as arrays, by parts of the queries."""
    if not queries.num_rows or not entries.num_rows:
        return FOUND.empty_table()
    q, v, number = _matrix(queries.column("vector"), kind), _matrix(entries.column("vector"), kind), queries.column("q").to_numpy()
    ids = entries.column("ids").to_pylist()
    least = np.array([i[0] for i in ids])
    copies = any(len(i) > 1 for i in ids)
    whose, scores, names = [], [], []
    for a in range(0, len(q), 512):
        part = q[a : a + 512]
        score = part @ v.T
        take = min(len(v), k + 4)  # a few more than k, as the product's last digits depend on its shape
        near = np.argpartition(-score, take - 1, axis=1)[:, :take]
        edge = np.take_along_axis(score, near, 1).min(axis=1)
        tied = (score >= edge[:, None] - 1e-12).sum(axis=1) > take
        for i, own in enumerate(near):
            if tied[i]:  # ties at the edge: keep all
                own = np.flatnonzero(score[i] >= edge[i] - 1e-12)
            exact = (part[i] * v[own]).sum(axis=1)
            order = np.lexsort([least[own], -exact])[:k]
            if copies:
                found = sorted((-s, x) for s, j in zip(exact[order].tolist(), own[order].tolist()) for x in ids[j])[:k]
                s, x = np.array([f[0] for f in found]), np.array([f[1] for f in found], np.int64)
            else:
                s, x = -exact[order], least[own[order]]
            whose.append(np.full(len(s), number[a + i]))
            scores.append(s)
            names.append(x)
    whose, scores, names = np.concatenate(whose), np.concatenate(scores), np.concatenate(names)
    part = _part(whose, parts)
    order = np.argsort(part, kind="stable")
    found, cuts = np.unique(part[order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    return pa.table({"part": found, **{c: [x[order[i:j]].tobytes() for i, j in zip(cuts, cuts[1:])] for c, x in (("q", whose), ("s", scores), ("id", names))}}, schema=FOUND)


def _part(numbers: np.ndarray, parts: int) -> np.ndarray:
    return (mix(numbers.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _merge(k: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one part of the queries: the k nearest of what all leaves found."""
        q, s, x = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("q", np.int64), ("s", np.float64), ("id", np.int64)))
        order = np.lexsort([x, s, q])
        q, s, x = q[order], s[order], x[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1]) | (x[1:] != x[:-1])
        q, s, x = q[new], s[new], x[new]
        first = np.ones(len(q), bool)
        first[1:] = q[1:] != q[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        near = np.arange(len(q)) - start < k
        q, s, x = q[near], s[near], x[near]
        names, at = np.unique(q, return_index=True)
        offsets = np.append(at, len(q)).astype(np.int32)
        return pa.table({"q": names, "s": pa.ListArray.from_arrays(offsets, s), "id": pa.ListArray.from_arrays(offsets, x)})

    return run


def search(vectors: DataFrame, queries: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, leaf_rows: int = LEAF_ROWS, leaf_queries: int = LEAF_QUERIES, sample: int = SAMPLE, probe: float = PROBE) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found for each row that the SQL condition `queries` holds for."""
    spark = vectors.sparkSession
    good = "vector is not null and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vector, x -> x <> 0)"
    rows = vectors.select("*", F.expr(queries).alias("__asks")).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"), "__asks").where(f"id is not null and {good}")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("vector") == lengths[0]["n"])
    ranked = rows.select("id", "vector").selectExpr("id", "vector", "dense_rank() over (partition by vector order by id) as r").where(f"r <= {k + 1}")
    entries = stored(ranked.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")), "entries")
    n = entries.count()
    fit = entries.select("vector", F.xxhash64(F.col("ids")[0]).alias("h")).orderBy("h").limit(sample).toPandas()["vector"]
    depth = max(0, min(math.ceil(math.log2(max(1, n / leaf_rows))), int(math.log2(max(1, len(fit) / 32)))))
    deal = max(1, math.ceil(n / 2**depth / (4 * leaf_rows)))  # tasks that share a leaf
    forest = spark.sparkContext.broadcast(Forest(np.stack(fit.to_list()).astype(float), trees, depth))
    probes = max(1, math.ceil(probe * 2**depth)) if depth else 1
    trees_used = trees if depth else 1  # one leaf holds all
    asking = rows.where("__asks").select("id", "vector").distinct()
    asked = asking.groupBy("vector").agg(F.min("id").alias("q"))
    n_asked = asked.count()
    shares = max(1, math.ceil(n_asked * probes / (trees_used * 2**depth) / leaf_queries))  # tasks that share a leaf's queries

    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"  # as exact, half the bytes

    def index(batches):
        return _dealt(forest.value, batches, trees_used, deal, shares, kind)

    def ask(batches):
        return _calls(forest.value, batches, probes, deal, shares, kind)

    leaves = entries.select("vector", "ids").mapInArrow(index, "leaf long, ids array<bigint>, vector binary")
    calls = asked.select("q", "vector").mapInArrow(ask, "leaf long, q long, vector binary")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_asked * probes * deal * (k + 1) / (1 << 20)))
    found = leaves.groupBy("leaf").cogroup(calls.groupBy("leaf")).applyInArrow(lambda a, b: _nearest(b, a, k + 1, parts, kind), "part long, q binary, s binary, id binary")
    merged = found.groupBy("part").applyInArrow(_merge(k + 1), "q long, s array<double>, id array<bigint>")
    results = asked.join(merged, "q").selectExpr("vector", "arrays_zip(s, id) as hits")
    own = asking.join(results, "vector").selectExpr("id as query_id", f"posexplode(slice(filter(hits, x -> x.id <> id), 1, {k})) as (pos, hit)")
    return own.selectExpr("query_id", "pos + 1 as rank", "hit.id as vec_id", "-hit.s as score")


def op6_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")
