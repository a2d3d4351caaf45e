"""Vector code compression: product codes by Lloyd's iterations with Hamerly's bounds, in whole numbers.

Each vector is cut into `parts` equal consecutive parts and each part position has a codebook of its own. Components are
whole numbers, floor(scale * x), so distances are exact and every result is the same on any cluster. With each part are
kept its entry, one upper bound of the distance to it and one lower bound of the distance to any other entry. A round
moves the bounds by what the entries have moved; only where the upper bound isn't strictly below the lower one (nor below
half the way to the nearest other entry) the exact distance is taken, and only where that fails too are all entries
scanned. Bounds are rounded outwards after every step, and ties fail them, so the lower index wins as in a full scan.

A round is one pass that writes the next state to the shared folder (the one before goes then), and one that sums parts by
entry: at most entries * parts rows leave a partition, whatever it holds, and as many reach the driver.

Defined results: rows whose vector is null or empty, holds null or non-finite components, or has another length than most
(of equally frequent lengths the longest counts) are dropped; where parts don't divide the length, zeros are appended; with
fewer kept vectors than `entries` the codebooks are as short; a null id comes after all others, equal ids go by their
components; repeated rows count as often as they are there; scaled components beyond what leaves errors within 63 bits are
set to that bound; an empty table gives no rows. Other columns may have any names.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import discard, made, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
EXACT = 1 << 52  # below it, sums of products are exact in double precision
BLOCK = 2048  # vectors scanned at a time


def up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, np.inf)


def down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, -np.inf)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole numbers, vectors by entries, exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[None, :, i]) ** 2
    return out


def own_distances(x: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    return ((x - entries[code]) ** 2).sum(1)


class Codebook:
    """The entries of one part position, with what bounds need: how far each moved, and half the way to its nearest neighbour."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        k = len(entries)
        between = distances(entries, entries)
        between[np.arange(k), np.arange(k)] = np.iinfo(np.int64).max
        self.half = down(np.sqrt(between.min(1).astype(np.float64)) / 2) if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else up(np.sqrt(((entries - before) ** 2).sum(1).astype(np.float64)))
        self.moved = moved
        far = np.sort(moved)[::-1]
        self.others = np.where(moved == far[0], far[1] if k > 1 else 0.0, far[0]) if k else moved
        if k > 1 and far[0] == far[1]:
            self.others[:] = far[0]

    def assign(self, x: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries and bounds of parts after a move; and which parts were scanned."""
        upper, lower = up(upper + self.moved[code]), down(lower - self.others[code])
        least = np.maximum(lower, self.half[code])
        open_ = np.flatnonzero(~(upper < least))
        upper[open_] = up(np.sqrt(own_distances(x[open_], self.entries, code[open_]).astype(np.float64)))
        scan = open_[~(upper[open_] < least[open_])]
        code = code.copy()
        code[scan], upper[scan], lower[scan] = self.scan(x[scan])
        scanned = np.zeros(len(x), bool)
        scanned[scan] = True
        return code, upper, lower, scanned

    def scan(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entries (of equal ones the first) and the bounds that the two smallest distances give."""
        code, upper, lower = np.zeros(len(x), np.int64), np.zeros(len(x)), np.full(len(x), np.inf)
        for a in range(0, len(x), BLOCK):
            d = distances(x[a : a + BLOCK], self.entries)
            rows = np.arange(len(d))
            c = d.argmin(1)
            code[a : a + BLOCK], upper[a : a + BLOCK] = c, up(np.sqrt(d[rows, c].astype(np.float64)))
            if d.shape[1] > 1:
                d[rows, c] = np.iinfo(np.int64).max
                lower[a : a + BLOCK] = down(np.sqrt(d.min(1).astype(np.float64)))
        return code, upper, lower


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32), pa.array(values.ravel(), kind))


def _step(books: list[Codebook], dim: int, first: bool, schema: pa.Schema):
    """One pass: state to state. In the first there are no bounds, so all parts are scanned."""
    parts, width = len(books), dim // len(books)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("__ints"), np.int64, dim)
            n = len(x)
            code, upper, lower = (np.zeros((n, parts), t) for t in (np.int64, np.float64, np.float64))
            if not first:
                code, upper, lower = _matrix(batch.column("__code"), np.int64, parts), _matrix(batch.column("__upper"), np.float64, parts), _matrix(batch.column("__lower"), np.float64, parts)
            scans = np.zeros(n, np.int64) if first else batch.column("__scans").to_numpy().astype(np.int64)
            for p, book in enumerate(books):
                part = x[:, p * width : (p + 1) * width]
                if first:
                    code[:, p], upper[:, p], lower[:, p] = book.scan(part)
                    scans = scans + 1
                else:
                    code[:, p], upper[:, p], lower[:, p], scanned = book.assign(part, code[:, p], upper[:, p], lower[:, p])
                    scans = scans + scanned
            state = {"__code": _lists(code, pa.int32()), "__upper": _lists(upper, pa.float64()), "__lower": _lists(lower, pa.float64()), "__scans": pa.array(scans, pa.int64())}
            yield pa.RecordBatch.from_arrays([state[f.name] if f.name in state else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def _sums(parts: int, entries: int, dim: int):
    """Of a partition: for each part position and entry in use the sum of its parts and their number."""
    width = dim // parts

    def run(batches):
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x, code = _matrix(batch.column(0), np.int64, dim), _matrix(batch.column(1), np.int64, parts)
            for p in range(parts):
                np.add.at(total[p], code[:, p], x[:, p * width : (p + 1) * width])
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), _lists(total[p, e], pa.int64())], names=["part", "entry", "n", "sums"])

    return run


def _moved(state: DataFrame, books: list[Codebook], dim: int) -> list[Codebook]:
    """Each entry becomes the floor of the mean of its parts; entries without any stay."""
    parts, k = len(books), len(books[0].entries)
    width = dim // parts
    rows = state.select("__ints", "__code").mapInArrow(_sums(parts, k, dim), "part int, entry int, n long, sums array<bigint>")
    total = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
    entries = [b.entries.copy() for b in books]
    for r in total.collect():  # parts * entries rows at most
        entries[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return [Codebook(e, b.entries) for e, b in zip(entries, books)]


def _errors(books: list[Codebook], dim: int, schema: pa.Schema):
    """Codes as text, and the exact distances to their entries."""
    width = dim // len(books)

    def run(batches):
        for batch in batches:
            x, code = _matrix(batch.column("__ints"), np.int64, dim), _matrix(batch.column("__code"), np.int64, len(books))
            error = sum((own_distances(x[:, p * width : (p + 1) * width], b.entries, code[:, p]) for p, b in enumerate(books)), np.zeros(len(x), np.int64))
            last = {"__hex": pa.array(["".join(f"{c:02x}" for c in row) for row in code.tolist()], pa.string()), "__error": pa.array(error)}
            yield pa.RecordBatch.from_arrays([last[f.name] if f.name in last else batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return run


def whole_numbers(vectors: DataFrame, vec_col: str, carry: list[str], parts: int, scale: int) -> tuple[DataFrame, int]:
    """The kept rows with c0, c1, ... carried and __ints; and the length of those."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    kept = vectors.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)), v.alias("__v")).where("size(__v) > 0 and forall(__v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    most = kept.groupBy(F.size("__v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return kept.select(*kept.columns[:-1], F.lit(None).cast("array<int>").alias("__ints")), 0
    dim = -(-most["dim"] // parts) * parts
    bound = 1 << min(30, (61 - math.ceil(math.log2(dim))) // 2)
    whole = F.expr(f"transform(__v, x -> cast(greatest(least(floor({scale} * x), {bound}), -{bound}) as int))")
    ints = F.concat(whole, F.array_repeat(F.lit(0), dim - most["dim"])) if dim > most["dim"] else whole
    return kept.where(F.size("__v") == most["dim"]).select(*kept.columns[:-1], ints.alias("__ints")), dim


class Compressed:
    """rows: the carried columns, code, error and scans; books: the final entries, parts by entries by components."""

    def __init__(self, rows: DataFrame, books: np.ndarray):
        self.rows, self.books = rows, books

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def vectors(self, codes: list[str], scale: int = SCALE) -> np.ndarray:
        """What codes stand for: entries side by side, in units of the vectors."""
        at = np.array([[int(c[i : i + 2], 16) for i in range(0, len(c), 2)] for c in codes], np.int64)
        return np.concatenate([self.books[p][at[:, p]] for p in range(len(self.books))], axis=1) / scale


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", carry: list[str] | None = None, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes of vectors. Codebooks start as the parts of the `entries` smallest ids (256 at most: a code has two hex digits a part)."""
    if not 0 < entries <= 256:
        raise ValueError("entries are numbered by two hex digits")
    spark, carry = vectors.sparkSession, [id_col] if carry is None else carry
    names = [id_col, *carry]
    kept, dim = whole_numbers(vectors, vec_col, names, parts, scale)
    fields = kept.schema.fields
    out = T.StructType([*fields[1:-1], T.StructField("__hex", T.StringType()), T.StructField("__error", T.LongType()), T.StructField("__scans", T.LongType())])
    named = [F.col(f"c{i + 1}").alias(c) for i, c in enumerate(carry)]
    told = [F.col("__hex").alias("code"), F.col("__error").alias("error"), F.col("__scans").alias("scans")]
    if not dim:
        return Compressed(spark.createDataFrame([], out).select(*named, *told), np.zeros((parts, 0, 0), np.int64))
    state = stored(kept, "vectors")
    ids = F.col("c0").asc_nulls_last()
    start = np.array([r[0] for r in state.orderBy(ids, "__ints").select("__ints").limit(entries).collect()], np.int64)
    books = [Codebook(part) for part in np.split(start, parts, axis=1)]
    kind = T.StructType([*fields, *(T.StructField(c, T.ArrayType(t)) for c, t in (("__code", T.IntegerType()), ("__upper", T.DoubleType()), ("__lower", T.DoubleType()))), T.StructField("__scans", T.LongType())])
    for turn in range(rounds + 1):
        before = made[-1]
        state = stored(state.mapInArrow(_step(books, dim, turn == 0, to_arrow_schema(kind)), kind), "codes")
        discard(spark, [before])
        if turn < rounds:
            books = _moved(state, books, dim)
    rows = state.mapInArrow(_errors(books, dim, to_arrow_schema(out)), out)
    return Compressed(rows.select(*named, *told), np.array([b.entries for b in books]))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    done = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=["vec_id", "label"])
    rows = done.rows
    labels = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(done.sha256()).alias("codebooks_sha256"))


def _oracle() -> str:
    steps = [
        "k AS (SELECT vec_id, label, [CAST(floor(1024 * CAST(a AS DOUBLE)) AS BIGINT) FOR a IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR a IN embedding IF a IS NULL OR NOT isfinite(a)]) = 0)",
        "x AS (SELECT vec_id, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM k, range(4) r(p))",
        "c0 AS (SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM x) WHERE e < 256)",
    ]
    for r in range(5):
        steps.append(f"a{r} AS (SELECT x.vec_id, x.p, min((list_sum([(u[1] - u[2]) * (u[1] - u[2]) FOR u IN list_zip(x.x, c.c)]), c.e)) AS best FROM x JOIN c{r} c USING (p) GROUP BY ALL)")
        if r < 4:
            steps.append(f"m{r} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT a.p, a.best[2] AS e, i, CAST((sum(x.x[i]) - ((sum(x.x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM a{r} a JOIN x USING (vec_id, p), range(1, 1 + len(x.x)) g(i) GROUP BY ALL) GROUP BY ALL)")
            steps.append(f"c{r + 1} AS (SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (p, e))")
    return (
        "WITH "
        + ",\n".join(steps)
        + """,
f AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a4 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f JOIN k USING (vec_id), s"""
    )


ORACLE = _oracle()
