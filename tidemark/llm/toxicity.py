"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are the words of the lower-cased text; one above STEM bytes also counts as its first STEM bytes, so that forms of a
word meet, and one above LONG bytes (compounds, scripts without spaces) also as all its grams of GRAM bytes. Every term of
the examples is indexed; its tie to the label (chi-square) only weighs it, and never to 0.
Terms in few examples are added up from their postings. The most common ones stand as columns over blocks of examples; a
block's bound is what its postings gave plus the query's weights times its largest weights, and only blocks whose bound
can enter the k nearest are scored. Similarity-weighted votes of the
nearest, drawn to the labels' share where all are far, are made calibrated scores by an isotonic fit to the examples' own votes (each without itself), weighted to the
labels' true share. The nearest examples are the evidence.

The classifier is fitted on a bounded sample: of either label the `per_class` (default 3,000) labelled training rows of
smallest hash of the id, and of those that share a min-hash, so of copies, one. Ids only choose the sample; a score
depends on the text alone, however long it is: all its words count, a piece of STEP bytes or one text at a time.
Defined results: texts without a term of any example, null and empty ones included, get the score of examples without
one; rows without a label aren't learned from; of labels of one id the largest holds; repeated rows each give a row, with
equal scores; examples of equal similarity are taken in the index's order; with no examples of either label the score is
the share of label 1. Carried columns may have any names but score, predicted and neighbours.
"""

from __future__ import annotations

import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import BYTE, Rolling, mix, stored, word_spans
from .language import normal

STEM, LONG, GRAM = 5, 24, 6
PER_CLASS, HALF_CHI2 = 3000, 30.0
NEAREST, PULL, BLOCK, QUERIES = 15, 1.0, 64, 64
COMMON, COLUMNS = 1 / 32, 3072  # terms in more of the examples are columns, so many of them; the rest have postings
COPY = 48
STEP = 1 << 18


def text_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) pairs, repeated ones included: each word, the stem of one above STEM bytes, the grams of one above LONG."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, _ = word_spans(buf != 32, bounds)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    roll, size = Rolling(BYTE[buf]), ends - starts
    begin, end = [starts, starts[size > STEM]], [ends, starts[size > STEM] + STEM]
    long = np.flatnonzero(size > LONG)
    count = size[long] - GRAM + 1
    at = np.repeat(starts[long], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin, end = np.concatenate([*begin, at]), np.concatenate([*end, at + GRAM])
    return np.searchsorted(bounds, begin, "right") - 1, roll.spans(begin, end)


def packed(a: np.ndarray) -> tuple[str, bytes]:
    """Numbers from 0 up in as few bytes as the largest needs, compressed."""
    a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
    return a.dtype.str, zlib.compress(a.tobytes(), 1)


def unpacked(kind: str, data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


class Index:
    """Block-max inverted index of weighted examples. idf: the weight of every term."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, vectors: list[tuple[int, int, np.ndarray, np.ndarray]]):
        self.terms, self.idf = terms, idf
        # Like examples share blocks, so that bounds differ: order by heaviest term.
        heavy = [int(t[((1 + np.log(c)) * idf[t]).argmax()]) if len(t) else -1 for _, _, t, c in vectors]
        rows = [vectors[i] for i in sorted(range(len(vectors)), key=lambda i: (heavy[i], vectors[i][0]))]
        self.empty = [r for r in rows if not len(r[2])]
        rows = [r for r in rows if len(r[2])]
        self.ids, self.labels = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float)
        lens = np.array([len(r[2]) for r in rows], np.int64)
        term = np.concatenate([np.zeros(0, np.int32), *(r[2].astype(np.int32) for r in rows)])
        order = np.argsort(term, kind="stable").astype(np.int32)
        count = np.concatenate([np.zeros(0, np.int32), *(r[3].astype(np.int32) for r in rows)])[order]
        place = np.repeat(np.arange(len(rows), dtype=np.int32), lens)[order]
        self.held, self.place, self.count = np.bincount(term, minlength=len(terms)), place, count
        self.share, self.prior, self.curve = 0.5, 0.5, (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    @cached_property
    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and weights of every example."""
        order = np.argsort(self.place, kind="stable")
        term, weight = np.repeat(np.arange(len(self.terms)), self.held)[order], self._weights()[order]
        ends = np.cumsum(np.bincount(self.place, minlength=len(self.ids)))
        return [(term[i:j], weight[i:j]) for i, j in zip([0, *ends], ends)]

    def _weights(self) -> np.ndarray:
        weight = np.repeat(self.idf, self.held)
        weight *= 1 + np.log(self.count.astype(float))
        weight /= np.maximum(np.sqrt(np.bincount(self.place, weight * weight, len(self.ids))), 1e-300)[self.place]
        return weight.astype(np.float32)

    def _hash(self) -> None:
        """Terms by hash: of each bucket its first place in by_hash."""
        self.bits = max(10, (4 * len(self.terms)).bit_length())
        bucket = self._bucket(self.terms)
        self.by_hash = np.argsort(bucket, kind="stable").astype(np.int32)
        self.buckets = np.searchsorted(bucket[self.by_hash], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _build(self) -> None:
        """Postings, columns and bounds, where they are first needed: the driver only packs counts."""
        n, weight = len(self.ids), self._weights()
        self.n_blocks = -(-n // BLOCK)
        common = np.argsort(-self.held, kind="stable")[:COLUMNS]
        common = common[self.held[common] > COMMON * n]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[common] = np.arange(len(common))
        self.columns = np.zeros((self.n_blocks * BLOCK, len(common)), np.float32)
        column = np.repeat(self.column, self.held)
        dense = column >= 0
        self.columns[self.place[dense], column[dense]] = weight[dense]
        self.bounds = self.columns.reshape(self.n_blocks, BLOCK, -1).max(axis=1).T.copy() if n and len(common) else np.zeros((len(common), self.n_blocks), np.float32)
        self.first = np.concatenate([[0], np.cumsum(np.where(self.column < 0, self.held, 0))]).astype(np.int64)
        self.member, self.weight = self.place[~dense], weight[~dense]

    def __getstate__(self) -> dict:
        """Counts alone travel; weights are made again."""
        gap = np.diff(self.place, prepend=0)
        starts = (np.cumsum(self.held) - self.held)[self.held > 0]
        gap[starts] = self.place[starts]
        kept = ("terms", "idf", "ids", "labels", "share", "prior", "curve")
        return {k: getattr(self, k) for k in kept} | {"packed": [packed(x) for x in (self.held, gap, self.count)]}

    def __setstate__(self, state: dict) -> None:
        self.held, gap, self.count = (unpacked(*x) for x in state.pop("packed"))
        self.__dict__.update(state)
        sums = np.cumsum(gap, dtype=np.int64)
        starts = (np.cumsum(self.held, dtype=np.int64) - self.held)[self.held > 0]
        before = (sums - gap)[starts]
        self.place = (sums - np.repeat(before, self.held[self.held > 0])).astype(np.int32)
        self._build()
        del self.place, self.count
        self._hash()

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, term index) pairs with counts."""
        if not hasattr(self, "buckets"):
            self._hash()
        doc, keys = text_terms(texts) if len(self.terms) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        bucket = self._bucket(keys)
        at, end = self.buckets[bucket], self.buckets[bucket + 1]
        place = np.flatnonzero(at < end)
        while len(place):
            term = self.by_hash[at[place]]
            same = self.terms[term] == keys[place]
            docs.append(doc[place[same]])
            found.append(term[same].astype(np.int64))
            place = place[~same]
            at[place] += 1
            place = place[at[place] < end[place]]
        n = max(1, len(self.terms))
        pair, counts = np.unique(np.concatenate(docs) * n + np.concatenate(found), return_counts=True)
        return pair // n, pair % n, counts

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(counts)) * self.idf[terms] if len(terms) else np.zeros(0)
        return terms, w / max(np.sqrt((w * w).sum()), 1e-300) if len(w) else w

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEAREST, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (above 0), exactly; ties to the smaller place. skip: an example to leave out."""
        return self.search([(terms, weights)], k, [skip])[0]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEAREST, skip: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """nearest() of some queries at once."""
        n = len(self.ids)
        if not n:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        if not hasattr(self, "columns"):
            self._build()
        width = self.columns.shape[1]
        size = self.n_blocks * BLOCK
        near, rows = np.zeros((len(queries), size)), np.zeros((len(queries), width))
        for q, (terms, weights) in enumerate(queries):
            weights = weights.astype(float)
            column = self.column[terms]
            rows[q, column[column >= 0]] = weights[column >= 0]
            terms, weights = terms[column < 0], weights[column < 0]
            first = self.first[terms]
            lens = self.first[terms + 1] - first
            which = np.repeat(first - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
            near[q] = np.bincount(self.member[which], np.repeat(weights, lens) * self.weight[which], size)
            if skip and skip[q] >= 0:
                near[q, skip[q]] = -np.inf
        near[:, n:] = -np.inf
        slack = (width + 2) * 2.0**-23  # what single precision may add or lose
        low = np.maximum(np.partition(near, size - k, axis=1)[:, size - k], 0) if k < size else np.zeros(len(queries))
        small = rows.astype(np.float32)
        bound = near.reshape(len(queries), self.n_blocks, BLOCK).max(axis=2) + small @ self.bounds
        whole = np.full(near.shape, -np.inf)
        for b in range(self.n_blocks):
            some = np.flatnonzero((bound[:, b] >= low - slack) & (bound[:, b] > 0))
            if len(some):
                part = slice(b * BLOCK, (b + 1) * BLOCK)
                whole[some, part] = near[some, part] + small[some] @ self.columns[part].T
        out = []
        least = np.partition(whole, size - k, axis=1)[:, size - k] if k < size else np.full(len(queries), -np.inf)
        for q in range(len(queries)):
            place = np.flatnonzero((whole[q] >= least[q] - 2 * slack) & (whole[q] > 0))
            best = near[q, place] + self.columns[place].astype(float) @ rows[q]
            order = np.lexsort([place, -np.round(best, 12)])[:k]
            out.append((place[order], best[order]))
        return out

    def vote(self, place: np.ndarray, sims: np.ndarray) -> float:
        near = sims * sims
        return float(((near * self.labels[place]).sum() + PULL * self.share) / (near.sum() + PULL))

    def calibrate(self, share: float, votes: list[tuple[float, float]]) -> None:
        """share: label 1's part of all labelled training rows. Pool-adjacent-violators over leave-one-out votes and labels."""
        self.share = share
        ones = self.labels.sum() + sum(r[1] for r in self.empty)
        zeros = len(self.labels) + len(self.empty) - ones
        if not ones or not zeros:
            self.prior, self.curve = share, (np.array([0.0, 1.0]), np.array([share, share]))
            return
        w1, w0 = share / ones, (1 - share) / zeros  # an example's weight in the population
        scale = ones + zeros
        e1 = sum(r[1] for r in self.empty)
        self.prior = float((w1 * e1 + 0.5 / scale * share) / (w1 * e1 + w0 * (len(self.empty) - e1) + 0.5 / scale))
        pools: list[list[float]] = []
        for v, label in sorted(votes):
            pools.append([v, v, w1 * label, w1 * label + w0 * (1 - label)])
            while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
                last = pools.pop()
                pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
        x, y = [0.0], [0.0]
        for low, high, a, n in pools:
            rate = (a + 0.5 / scale * share) / (n + 0.5 / scale)  # half an example of the prior
            for v in (low, high):
                x.append(v)
                y.append(rate)
        self.curve = np.array([*x, 1.0]), np.array([*y, max(y[-1], share)])

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[int]]]:
        doc, term, count = self.find(texts)
        out, evidence = np.full(len(texts), self.prior), [[] for _ in texts]
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        some = np.unique(doc).tolist()
        for i in range(0, len(some), QUERIES):
            part = some[i : i + QUERIES]
            queries = [self.weigh(term[first[d] : first[d + 1]], count[first[d] : first[d + 1]]) for d in part]
            for d, (place, sims) in zip(part, self.search(queries)):
                if len(place):
                    out[d] = np.interp(self.vote(place, sims), *self.curve)
                    evidence[d] = self.ids[place].tolist()
        return np.clip(out, 0, 1), evidence


def _pieces(batches, column: int):
    """Batches in pieces of about STEP bytes of text, with their normal texts."""
    for batch in batches:
        texts, start, part, size = batch.column(column), 0, [], 0
        for at in range(batch.num_rows):
            part.append(normal(texts[at].as_py() or ""))
            size += len(part[-1])
            if size >= STEP or at == batch.num_rows - 1:
                yield batch.slice(start, at + 1 - start), part
                start, part, size = at + 1, [], 0


def _sketch(batches):
    """Two min-hashes of every text, over its strings of COPY bytes: equal for most copies with small edits."""
    for batch, texts in _pieces(batches, 2):
        texts = [t.ljust(COPY) for t in texts]
        lens = np.array([len(t) for t in texts], np.int64)
        bounds = np.cumsum(lens) - lens
        windows = Rolling(BYTE[np.frombuffer(b"".join(texts), np.uint8)]).windows(COPY)
        inside = np.concatenate([np.arange(n) <= n - COPY for n in lens])
        least = []
        for seed in (1, 2):
            h = mix(windows ^ np.uint64(seed))
            h[~inside[: len(h)]] = np.iinfo(np.uint64).max
            least.append(pa.array(np.minimum.reduceat(h, bounds).view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, *least], names=["id", "label", "text", "a", "b"])


def _count(batches):
    for batch, texts in _pieces(batches, 1):
        doc, key = text_terms(texts)
        order = np.lexsort([key, doc])
        doc, key = doc[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        doc, key = doc[new], key[new]
        keys, at = np.unique(key, return_inverse=True)
        ones = np.bincount(at, np.array(batch.column(0).to_pylist(), float)[doc], len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ones), pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64))], names=["gram", "ones", "n"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Index:
    """An index of labelled examples; docs and labels are training rows."""
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    marked = stored(marked, "labels")
    counts = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    # Only hashes low enough for half as many again are ranked: the ranking's input doesn't grow with the table.
    low = F.lit(False)
    for label, n in counts.items():
        low = low | ((F.col("label") == label) & (F.xxhash64("id") / F.lit(2.0**64) + 0.5 < (1.5 * per_class + 200) / n))
    ranked = marked.where(low).selectExpr("id", "label", "row_number() over (partition by label order by xxhash64(id), id) as k").where(f"k <= {per_class}").select("id", "label")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    examples = texts.join(F.broadcast(ranked), "id")  # two times per_class rows at most
    examples = examples.select(F.col("id").cast("long"), "label", "text").mapInArrow(_sketch, "id long, label int, text string, a long, b long")
    for key in ("a", "b"):
        examples = examples.groupBy(key, "label").agg(F.min(F.struct("id", "text", "a", "b")).alias("r")).select("r.id", "label", "r.text", "r.a", "r.b")
    examples = examples.drop("a", "b")
    examples = stored(examples, "examples")
    sizes = {r[0]: r[1] for r in examples.groupBy("label").count().collect()}
    n1, n = sizes.get(1, 0), sum(sizes.values())
    a, m = F.col("ones"), F.col("n")
    lean = n * a.cast("double") - m * F.lit(float(n1))
    chi2 = lean * lean * n / (m * (n - m) * F.lit(float(n1)) * F.lit(float(n - n1)))
    counted = examples.select("label", "text").mapInArrow(_count, "gram long, ones long, n long").groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    top = counted.withColumn("chi2", F.when(F.col("n") < n, chi2).otherwise(0.0)).select("gram", "n", "chi2").toPandas() if n1 and n > n1 else None
    terms = np.zeros(0, np.uint64) if top is None else top["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(terms)
    terms, idf = terms[order], np.zeros(0)
    if top is not None:
        tie = top["chi2"].to_numpy(float)
        idf = (np.log((n + 1) / (top["n"].to_numpy(float) + 1)) * (1 + tie) / (HALF_CHI2 + tie))[order]
    finder = docs.sparkSession.sparkContext.broadcast(Index(terms, idf, []))

    def vectors(batches):
        for batch, texts in _pieces(batches, 2):
            doc, term, count = finder.value.find(texts)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            parts = [slice(i, j) for i, j in zip(first, first[1:])]
            packed = (pa.array([zlib.compress(x[p].astype(np.int32).tobytes(), 1) for p in parts], pa.binary()) for x in (term, count))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *packed], names=["id", "label", "terms", "counts"])

    rows = examples.select(F.col("id").cast("long"), "label", "text").mapInArrow(vectors, "id long, label int, terms binary, counts binary").collect()
    index = Index(terms, idf, [(r[0], r[1], *(np.frombuffer(zlib.decompress(x), np.int32) for x in r[2:])) for r in rows])
    del rows
    index.share = share
    fitted = docs.sparkSession.sparkContext.broadcast(index)

    def votes(batches):
        """Votes of examples, each without itself."""
        index = fitted.value
        at = {id_: i for i, id_ in enumerate(index.ids.tolist())}
        for batch, texts in _pieces(batches, 2):
            doc, term, count = index.find(texts)
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            some, ids = np.unique(doc), batch.column(0).to_pylist()
            got: list[float | None] = [None] * batch.num_rows
            for i in range(0, len(some), QUERIES):
                part = some[i : i + QUERIES].tolist()
                queries = [index.weigh(term[first[d] : first[d + 1]], count[first[d] : first[d + 1]]) for d in part]
                for d, (place, sims) in zip(part, index.search(queries, skip=[at[ids[d]] for d in part])):
                    if len(place):
                        got[d] = index.vote(place, sims)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(got, pa.float64())], names=["label", "vote"])

    voted = examples.select(F.col("id").cast("long"), "label", "text").mapInArrow(votes, "label int, vote double").where("vote is not null").collect()
    fitted.destroy()
    index.calibrate(share, [(r.vote, float(r.label)) for r in voted])
    return index


def score(docs: DataFrame, index: Index, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Carried columns, score, predicted and neighbours (ids of the nearest examples) of every row of docs."""
    carry = ["doc_id"] if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(index)
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    # A text that is carried anyway stands once in the batches.
    again = text_col in carry and docs.schema[text_col].dataType == T.StringType()
    chosen = docs.select(*carried, *([] if again else [F.col(f"`{text_col}`").cast("string").alias("text")]))
    at = carry.index(text_col) if again else len(carry)
    kind = T.StructType([*chosen.schema.fields[: len(carry)], T.StructField("score", T.DoubleType()), T.StructField("neighbours", T.ArrayType(T.LongType()))])
    schema = to_arrow_schema(kind)

    def run(batches):
        for batch, texts in _pieces(batches, at):
            scores, evidence = shared.value.score(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(scores), pa.array(evidence, pa.list_(pa.int64()))], schema=schema)

    out = chosen.mapInArrow(run, kind)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "score", F.expr("if(score >= 0.5, 1, 0)").alias("predicted"), "neighbours")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", held_out().alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return score(docs, learn(docs.where("not held_out"), labels), carry=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted", "neighbours")
