"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by documents: each row, a segment of about a million words, holds its own term dictionary and,
for each term, the sorted positions at which it occurs. It is stored once and doesn't depend on the test items. A test
phrase is looked up in every segment: from its rarest term there, position lists are shifted by the terms' offsets and
intersected until none is left. Positions are exact, so matches need no second look at the texts. Test items go to the
segments in blocks of bounded size, so a benchmark of any size is answered; no block, posting list or document is capped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_ascii, stored
from .segments import utf8

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 bytes, lower case: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
SEGMENT_WORDS = 1 << 20
SEGMENT_BYTES = 4 << 20
BLOCK_WORDS = 1 << 18  # test words of a block, so of a broadcast, at most; one longer item makes its own block
SEGMENT = "segment long, ids array<bigint>, counts binary, terms binary, starts binary, positions binary"


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def _index(batches):
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        buf, bounds = utf8(batch.column(1))
        buf, at = lower_ascii(buf), 0
        while at < batch.num_rows:
            to = min(batch.num_rows, max(at + 1, int(np.searchsorted(bounds, bounds[at] + SEGMENT_BYTES, "right")) - 1))
            terms: dict[bytes, int] = {}
            found, counts = [], []
            for d in range(at, to):
                words = WORD.findall(buf[bounds[d] : bounds[d + 1]].tobytes())
                counts.append(len(words))
                found.append(np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int32, len(words)))
            ids = np.concatenate(found)
            lens = np.array(counts, np.int64)
            places = np.arange(len(ids)) + np.repeat(np.arange(len(lens)), lens)  # a gap of one between documents
            order = np.argsort(ids, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(terms)))])
            yield pa.RecordBatch.from_pydict(
                {"segment": [(part << 32) + n], "ids": [batch.column(0).slice(at, to - at).to_pylist()], "counts": [lens.tobytes()], "terms": [b" ".join(terms)], "starts": [starts.astype(np.int32).tobytes()], "positions": [places[order].astype(np.int32).tobytes()]},
                schema=pa.schema([("segment", pa.int64()), ("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("counts", "terms", "starts", "positions"))]),
            )
            at, n = to, n + 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: a row for each segment. Null texts have no words; null ids and repeated rows stay as they are."""
    chosen = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return stored(chosen.mapInArrow(_index, SEGMENT), "postings")


class Postings:
    """One segment of the index."""

    def __init__(self, row: dict):
        self.segment, self.ids = row["segment"], row["ids"]
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.first = np.cumsum(self.counts) - self.counts + np.arange(len(self.counts))  # each document's first position
        self.term = {w: i for i, w in enumerate(row["terms"].split(b" "))} if row["terms"] else {}
        self.starts, self.positions = np.frombuffer(row["starts"], np.int32), np.frombuffer(row["positions"], np.int32)

    def of(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term + 1]]

    def doc(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Where the terms stand one after the other, from the rarest to the most frequent."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        order = np.argsort(sizes, kind="stable")
        at = self.of(terms[order[0]]) - order[0]
        for i in order[1:]:
            if not len(at):
                break
            want, have = at + i, self.of(terms[i])
            k = np.searchsorted(have, want)
            at = at[(k < len(have)) & (have[np.minimum(k, len(have) - 1)] == want)]
        return at

    def near(self, terms: np.ndarray, within: int) -> np.ndarray:
        """Positions of the rarest term for which every other term stands in the same document, at most `within` words off."""
        terms = np.unique(terms)
        order = terms[np.argsort(self.starts[terms + 1] - self.starts[terms], kind="stable")]
        at = self.of(order[0])
        for t in order[1:]:
            if not len(at):
                break
            have, docs = self.of(t), self.doc(at)
            low = np.maximum(at - within, self.first[docs])
            high = np.minimum(at + within, self.first[docs] + self.counts[docs] - 1)
            at = at[np.searchsorted(have, high, "right") > np.searchsorted(have, low, "left")]
        return at


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """Test items, a bounded block at a time, streamed through the driver partition by partition."""
    block, size = [], 0
    for row in items.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    yield block


def _windows(block: list, width: int) -> dict[int, tuple[np.ndarray, list]]:
    """Window length -> matrix of word numbers, items; with the words numbered over the block."""
    number: dict[bytes, int] = {}
    rows: dict[int, dict[tuple, list]] = {}
    for item, words in block:
        ids = [number.setdefault(w, len(number)) for w in words]
        w = min(width, len(ids))
        for i in range(len(ids) - w + 1):
            rows.setdefault(w, {}).setdefault(tuple(ids[i : i + w]), []).append(item)
    return {w: (np.array(list(x), np.int64), list(x.values())) for w, x in rows.items()} | {0: list(number)}


def _match(windows, first_block: bool):
    def run(batches):
        sets = windows.value
        for batch in batches:
            for row in batch.to_pylist():
                index = Postings(row)
                number = np.array([index.term.get(w, -1) for w in sets[0]], np.int64)
                n = len(index.ids)
                edge = np.zeros(int(index.counts.sum()) + n + 1, np.int64)
                items: list[set] = [set() for _ in range(n)]
                for width, (matrix, owners) in ((w, x) for w, x in sets.items() if w):
                    terms = number[matrix]
                    for i in np.flatnonzero((terms >= 0).all(axis=1)):
                        at = index.phrase(terms[i])
                        if len(at):
                            np.add.at(edge, at, 1)
                            np.add.at(edge, at + width, -1)
                            for d in np.unique(index.doc(at)).tolist():
                                items[d].update(x for x in owners[i] if x is not None)
                hit = np.cumsum(edge)[:-1] > 0
                out = {"segment": [], "row": [], "id": [], "n_words": [], "spans": [], "items": []}
                touched = set(index.doc(np.flatnonzero(hit)).tolist())
                for d in range(n) if first_block else sorted(touched):
                    spans = []
                    if d in touched:
                        flags = np.concatenate([[0], hit[index.first[d] : index.first[d] + index.counts[d]].astype(np.int8), [0]])
                        step = np.diff(flags)
                        spans = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]
                    for k, v in (("segment", index.segment), ("row", d), ("id", index.ids[d]), ("n_words", int(index.counts[d])), ("spans", spans), ("items", sorted(items[d]))):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=_MATCH)

    return run


MATCH = "segment long, row int, id long, n_words long, spans array<struct<start:bigint,end:bigint>>, items array<bigint>"
_MATCH = pa.schema([("segment", pa.int64()), ("row", pa.int32()), ("id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64()))])


def match_phrases(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """For every indexed row: id, n_words, spans (hit word ranges, joined) and items whose windows occur in it.

    A window is `width` consecutive words of an item, or the whole of a shorter one; items without words or text have
    none. Windows of an item without an id hit as others do, but no list of items names it. Item ids are whole numbers.
    """
    spark, parts = index.sparkSession, []
    for i, block in enumerate(_blocks(items, item_col, text_col)):
        windows = spark.sparkContext.broadcast(_windows(block, width))
        parts.append(index.mapInArrow(_match(windows, i == 0), MATCH))
    if len(parts) == 1:
        return parts[0].select("id", "n_words", "spans", "items")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    merged = rows.groupBy("segment", "row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Spans of several blocks may overlap: fold them, in order, into disjoint ones.
    joined = """aggregate(spans, cast(array() as array<struct<start:bigint,end:bigint>>), (a, s) ->
        if(size(a) > 0 and element_at(a, -1).end >= s.start,
           concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))),
           concat(a, array(s))))"""
    return merged.select("id", "n_words", F.expr(joined).alias("spans"), "items")


def proximity(index: DataFrame, phrases: list[str], within: int = 20) -> DataFrame:
    """Rows in which all words of a phrase stand at most `within` words from one occurrence of its rarest: id, phrase, position."""
    queries = [(i, words_of(p)) for i, p in enumerate(phrases)]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                index_ = Postings(row)
                out = {"id": [], "phrase": [], "position": []}
                for i, words in queries:
                    terms = np.array([index_.term.get(w, -1) for w in words], np.int64)
                    if not len(terms) or (terms < 0).any():
                        continue
                    at = index_.near(terms, within)
                    docs = index_.doc(at)
                    out["id"] += [index_.ids[d] for d in docs]
                    out["phrase"] += [i] * len(at)
                    out["position"] += (at - index_.first[docs]).tolist()
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("id", pa.int64()), ("phrase", pa.int32()), ("position", pa.int64())]))

    return index.mapInArrow(run, "id long, phrase int, position long")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """For every row of docs: id, n_words, n_hit, spans, items and contaminated (at least a twentieth of its words are hit)."""
    found = match_phrases(build_index(docs, id_col, text_col), items, width=width)
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)")
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return decontaminate(docs, items).select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, ws[s:s + least(13, len(ws)) - 1] AS w FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS s FROM b WHERE len(ws) > 0)),
n AS (SELECT DISTINCT len(w) AS n FROM bw),
dw AS (SELECT doc_id, s, ws[s:s + n - 1] AS w FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, n WHERE len(ws) >= n)),
m AS (SELECT doc_id, s, w, item_id FROM dw JOIN bw USING (w)),
h AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + len(w))) AS i FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
