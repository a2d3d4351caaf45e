"""Substring dedup by difference-cover anchors.

Positions p of a document with p mod 13 in {0, 1, 3, 9} are its cover positions. For any two positions some shift below
13 takes both onto the cover, so any two equal windows of 20 words share an aligned anchor of 8 words that begins at a
cover position of either. Anchors are hashed at cover positions only (4 of 13), those that occur twice are found, and
only windows that hold such an anchor are extended to their whole 20 words and compared. Everything else is
known to be unique without being sent. Windows are compared by two independent hashes of 64 bits of their words (hashed by
lanes, not by powers), when asked and when replied; they are what decides, so two different windows are taken for equal
once in 2**128 pairs.

Between segments travel: distinct anchor hashes of a segment; those of them that repeat; of each candidate window a
segment's first occurrence; and which of those aren't the corpus' first. A sequence that a third of all documents hold
so costs one row a segment. Defined results: null or short text: nothing is removed; a null id comes after all others;
rows with the same id and start don't remove each other; repeated rows each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import segments as S
from .common import Rolling, Words, stored

PERIOD, COVER = 13, (0, 1, 3, 9)
BOTH = np.dtype([("ha", "<u8"), ("hb", "<u8")])


def _anchors(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the anchors, and the words at which they begin."""
    length = width - PERIOD + 1
    on = np.isin(np.arange(PERIOD), COVER)[words.rel % PERIOD] & words.room(length)
    on &= (words.counts >= width)[words.doc] if len(words.doc) else on
    at = np.flatnonzero(on)
    return Rolling(hashes).spans(at, at + length), at


def _windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows' starts (word indexes), and two hashes of each."""
    at = np.flatnonzero(words.room(width))
    return at, Rolling(words.hashes()).spans(at, at + width), Rolling(words.hashes(1), 1).spans(at, at + width)


def _groups(ha: np.ndarray, hb: np.ndarray, order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of windows told apart by both hashes: the index of each one's first by the keys of order, and the firsts."""
    by = np.lexsort([*order[::-1], hb, ha])
    new = np.ones(len(by), bool)
    new[1:] = (ha[by][1:] != ha[by][:-1]) | (hb[by][1:] != hb[by][:-1])
    lead = np.zeros(len(by), np.int64)
    lead[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))] if len(by) else by
    return lead, by[new]


def _member(ha: np.ndarray, hb: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which pairs of hashes are among the known ones."""
    out, at = np.zeros(len(ha), bool), np.flatnonzero(np.isin(ha, known["ha"]))
    if len(at):
        lead, _ = _groups(np.concatenate([known["ha"], ha[at]]), np.concatenate([known["hb"], hb[at]]), [np.arange(len(known) + len(at))])
        out[at] = lead[len(known) :] < len(known)
    return out


def _send_anchors(n: int, width: int):
    def run(seg: S.Segment):
        words = Words(seg.buf, seg.bounds)
        h, _ = _anchors(words, words.hashes(), width)
        values, counts = np.unique(h, return_counts=True)
        values = np.concatenate([values, values[counts > 1]])
        if len(values):
            yield S.dealt(seg.seg, n, values, {"h": values})

    return run


def _send_windows(n: int, width: int):
    def run(seg: S.Segment, replies: pa.Table) -> pa.Table:
        words, known = Words(seg.buf, seg.bounds), np.sort(S.gather(replies, "found", np.uint64))
        h, at = _anchors(words, words.hashes(), width)
        holds = np.zeros(len(words.starts) + PERIOD + 1, np.int64)
        holds[at[np.isin(h, known)] + 1] = 1
        holds = np.cumsum(holds)
        starts, ha, hb = _windows(words, width)
        is_candidate = holds[starts + PERIOD] > holds[starts]
        starts, ha, hb = starts[is_candidate], ha[is_candidate], hb[is_candidate]
        if not len(starts):
            return WINDOWS.empty_table()
        keys, rel = seg.keys[words.doc[starts]], words.rel[starts].astype(np.uint32)
        _, one = _groups(ha, hb, [keys, rel])
        return pa.Table.from_batches([S.dealt(seg.seg, n, ha[one], {"ha": ha[one], "hb": hb[one], "key": keys[one], "rel": rel[one]})])

    return run


WINDOWS = pa.schema([("bucket", pa.int64()), ("seg", pa.int64()), *((c, pa.binary()) for c in ("ha", "hb", "key", "rel"))])


def _later(table: pa.Table) -> pa.Table:
    """Of one hash bucket: the windows whose first occurrence in a segment isn't the first of all."""
    ha, hb, key, rel = (S.gather(table, c, t) for c, t in (("ha", np.uint64), ("hb", np.uint64), ("key", np.int64), ("rel", np.uint32)))
    segs = np.repeat(table.column("seg").to_numpy(), S.sizes(table, "ha", 8))
    by = np.lexsort([rel, key, hb, ha])
    ha, hb, key, rel, segs = ha[by], hb[by], key[by], rel[by], segs[by]
    new = np.ones(len(ha), bool)
    new[1:] = (ha[1:] != ha[:-1]) | (hb[1:] != hb[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(ha)), 0))
    later = (key > key[first]) | (rel > rel[first])
    both = np.zeros(len(ha), BOTH)
    both["ha"], both["hb"] = ha, hb
    return pa.table(S.spread(segs, {"found": both}, later), schema=S.REPLY_ARROW)


def _cut(width: int, schema: pa.Schema):
    def run(seg: S.Segment, replies: pa.Table) -> pa.Table:
        words, known = Words(seg.buf, seg.bounds), S.gather(replies, "found", BOTH)
        starts, ha, hb = _windows(words, width)
        keys, rel = seg.keys[words.doc[starts]], words.rel[starts]
        gone = _member(ha, hb, known)
        lead, _ = _groups(ha, hb, [keys, rel])  # a repeat within the segment is later than the first there
        gone |= (keys > keys[lead]) | (rel > rel[lead])
        edge = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(edge, starts[gone], 1)
        np.add.at(edge, starts[gone] + width, -1)
        kept = np.cumsum(edge)[:-1] == 0
        sums = np.concatenate([[0], np.cumsum(~kept)])
        removed = sums[words.first[1:]] - sums[words.first[:-1]]
        text, bounds = _joined(words, kept, seg.bounds)
        rest = seg.rest()
        text_column = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(text.tobytes())])
        return pa.Table.from_arrays([*rest.columns, pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), text_column], schema=schema)

    return run


def _joined(words: Words, kept: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each document joined by one space: bytes, and where each document begins."""
    chosen = np.flatnonzero(kept)
    out, take = words.buf.copy(), np.zeros(len(words.buf) + 1, np.int8)
    np.add.at(take, words.starts[chosen], 1)
    np.add.at(take, words.ends[chosen], -1)
    take = np.cumsum(take[:-1], dtype=np.int8).astype(bool)
    doc = words.doc[chosen]
    gaps = words.starts[chosen[1:][doc[1:] == doc[:-1]]] - 1 if len(chosen) else chosen
    out[gaps], take[gaps] = 32, True  # the separator before a word that isn't its document's first kept one
    ends = np.concatenate([[0], np.cumsum(take)])
    return out[take], ends[bounds]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, carry: list[str] | None = None) -> DataFrame:
    """Rows of docs with the carried columns (by default the id), n_words, n_removed and kept_text.

    A word goes if a window of `width` words that covers it also begins earlier: in a row with a smaller id, or in the
    same id at a smaller word position.
    """
    if width < PERIOD + 1:
        raise ValueError(f"windows have more than {PERIOD} words")
    carry = [id_col] if carry is None else carry
    packed = S.Packed(docs, id_col, text_col, carry)
    n = packed.hash_buckets()
    anchors = packed.ask(_send_anchors(n, width), "bucket long, seg long, h binary")
    shared = S.settle(anchors, S.repeated, S.REPLY)
    windows = packed.answer(shared, _send_windows(n, width), "bucket long, seg long, ha binary, hb binary, key binary, rel binary")
    later = stored(S.settle(windows, _later, S.REPLY), "later")
    kind = T.StructType([*packed.carry, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    out = packed.answer(later, _cut(width, to_arrow_schema(kind)), kind)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "n_words", "n_removed", "kept_text")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20),
g AS (SELECT doc_id, s, hash(ws[s:s + 19]) AS h, md5(array_to_string(ws[s:s + 19], ' ')) AS m FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h, m ORDER BY doc_id, s) AS k FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r WHERE k > 1),
e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
k AS (SELECT e.doc_id, count(*) AS n_words, count(gone.i) AS n_removed,
  coalesce(string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE gone.i IS NULL), '') AS kept FROM e LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.i = gone.i GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
