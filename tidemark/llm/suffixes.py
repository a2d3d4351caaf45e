"""Byte-level duplicate removal by suffix arrays built with linear grouping (gsaca).

A string of 50 bytes belongs to the smallest hash of its 31 grams of 20 bytes, its key: equal strings have equal keys.
Consecutive strings of one key form a run, about 16 strings. Only keys found in two documents or more matter: hashes
choose what is compared, and decide nothing. The texts of the runs of such keys meet by key. Byte-equal ones (compared
byte by byte) are one text with its smallest id. All texts of a key are sorted by suffix array; in it equal strings lie
side by side, and the least id of each such stretch is the first document that holds the string. A byte goes if a string
that covers it has a first document with a smaller id. Nothing is removed but by that order; the arrays of many keys are
built side by side (gsaca.suffix_arrays), those of large ones one by one.

Of a key whose texts are above CROWD bytes only strings whose hash stands there twice are sorted, dealt by a second key (`holders`):
hashes leave out what can't be equal to anything, and decide nothing.

A key that more than `hot` segments of 1 MB hold (a line that a third of all documents have) is split: its strings are
dealt one by one by their hashes, over all buckets, and sorted there with those that share their first bytes.

Between segments travel the keys, then the texts of shared keys, twice a segment at most, then the parts to remove, each
named by the place of its text in the segment that asked: runs of one hash are told apart by their bytes.
Defined results: null is empty; a null id comes after all others; rows with the same id don't remove each other;
repeated rows each give a row; texts of any length are taken whole. Carried columns may have any names but n_bytes,
n_removed, n_spans and kept_bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import segments as S
from .common import BYTE, KEEP, Rolling, lanes, mix, stored
from .gsaca import suffix_array, suffix_arrays

GRAM = 20
HOT = 4096  # segments that hold a key whose strings are dealt one by one
CROWD = 256  # bytes of a key's texts above which its strings are told apart by a second key
SECOND = np.uint64(0x8EBC6AF09C88C6E3)
SIDE, ALIKE = 24, 1.5  # so many texts of sizes within that factor are sorted side by side
BATCH = 1 << 17  # bytes sorted side by side
STEP = 1 << 17


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Of each `width` values in a row the least: minima of 1, 2, 4 … values, and two overlapping ones of those."""
    if len(values) < width:
        return np.zeros(0, values.dtype)
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs_of(buf: np.ndarray, bounds: np.ndarray, width: int, salt: np.uint64 | None = None, chosen: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The runs of texts buf[bounds[d]:bounds[d + 1]]: start, number of strings, key, text hash, text. Found a few texts at a time.
    salt: another order of the grams, and so other keys. chosen: where strings begin that runs may hold."""
    parts, d = [], 0
    while d < len(bounds) - 1:
        e = max(d + 1, int(np.searchsorted(bounds, bounds[d] + STEP, "right")) - 1)
        parts.append(_runs(buf[bounds[d] : bounds[e]], bounds[d : e + 1] - bounds[d], width, salt, None if chosen is None else chosen[bounds[d] : bounds[e]], bounds[d], d))
        d = e
    empty = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int32)]
    return tuple(np.concatenate(x) for x in zip(empty, *parts))


def _runs(buf: np.ndarray, bounds: np.ndarray, width: int, salt: np.uint64 | None, chosen: np.ndarray | None, base: np.int64, d: int) -> tuple[np.ndarray, ...]:
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    roll = Rolling(BYTE[buf])
    grams = roll.windows(GRAM)
    low = _sliding_min(grams if salt is None else mix(grams ^ salt), width - GRAM + 1)
    n = len(low)
    ok = bounds[doc[:n] + 1] - np.arange(n) >= width
    if chosen is not None:
        ok &= chosen[:n]
    begin, end = ok.copy(), ok.copy()
    same = (low[1:] == low[:-1]) & ok[1:] & ok[:-1]
    begin[1:] &= ~same
    end[:-1] &= ~same
    start = np.flatnonzero(begin)
    count = np.flatnonzero(end) + 1 - start
    return start + base, count, low[start], roll.spans(start, start + count + width - 1), doc[start] + np.int32(d)


class Runs:
    """The runs of a segment: key, start, number of strings, text hash, document."""

    def __init__(self, seg: S.Segment, width: int):
        self.seg, self.width = seg, width
        self.start, self.count, self.key, self.text, self.doc = runs_of(seg.buf, seg.bounds, width)
        self.id = seg.keys[self.doc]

    def pairs(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some runs: one of each text with the smallest id, and one with a later id of those texts that have one; for
        each of both, where its text's first run begins."""
        by, first = classes(self.seg.buf, self.start[runs], self.count[runs] + self.width - 1, self.text[runs], self.id[runs])
        by = runs[by]
        one, later = picked(first, self.id[by])
        return by[one], by[later], self.start[by[first[one]]], self.start[by[first[later]]]


def classes(buf: np.ndarray, at: np.ndarray, size: np.ndarray, text: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by text (hash, size, bytes) and id: their order, and for each place in it the place of the text's first row. A row whose
    bytes differ from those of the first with its hash is on its own."""
    by = np.lexsort([ids, size, text])
    t, z = text[by], size[by]
    new = np.ones(len(by), bool)
    new[1:] = (t[1:] != t[:-1]) | (z[1:] != z[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    apart = ~same_bytes(buf, at[by], at[by[first]], z * ~new)
    return by, np.where(apart, np.arange(len(by)), first)


def picked(first: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of classes in order: the places of the first rows, and of one row each with a later id than the first's."""
    late = np.flatnonzero(ids > ids[first])
    _, place = np.unique(first[late], return_index=True)
    return np.flatnonzero(first == np.arange(len(first))), late[place]


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether buf[a:a + len] and buf[b:b + len] hold the same bytes, for each pair; eight bytes at a time."""
    same, todo = np.ones(len(a), bool), np.flatnonzero(lens > 0)
    if not len(todo):
        return same
    words = lanes(buf)
    if 4 * len(todo) > len(buf):
        words = np.array(words)  # an aligned copy is read twice as fast
    left = lens[todo].astype(np.int64)
    x, y = np.asarray(a)[todo].astype(np.int64), np.asarray(b)[todo].astype(np.int64)
    while len(todo):
        apart = words[x] ^ words[y]
        equal = (apart if left.min() >= 8 else apart & KEEP[np.minimum(left, 8)]) == 0
        same[todo[~equal]] = False
        go = equal & (left > 8)
        todo, left, x, y = todo[go], left[go] - 8, x[go] + 8, y[go] + 8
    return same


def _send_keys(n: int, width: int):
    def run(seg: S.Segment):
        runs = Runs(seg, width)
        by = np.lexsort([runs.id, runs.key])
        key, ids = runs.key[by], runs.id[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        other = np.zeros(len(key), bool)
        other[1:] = ~new[1:] & (ids[1:] != ids[:-1])
        values = np.concatenate([key[new], np.unique(key[other])])
        if len(values):
            yield S.dealt(seg.seg, n, mix(values), {"h": values})  # keys are least hashes, so most are small: mixed before they are dealt

    return run


KEYS = pa.schema([("seg", pa.int64()), ("found", pa.binary()), ("hot", pa.binary())])


def _shared_keys(hot: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one hash bucket: for each segment its keys that two documents have, and those that very many segments have."""
        keys, segs = S.gather(table, "h", np.uint64), np.repeat(table.column("seg").to_numpy(), S.sizes(table, "h", 8))
        order = np.argsort(keys, kind="stable")
        keys, segs = keys[order], segs[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        times = np.diff(np.append(np.flatnonzero(new), len(keys)))[np.cumsum(new) - 1] if len(keys) else np.zeros(0, np.int64)
        parts = []
        for name, rows in (("found", (times > 1) & (times <= hot)), ("hot", times > hot)):
            got = S.spread(segs, {name: keys}, rows)
            parts.append(pa.table({c: got.get(c, [None] * len(got["seg"])) for c in KEYS.names}, schema=KEYS))
        return pa.concat_tables(parts)

    return run


TEXTS = pa.schema([("bucket", pa.int64()), ("seg", pa.int64()), *((c, pa.binary()) for c in ("key", "text", "at", "id", "size", "bytes"))])


def _hot_strings(runs: Runs, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of runs with hot keys begin, and the ids of their documents."""
    which = np.flatnonzero(np.isin(runs.key, hot))
    count = runs.count[which]
    at = np.repeat(runs.start[which], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return at, np.repeat(runs.id[which], count)


def _send(seg: S.Segment, n: int, by: np.ndarray, key: np.ndarray, text: np.ndarray, at: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> list[pa.RecordBatch]:
    """Texts dealt by hash, with their bytes. at: where the text first begins in the segment, by which replies name it."""
    if not len(key):
        return []
    bucket = ((by >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    b, cuts = np.unique(bucket[order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    start, size = start[order], size[order].astype(np.int32)
    which = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    body, edge = seg.buf[which], np.concatenate([[0], np.cumsum(size)])
    columns = {"key": key[order], "text": text[order], "at": at[order], "id": ids[order], "size": size}
    data = {"bucket": b.astype(np.int64), "seg": np.full(len(b), seg.seg)} | {c: [v[i:j].tobytes() for i, j in zip(cuts, cuts[1:])] for c, v in columns.items()}
    return [pa.RecordBatch.from_pydict(data | {"bytes": [body[edge[i] : edge[j]].tobytes() for i, j in zip(cuts, cuts[1:])]}, schema=TEXTS)]


def _send_texts(n: int, width: int):
    def run(seg: S.Segment, replies: pa.Table) -> pa.Table:
        found, hot = (np.sort(S.gather(replies, c, np.uint64)) for c in ("found", "hot"))
        if not len(found) and not len(hot):
            return TEXTS.empty_table()
        runs, out = Runs(seg, width), []
        one, later, *firsts = runs.pairs(np.flatnonzero(np.isin(runs.key, found)))
        rows = np.concatenate([one, later])
        out += _send(seg, n, mix(runs.key[rows]), runs.key[rows], runs.text[rows], np.concatenate(firsts), runs.id[rows], runs.start[rows], runs.count[rows] + width - 1)
        if len(hot):
            at, ids = _hot_strings(runs, hot)
            h = Rolling(BYTE[seg.buf]).spans(at, at + width)
            by, first = classes(seg.buf, at, np.full(len(at), width), h, ids)
            place = np.concatenate(picked(first, ids[by]))
            rows, firsts = by[place], at[by[first[place]]]
            # Strings that share their first bytes and a bucket are sorted together.
            prefix = np.zeros(len(rows), np.uint64)
            for i in range(8):
                prefix = prefix << np.uint64(8) | seg.buf[at[rows] + i]
            out += _send(seg, n, mix(h[rows]), mix(prefix ^ np.uint64(1)), h[rows], firsts, ids[rows], at[rows], np.full(len(rows), width))
        return pa.Table.from_batches(out, schema=TEXTS)

    return run


HITS = pa.schema([("seg", pa.int64()), ("at", pa.binary()), ("id", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary())])


def _sort_texts(width: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one bucket: for each text sent, the strings of it that a smaller id has."""
        key, text, at, ids, size = (S.gather(table, c, t) for c, t in (("key", np.uint64), ("text", np.uint64), ("at", np.int64), ("id", np.int64), ("size", np.int32)))
        segs = np.repeat(table.column("seg").to_numpy(), S.sizes(table, "key", 8))
        size = size.astype(np.int64)
        body = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
        start = np.cumsum(size) - size
        by = np.lexsort([ids, size, text, key])
        k, t, z, who = key[by], text[by], size[by], ids[by]
        new = np.ones(len(by), bool)
        new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (z[1:] != z[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        apart = ~same_bytes(body, start[by], start[by[first]], z * ~new)
        new |= apart
        first = np.where(apart, np.arange(len(by)), first)
        reps = np.flatnonzero(new)  # each text stands once in the arrays, with its smallest id
        of = np.searchsorted(reps, first)
        copied = np.zeros(len(reps), bool)
        copied[of[who > who[first]]] = True
        least = holders(body, start[by[reps]], z[reps], k[reps], who[reps], copied, width)
        # Every row asks by the strings of its text.
        count = z - width + 1
        edge = np.cumsum(count[reps]) - count[reps]
        row = np.repeat(np.arange(len(by)), count)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        gone = least[edge[of[row]] + nth] < who[row]
        begin = gone & (np.append(True, ~gone[:-1]) | (nth == 0)) if len(gone) else gone
        end = gone & (np.append(~gone[1:], True) | (np.append(nth[1:], 0) == 0)) if len(gone) else gone
        r, lo, hi = row[begin], nth[begin], nth[end] + 1
        got = S.spread(segs[by][r], {"at": at[by][r], "id": who[r], "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)}, np.ones(len(r), bool))
        return pa.table(got, schema=HITS)

    return run


def holders(body: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, ids: np.ndarray, copied: np.ndarray, width: int) -> np.ndarray:
    """`first_holders`, for keys of any number of texts. copied: whether a later id has the text too.

    The texts of a key above CROWD bytes are a passage in many surroundings: in one array they'd be sorted one suffix after the other, and
    a key that the whole corpus has would be one task's. So only strings whose hash stands there twice are sorted, and these get a second
    key, the least of their grams in another order: equal ones still meet, and a passage is one text whatever stands around it."""
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(size, head) if len(key) else head
    crowded = np.repeat(total > CROWD, np.diff(np.append(head, len(key))))
    if not crowded.any():
        return first_holders(body, start, size, key, ids, width)
    count = size - width + 1
    edge = np.cumsum(count) - count
    out = np.full(int(count.sum()), S.LAST)
    few, many = np.flatnonzero(~crowded), np.flatnonzero(crowded)
    out[_each(edge[few], count[few])] = first_holders(body, start[few], size[few], key[few], ids[few], width)
    joined = body[_each(start[many], size[many])]
    bounds = np.concatenate([[0], np.cumsum(size[many])])
    at = _each(bounds[:-1], count[many])
    h = Rolling(BYTE[joined]).windows(width)[at]
    order = np.argsort(h)
    same = np.append(h[order[1:]] == h[order[:-1]], False)
    same[1:] |= same[:-1]
    chosen = np.zeros(len(joined), bool)
    chosen[at[order[same]]] = True
    chosen[at] |= np.repeat(copied[many], count[many])
    at, n, second, text, of = runs_of(joined, bounds, width, SECOND, chosen)
    by, first = classes(joined, at, n + width - 1, text, ids[many][of])
    at, n, of, pair = at[by], n[by], of[by], mix(second[by] ^ mix(key[many][of[by]]))
    reps = np.flatnonzero(first == np.arange(len(first)))
    order = np.argsort(pair[reps], kind="stable")
    rows = reps[order]
    least = first_holders(joined, at[rows], n[rows] + width - 1, pair[rows], ids[many][of[rows]], width)
    begin = np.zeros(len(reps), np.int64)
    begin[order] = np.cumsum(n[rows]) - n[rows]
    out[_each(edge[many][of] + at - bounds[of], n)] = least[_each(begin[np.searchsorted(reps, first)], n)]
    return out


def _each(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each, so many of them."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def first_holders(body: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """For each string of each text, one after the other, the least id of the texts of its key that hold it. Texts come by key."""
    count = size - width + 1
    edge = np.cumsum(count) - count
    out = np.full(int(count.sum()), S.LAST)
    head = np.ones(len(key), bool)
    head[1:] = key[1:] != key[:-1]
    group = np.append(np.flatnonzero(head), len(key))
    total = np.add.reduceat(size, group[:-1]) if len(key) else np.zeros(0, np.int64)
    order = np.argsort(total, kind="stable")
    ordered, i = total[order], 0
    while i < len(order):
        most = int(np.searchsorted(ordered, ALIKE * ordered[i] + 64, "right"))
        most = min(most, i + max(SIDE, int(BATCH // ordered[i])))
        together = order[i:most] if most - i >= SIDE else order[i : i + 1]
        i += len(together)
        texts = np.concatenate([np.arange(group[g], group[g + 1]) for g in together])
        lens = size[texts]
        which = np.repeat(start[texts] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        joined = body[which]
        if len(together) == 1:
            array = suffix_array(joined.tobytes())
        else:
            array = suffix_arrays(joined, np.concatenate([[0], np.cumsum(total[together])]))
        base = np.cumsum(lens) - lens
        text = np.repeat(np.arange(len(texts)), lens)
        place = np.arange(len(joined)) - base[text]
        array = array[place[array] + width <= lens[text[array]]]  # strings that a text holds whole
        new = np.ones(len(array), bool)
        new[1:] = ~same_bytes(joined, array[1:], array[:-1], np.full(len(array[1:]), width))
        owner = np.repeat(np.arange(len(together)), total[together])[array]
        new[1:] |= owner[1:] != owner[:-1]
        holder = ids[texts][text[array]]
        least = np.minimum.reduceat(holder, np.flatnonzero(new))[np.cumsum(new) - 1] if len(new) else holder
        out[edge[texts][text[array]] + place[array]] = least
    return out


def _cut(width: int, schema: pa.Schema):
    def run(seg: S.Segment, replies: pa.Table) -> pa.Table:
        n, edge = len(seg.buf), np.zeros(len(seg.buf) + 1, np.int32)
        named, ids, lo, hi = (S.gather(replies, c, t) for c, t in (("at", np.int64), ("id", np.int64), ("lo", np.int32), ("hi", np.int32)))
        hot = np.sort(S.gather(replies, "hot", np.uint64))
        if len(named):
            runs = Runs(seg, width)
            cold = np.flatnonzero(~np.isin(runs.key, hot))
            at, size, id_, h = [runs.start[cold]], [runs.count[cold] + width - 1], [runs.id[cold]], [runs.text[cold]]
            if len(hot):
                begin, whose = _hot_strings(runs, hot)
                at.append(begin)
                size.append(np.full(len(begin), width))
                id_.append(whose)
                h.append(Rolling(BYTE[seg.buf]).spans(begin, begin + width))
            at, size, id_, h = (np.concatenate(x) for x in (at, size, id_, h))
            hit = np.isin(h, h[np.isin(at, named)])
            at, size, id_, h = at[hit], size[hit], id_[hit], h[hit]
            # Replies are for a text and the id that asked: the first of the segment and one later stand for the rest.
            by, first = classes(seg.buf, at, size, h, id_)
            own = at[by[first]]
            at, id_ = at[by], id_[by]
            order = np.lexsort([ids, named])
            named, ids, lo, hi = named[order], ids[order], lo[order], hi[order]
            asked = np.ones(len(named), bool)
            asked[1:] = (named[1:] != named[:-1]) | (ids[1:] != ids[:-1])
            head = np.flatnonzero(asked)
            stop = np.append(head[1:], len(named))
            names = named[head]
            last = np.searchsorted(names, own, "right") - 1
            # The reply of the largest id up to the run's own.
            low = np.searchsorted(names, own, "left")
            pick = np.where(ids[head][last] <= id_, last, last - 1)
            ok = (pick >= low) & (ids[head][pick] <= id_)
            at, pick = at[ok], pick[ok]
            times = stop[pick] - head[pick]
            which = np.repeat(head[pick] - np.cumsum(times) + times, times) + np.arange(times.sum())
            np.add.at(edge, np.repeat(at, times) + lo[which], 1)
            np.add.at(edge, np.repeat(at, times) + hi[which] + width - 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        cut = seg.bounds[:-1][seg.bounds[:-1] < n]
        first[cut] = gone[cut]
        sums, spans = (np.concatenate([[0], np.cumsum(x)])[seg.bounds] for x in (gone, first))
        bounds = seg.bounds - sums
        kept = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(seg.buf[~gone].tobytes())])
        return pa.Table.from_arrays([*seg.rest().columns, *(pa.array(np.diff(x).astype(np.int64)) for x in (seg.bounds, sums, spans)), kept], schema=schema)

    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, carry: list[str] | None = None, hot: int = HOT) -> DataFrame:
    """Rows of docs with the carried columns (by default the id), n_bytes, n_removed, n_spans and kept_bytes.

    A byte goes if a string of `width` bytes that covers it also begins in a row with a smaller id.
    """
    if width <= GRAM:
        raise ValueError(f"strings have more than {GRAM} bytes")
    carry = [id_col] if carry is None else carry
    packed = S.Packed(docs, id_col, text_col, carry)
    n = packed.hash_buckets()
    keys = packed.ask(_send_keys(n, width), "bucket long, seg long, h binary")
    shared = stored(S.settle(keys, _shared_keys(hot), "seg long, found binary, hot binary"), "shared")
    texts = packed.answer(shared, _send_texts(4 * n, width), "bucket long, seg long, key binary, text binary, at binary, id binary, size binary, bytes binary")
    hits = S.settle(texts, _sort_texts(width), "seg long, at binary, id binary, lo binary, hi binary")
    replies = hits.unionByName(shared.where("hot is not null").select("seg", "hot"), allowMissingColumns=True)
    kind = T.StructType([*packed.carry, *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_bytes", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    out = packed.answer(replies, _cut(width, to_arrow_schema(kind)), kind)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "n_bytes", "n_removed", "n_spans", "kept_bytes")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


# Bytes as hex digits, two each: DuckDB has no slices of blobs with an index past its end.
ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(x) // 2 - 49)) AS s, x FROM d WHERE length(x) >= 100),
g AS (SELECT doc_id, s, md5_number(substr(x, 2 * s::BIGINT + 1, 100)) AS m FROM p),
r AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY m) AS f FROM g),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM r WHERE doc_id > f),
e AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS q FROM gone),
a AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE q IS NULL OR q < i - 1) AS n_spans, list(i ORDER BY i) AS l FROM e GROUP BY doc_id),
cut AS (SELECT d.doc_id, i, x FROM d JOIN (SELECT doc_id, unnest(range(0, length(x) // 2)) AS i FROM d) USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM a)),
k AS (SELECT cut.doc_id, string_agg(substr(x, 2 * cut.i::BIGINT + 1, 2), '' ORDER BY cut.i) AS kept FROM cut ANTI JOIN gone ON cut.doc_id = gone.doc_id AND cut.i = gone.i GROUP BY cut.doc_id)
SELECT d.doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN a.doc_id IS NULL THEN x ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""
