"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Characters become classes (letter, number, space, other white space, rest, and apostrophes that may begin a contraction);
each class is a function from scanner states to scanner states. Composition of functions is associative, so states are
found by a scan over blocks: compose within blocks, scan the block functions, replay. Token boundaries follow from
neighbouring states and classes; no regular expression runs. The slices' merges are found for all new slices of a batch
at once, and kept in a cache; ids keep their byte offsets.

Defined results: null and empty texts have no ids; special strings are ordinary text; rows stay one to one.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import utf8

# Classes. Apostrophes: ONE begins 's 't 'm 'd, TWO begins 're 've 'll; both stand for "rest" inside a run of rest.
LETTER, NUMBER, SPACE, WHITE, REST, ONE, TWO = range(7)
# States: in a run of letters, numbers, rest; after a space; after other white space; in a contraction with one or two
# letters to come; after a whole contraction.
IN_LETTERS, IN_NUMBERS, IN_REST, AFTER_SPACE, AFTER_WHITE, TO_COME_1, TO_COME_2, CONTRACTED = range(8)
BLOCK = 64
CHUNK_CHARS = 1 << 20
CACHE = 1 << 18


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point."""
    table = np.full(sys.maxunicode + 1, REST, np.uint8)
    chars = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"[\t-\r\x85\p{Z}]+", WHITE)):
        for m in regex.finditer(pattern, chars):
            first, last = ord(m[0][0]), ord(m[0][-1])
            table[first : last + 1] = kind
    table[32] = SPACE
    return table


@functools.cache
def moves() -> np.ndarray:
    """moves()[class, state]: the state after a character of that class."""
    t = np.empty((7, 8), np.uint8)
    t[LETTER], t[NUMBER], t[SPACE], t[WHITE], t[REST] = IN_LETTERS, IN_NUMBERS, AFTER_SPACE, AFTER_WHITE, IN_REST
    t[LETTER, TO_COME_2], t[LETTER, TO_COME_1] = TO_COME_1, CONTRACTED
    t[ONE], t[TWO] = TO_COME_1, TO_COME_2
    t[[ONE, TWO], IN_REST] = t[[ONE, TWO], AFTER_SPACE] = IN_REST
    return t


def _scan(kinds: np.ndarray) -> np.ndarray:
    """The state after each character, from the state after white space."""
    n, t = len(kinds), moves()
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, WHITE, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))  # each block's function
    flat = t.ravel()
    for k in range(BLOCK):
        whole = flat[(grid[k].astype(np.int16) * 8)[:, None] + whole]
    step = 1
    while step < rows:  # inclusive scan by doubling
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].copy(), axis=1)
        step *= 2
    state = np.concatenate([[AFTER_WHITE], whole[:-1, AFTER_WHITE]]).astype(np.uint8)
    out = np.empty((BLOCK, rows), np.uint8)
    for k in range(BLOCK):
        state = flat[grid[k].astype(np.int16) * 8 + state]
        out[k] = state
    return out.T.ravel()[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a slice begins. points: code points; first: where texts begin."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kinds = classes()[points]
    begins = np.zeros(n + 3, bool)
    begins[first[first < n]] = True
    begins[n] = True
    after = np.zeros((2, n), np.uint32)
    for k in (1, 2):  # the next characters of the same text
        after[k - 1, : n - k] = points[k:]
    after[0][begins[1 : n + 1]] = 0
    after[1][begins[1 : n + 1] | begins[2 : n + 2]] = 0
    quote = points == 39
    one = quote & np.isin(after[0], [ord(c) for c in "stmd"])
    pair = after[0].astype(np.uint64) << np.uint64(21) | after[1]
    two = quote & np.isin(pair, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")])
    kinds[one], kinds[two] = ONE, TWO
    starts = begins[:n]
    # Texts don't see each other: a text's first character meets the state after white space.
    scanned = kinds
    inner = np.flatnonzero(starts)[1:]
    if len(inner):
        scanned = np.insert(kinds, inner, WHITE)
        keep = np.ones(len(scanned), bool)
        keep[inner + np.arange(len(inner))] = False
        state = _scan(scanned)[keep]
    else:
        state = _scan(scanned)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = AFTER_WHITE, state[:-1]
    before[starts] = AFTER_WHITE
    white = (kinds == SPACE) | (kinds == WHITE)
    run = {IN_LETTERS: state == IN_LETTERS, IN_NUMBERS: state == IN_NUMBERS, IN_REST: state == IN_REST}
    cut = np.ones(n, bool)
    for kind, now in run.items():
        cut &= ~(now & (before == kind))
        cut &= ~(now & (before == AFTER_SPACE))  # a space belongs to the run behind it
    inside = ((state == TO_COME_1) & (before == TO_COME_2)) | ((state == CONTRACTED) & (before == TO_COME_1))
    cut &= ~inside
    # White space: the last of a run before anything else stands apart from those before it; at a text's end it doesn't.
    last = np.empty(n, bool)
    last[:-1], last[-1] = ~white[1:], False
    last &= ~begins[1 : n + 1]
    follows = white.copy()
    follows[0], follows[1:] = False, white[1:] & white[:-1]
    follows &= ~starts
    cut[white] = ~(follows & ~last)[white]
    cut[starts] = True
    return cut


class Vocabulary:
    """Ranks of a .tiktoken file, and merges of many slices at once."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        # An open-addressed table: a few probes find a pair's rank, or that it has none.
        self.mask = (1 << 21) - 1
        self.slot_key, self.slot_rank = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int32)
        keys, ranks = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        self.probes, left = 0, np.arange(len(keys))
        while len(left):
            slot = self._slot(keys[left], self.probes)
            free = self.slot_key[slot] == -1
            _, one = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[one]
            self.slot_key[slot[won]], self.slot_rank[slot[won]] = keys[left[won]], ranks[left[won]]
            left = np.delete(left, won)
            self.probes += 1
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.cache: dict[bytes, bytes] = {}

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) + probe & self.mask

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 20 | b
        slot = self._slot(keys, 0)
        found = np.where(self.slot_key[slot] == keys, self.slot_rank[slot], NONE)
        left = np.flatnonzero((self.slot_key[slot] != keys) & (self.slot_key[slot] != -1))
        for probe in range(1, self.probes):
            if not len(left):
                break
            slot = self._slot(keys[left], probe)
            hit = self.slot_key[slot] == keys[left]
            found[left[hit]] = self.slot_rank[slot[hit]]
            left = left[~hit & (self.slot_key[slot] != -1)]
        return found

    def merge(self, slices: list[bytes]) -> list[bytes]:
        """Ids of each slice, as little-endian 32-bit integers: lowest rank first, leftmost first, until no pair is left."""
        out: list[bytes | None] = [int(r).to_bytes(4, "little") if (r := self.ranks.get(s)) is not None else None for s in slices]
        todo = [i for i, x in enumerate(out) if x is None]
        todo.sort(key=lambda i: len(slices[i]))
        at = 0
        while at < len(todo):  # slices of like length together
            size = len(slices[todo[at]])
            to = at + 1
            while to < len(todo) and len(slices[todo[to]]) <= max(size + 2, size * 5 // 4) and (to - at) * len(slices[todo[to]]) < 1 << 20:
                to += 1
            for i, ids in zip(todo[at:to], self._merge([slices[i] for i in todo[at:to]])):
                out[i] = ids
            at = to
        return out

    def _merge(self, slices: list[bytes]) -> list[bytes]:
        if len(slices) == 1 and len(slices[0]) > 512:
            return [self._merge_long(slices[0])]
        lens = np.array([len(s) for s in slices])
        width = int(lens.max())
        ids = np.zeros((len(slices), width), np.int32)
        mask = np.arange(width) < lens[:, None]
        ids[mask] = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        ranks = np.full((len(slices), width), NONE, np.int32)
        both = mask[:, 1:]
        ranks[:, :-1][both] = self.pair_ranks(ids[:, :-1][both], ids[:, 1:][both])
        rows = np.arange(len(slices))
        done: list[bytes | None] = [None] * len(slices)
        while len(rows):
            best = ranks.argmin(axis=1)
            at = np.arange(len(rows))
            value = ranks[at, best]
            over = value == NONE
            for i in np.flatnonzero(over).tolist():
                done[rows[i]] = ids[i, : lens[i]].astype("<u4").tobytes()
            if over.any():
                keep = ~over
                rows, ids, ranks, lens, best, value = rows[keep], ids[keep], ranks[keep], lens[keep], best[keep], value[keep]
                at = np.arange(len(rows))
                if not len(rows):
                    break
            # Replace the pair and close the gap.
            cols = np.arange(ids.shape[1])
            shift = np.minimum(cols + (cols > best[:, None]), ids.shape[1] - 1)
            ids, ranks = np.take_along_axis(ids, shift, 1), np.take_along_axis(ranks, shift, 1)
            ids[at, best] = value
            lens = lens - 1
            ranks[cols >= (lens - 1)[:, None]] = NONE
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.pair_ranks(ids[left, best[left] - 1], ids[left, best[left]])
            right = np.flatnonzero(best + 1 < lens)
            ranks[right, best[right]] = self.pair_ranks(ids[right, best[right]], ids[right, best[right] + 1])
        return done

    def _merge_long(self, piece: bytes) -> bytes:
        """One very long slice: a heap of pairs over a linked list."""
        import heapq

        n = len(piece)
        ids, after, before = self.single[np.frombuffer(piece, np.uint8)].tolist(), [*range(1, n), -1], list(range(-1, n - 1))
        first = self.pair_ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        pair = {}
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        token, rank = self.bytes, self.ranks
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    key = ids[x], ids[y]
                    if key not in pair:
                        pair[key] = rank.get(token[key[0]] + token[key[1]])
                    if pair[key] is not None:
                        heapq.heappush(heap, (pair[key], x, *key))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode(self, slices: list[bytes]) -> list[bytes]:
        cache = self.cache
        new = [s for s in set(slices) if s not in cache]
        if new:
            if len(cache) + len(new) > CACHE:
                cache.clear()
                new = list(set(slices))
            cache.update(zip(new, self.merge(new)))
        return [cache[s] for s in slices]


NONE = np.iinfo(np.int32).max


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(buf: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """Ids of each of the UTF-8 texts joined in buf, as little-endian 32-bit integers."""
    text = buf.tobytes()
    points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)  # byte at which each character begins
    cut = boundaries(points, np.searchsorted(lead, bounds[:-1]))
    begin = lead[cut]
    edges = [*begin.tolist(), len(text)]
    slices = [text[i:j] for i, j in zip(edges, edges[1:])]
    pieces = vocab.encode(slices)
    per_doc = np.searchsorted(begin, bounds)
    return [b"".join(pieces[i:j]) for i, j in zip(per_doc, per_doc[1:])]


def token_offsets(ids: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Where each token begins, in bytes: tokens cover the text without gaps."""
    lens = np.fromiter((len(vocab.bytes[i]) for i in ids), np.int64, len(ids))
    return np.cumsum(lens) - lens


def decode(ids: bytes, vocab: Vocabulary) -> bytes:
    token = vocab.bytes
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _batches(batches, path: str, emit, schema):
    vocab = vocabulary(path)
    try:
        for batch in batches:
            buf, bounds = utf8(batch.column(batch.num_columns - 1))
            at = 0
            while at < batch.num_rows:
                to = min(batch.num_rows, max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK_CHARS, "right")) - 1))
                ids = encode_texts(buf[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], vocab)
                columns = [c.slice(at, to - at) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, *emit(ids, vocab)], schema=schema)
                at = to
    finally:  # the worker process goes on to other tasks
        vocab.cache.clear()


def encode(docs: DataFrame, path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Carried columns, n_tokens, ids (array of int) and offsets (the byte at which each token begins)."""
    carry = ["doc_id"] if carry is None else carry
    kept = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)), F.col(f"`{text_col}`").cast("string").alias("text"))
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType([*kept.schema.fields[:-1], *T._parse_datatype_string("n_tokens long, ids array<int>, offsets array<bigint>").fields])
    schema = to_arrow_schema(kind)

    def emit(ids, vocab):
        arrays = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
        return pa.array([len(a) for a in arrays], pa.int64()), pa.array(arrays, pa.list_(pa.int32())), pa.array([token_offsets(a, vocab) for a in arrays], pa.list_(pa.int64()))

    out = kept.mapInArrow(lambda batches: _batches(batches, path, emit, schema), kind)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "n_tokens", "ids", "offsets")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and decodes its ids again: n_tokens and SHA-256 of both, without sending the ids to the JVM."""
    kept = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def emit(ids, vocab):
        return pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array([hashlib.sha256(decode(x, vocab)).hexdigest() for x in ids])

    return kept.mapInArrow(lambda batches: _batches(batches, path, emit, schema), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
