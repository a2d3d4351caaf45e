"""Shared pieces: scratch tables in the cluster's shared folder, and vectorised text hashing."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

WHITE_SPACE = r"[^\x20\x09-\x0D]+"
made: list[str] = []  # scratch tables of this driver, oldest first


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables. Results that were computed from them must be written by then."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under spark.checkpoint.dir; a temporary folder of our own only where that is unset and
    everything runs on one machine (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    made.append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- vectorised text

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; a bijection, so equal inputs and only those give equal outputs."""
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return have[0][:n], have[1][:n]


_SEEDS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)  # the first k bytes of a lane
LONG = 64  # bytes of a word that are hashed lane by lane


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on (zeros behind the end) as one number, the first byte lowest; no copy for each position."""
    return np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]).data, 0, (1,))


def lane_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of spans by lanes of 8 bytes, each multiplied in and mixed before the next; spans above LONG bytes by blake2b.
    No sum of powers, so no texts that cancel out whatever the base."""
    size = ends - starts
    h = mix(size.astype(np.uint64) + _SEEDS[which])
    words = lanes(buf)
    rows = np.flatnonzero(size <= LONG)
    at, left = starts[rows], size[rows]
    while len(rows):
        h[rows] = mix((h[rows] * _M1) ^ (words[at] & KEEP[np.minimum(left, 8)]))
        go = left > 8
        rows, at, left = rows[go], at[go] + 8, left[go] - 8
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].data, digest_size=8, salt=bytes([which])).digest(), "little")
    return h


class Rolling:
    """Polynomial hashes of any spans of one sequence, from prefix sums modulo 2**64. For spans of values that are hashes already, or of
    a few dozen bytes: long texts of two letters can be built that cancel out for every base, so nothing is decided by hashes
    of long spans of bytes."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        up, self.down = powers(_BASES[which], n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """One hash for each start from 0 to n - width."""
        n = len(self.sums) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[: n - width + 1]) * self.down[: n - width + 1])


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return buf + (((buf >= 65) & (buf <= 90)).astype(np.uint8) << 5)


def in_word(buf: np.ndarray) -> np.ndarray:
    """True where a byte is not one of the separators 0x20 and 0x09 to 0x0D."""
    return ~((buf == 32) | ((buf >= 9) & (buf <= 13)))


def word_spans(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (maximal runs of True within a document) as starts and ends; first[d]: index of document d's first word."""
    n = len(inside)
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = bounds[:-1][bounds[:-1] < n]
        begins[cut] = inside[cut]
        cut = bounds[1:][bounds[1:] > 0] - 1
        ends[cut] = inside[cut]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, bounds)


class Words:
    """The words of a run of documents: their spans, hashes and documents."""

    def __init__(self, buf: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.buf = lower_ascii(buf) if lower else buf
        self.inside = in_word(buf)
        self.starts, self.ends, self.first = word_spans(self.inside, bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.rel = np.arange(len(self.starts)) - self.first[self.doc] if len(self.starts) else np.zeros(0, np.int64)

    def hashes(self, which: int = 0) -> np.ndarray:
        return lane_hashes(self.buf, self.starts, self.ends, which)

    def room(self, width: int) -> np.ndarray:
        """True for each word at which a window of that width begins within its document."""
        return self.rel + width <= self.counts[self.doc]


def padded(values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[: len(values)] = values
    return out
