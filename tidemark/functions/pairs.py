"""The pair of numbers that a figure comes from, by lookup: for each number and operation the other one must lie in a known
interval, which is looked up among the row's sorted numbers. Work is that of a sort, not of all pairs; what is looked up
is checked by the operation itself. Of at most FEW numbers all pairs are less work than the lookups. Rows of an Arrow batch are
searched together, by arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPERATIONS = ["+", "-", "*", "/", "/ %", "growth %", "* %"]
FOUND = T.StructType([T.StructField("op", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in "ab"), *(T.StructField(c, T.IntegerType()) for c in "ij")])
CHUNK = 1 << 14  # numbers that are searched at a time
FEW = 24


def results(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """What each operation makes of two numbers."""
    return [a + b, a - b, a * b, a / b, 100 * a / b, 100 * (a - b) / np.abs(b), a * b / 100]


def intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For results between low and high, or their negatives, where the second number lies; bounds may come in either order."""
    big = np.full(len(a), np.inf)
    for lo, hi in ((low, high), (-high, -low)):
        yield lo - a, hi - a
        yield a - hi, a - lo
        yield lo / a, hi / a
        yield 100 * lo / a, 100 * hi / a
        for part in (a, 100 * a):
            around = (lo <= 0) & (hi >= 0)  # results about zero: all numbers far enough out
            x, y = part / lo, part / hi
            least, most = np.minimum(x, y), np.maximum(x, y)
            yield np.where(around, -big, least), np.where(around, np.minimum(least, 0), most)
            yield np.where(around, np.maximum(most, 0), big), big
        for sign in (1, -1):  # growth against a positive, against a negative number
            p, q = 1 + sign * lo / 100, 1 + sign * hi / 100
            around = (np.minimum(p, q) <= 0) & (np.maximum(p, q) >= 0)
            x, y = a / p, a / q
            yield np.where(around, -big, np.minimum(x, y)), np.where(around, big, np.maximum(x, y))


def _place(values: np.ndarray, start: np.ndarray, stop: np.ndarray, x: np.ndarray, after: bool) -> np.ndarray:
    """Where x belongs among values[start:stop], for each x; behind equal ones if `after`."""
    lo, hi = start.copy(), stop.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        v = values[np.minimum(mid, len(values) - 1)]
        below = open_ & ((v <= x) if after else (v < x))
        lo, hi = np.where(below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
    return lo


def first_pairs(value: np.ndarray, decimals: np.ndarray, numbers: np.ndarray, local: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each row its first pair by place: op (an index, -1 for none), i and j, places in the row's numbers[bounds[r]:bounds[r + 1]]."""
    rows = len(value)
    op, first, second = np.full(rows, -1), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    if not len(row):
        return op, first, second
    lens = np.diff(bounds)
    few = np.flatnonzero((lens <= FEW)[row])
    own_few = lens[row[few]]
    pairs = [(np.repeat(few, own_few), np.repeat(bounds[row[few]] - np.cumsum(own_few) + own_few, own_few) + np.arange(own_few.sum()))]
    many = np.flatnonzero((lens > FEW)[row])
    unit = np.power(10.0, -decimals.astype(np.float64))
    half = (0.5 * unit + 1e-9)[row]
    target = np.abs(value)[row]
    with np.errstate(all="ignore"):
        order = many[np.lexsort([numbers[many], row[many]])]
        ranked, place = numbers[order], np.cumsum((lens > FEW)[row])
        from_ = place[bounds[row[many]]] - 1
        for lo, hi in intervals(numbers[many], (target - half)[many], (target + half)[many]) if len(many) else ():
            lo, hi = np.minimum(lo, hi), np.maximum(lo, hi)
            near = lambda x: 1e-9 * (np.abs(np.where(np.isfinite(x), x, 0)) + 1)  # noqa: E731  what rounding of the bounds may cost
            k0, k1 = (_place(ranked, from_, from_ + lens[row[many]], x, after) for x, after in ((lo - near(lo), False), (hi + near(hi), True)))
            n = np.maximum(np.where(np.isnan(lo) | np.isnan(hi), 0, k1 - k0), 0)
            who = np.repeat(many, n)
            pairs.append((who, order[np.repeat(k0 - np.cumsum(n) + n, n) + np.arange(n.sum())]))
        a, b = (np.concatenate(x) for x in zip(*pairs))
        own = (a != b) & (local[a] | local[b])
        a, b = a[own], b[own]
        if len(many):  # all pairs come in order
            by = np.lexsort([b, a])
            a, b = a[by], b[by]
        x, y, r = numbers[a], numbers[b], row[a]
        large = np.minimum(np.abs(x), np.abs(y)) >= 10 * unit[r]
        wanted, within = target[a], half[a]
        which = np.full(len(a), len(OPERATIONS), np.int8)
        for k, result in reversed(list(enumerate(results(x, y)))):
            good = np.abs(wanted - np.abs(result)) <= within
            which[good & large if k < 2 else good] = k
    hit = np.flatnonzero(which < len(OPERATIONS))
    r, at = np.unique(r[hit], return_index=True)
    hit = hit[at]
    op[r], first[r], second[r] = which[hit], a[hit] - bounds[r], b[hit] - bounds[r]
    return op, first, second


@F.pandas_udf(FOUND)
def _searched(value: pd.Series, decimals: pd.Series, numbers: pd.Series, local: pd.Series) -> pd.DataFrame:
    have = [x if x is not None else () for x in numbers]
    lens = np.array([len(x) for x in have], np.int64)
    edge = np.concatenate([[0], np.cumsum(lens)])
    flat = np.concatenate([np.asarray(x, np.float64) for x in have]) if lens.sum() else np.zeros(0)
    own = np.concatenate([np.asarray(x, bool) for x, n in zip(local, lens) if n]) if lens.sum() else np.zeros(0, bool)
    v, d = value.to_numpy(np.float64, na_value=np.nan), decimals.fillna(0).to_numpy(np.int64)
    out = {"op": [], "a": [], "b": [], "i": [], "j": []}
    at = 0
    while at < len(v):
        to = max(at + 1, int(np.searchsorted(edge, edge[at] + CHUNK, "right")) - 1)
        to = min(to, len(v))
        mine = flat[edge[at] : edge[to]]
        op, i, j = first_pairs(v[at:to], d[at:to], mine, own[edge[at] : edge[to]], edge[at : to + 1] - edge[at])
        base, ok = edge[at:to] - edge[at], op >= 0
        pick = lambda k: np.where(ok, mine[np.where(ok, base + k, 0)] if len(mine) else 0.0, np.nan)
        out["op"] += [OPERATIONS[k] if k >= 0 else None for k in op.tolist()]
        out["a"] += pick(i).tolist()
        out["b"] += pick(j).tolist()
        out["i"] += i.tolist()
        out["j"] += j.tolist()
        at = to
    return pd.DataFrame(out)


def pair_of(value: Column, decimals: Column, numbers: Column, local: Column) -> Column:
    """The first pair (by places i, then j) of numbers that gives a value to so many decimals, as struct (op, a, b, i, j); null if none
    does. local: for each number whether it stands in the figure's own row; one of a pair must."""
    found = _searched(value, decimals, numbers, local)
    return F.when(found["op"].isNotNull(), found)
