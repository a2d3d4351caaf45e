"""Joins that plain equality can't express: as-of, nearest, interval, band, containment, cascades and reconciliation.

None of them is a range join over a whole key. As-of joins carry values through ordered windows, in time buckets so that
a key with a third of all rows isn't one task; nearest and band joins meet in bins; containment sends few quotes along with
one pass over the units, and meets in word triples where quotes are many.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: list[str], bucket=None, strict: bool = False) -> DataFrame:
    """left with, for each row, `values` of the last right row of its key at or before it (strict: before it).

    Ties on right_on go to the row with the largest `values`. bucket: column expression of a time, coarser than it
    (e.g. lambda c: F.date_trunc("day", c)); each bucket is then a window of its own, and one row a bucket carries the
    last value on. Null times on either side match nothing.
    """
    bucket = bucket or (lambda c: F.lit(0))
    pack = F.struct(*(F.col(v) for v in values))
    last = right.where(F.col(right_on).isNotNull()).groupBy(*by, right_on).agg(F.max(pack).alias("__v"))
    r = last.select(*by, F.col(right_on).alias("__t"), "__v", F.lit(1 if strict else 0).alias("__side"), F.lit(None).alias("__l"))
    whole = F.struct(*left.columns)
    l = left.select(*by, F.col(left_on).alias("__t"), F.lit(None).alias("__v"), F.lit(0 if strict else 1).alias("__side"), whole.alias("__l"))
    both = r.unionByName(l).withColumn("__b", bucket(F.col("__t")))
    in_bucket = Window.partitionBy(*by, "__b").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("__near", F.last("__v", ignorenulls=True).over(in_bucket)).where("__l is not null")
    ends = r.withColumn("__b", bucket(F.col("__t"))).groupBy(*by, "__b").agg(F.max_by("__v", "__t").alias("__end"))
    wanted = filled.where("__near is null and __t is not null").select(*by, "__b").distinct().withColumn("__end", F.lit(None))
    over_buckets = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    steps = ends.unionByName(wanted, allowMissingColumns=True).groupBy(*by, "__b").agg(F.first("__end", ignorenulls=True).alias("__end"))
    carried = steps.withColumn("__carry", F.last("__end", ignorenulls=True).over(over_buckets)).select(*by, "__b", "__carry")
    out = filled.join(carried, [*by, "__b"], "left").withColumn("__got", F.when(F.col("__t").isNotNull(), F.coalesce("__near", "__carry")))
    return out.select("__l.*", *(F.col(f"__got.{v}").alias(v) for v in values))


def nearest_join(left: DataFrame, right: DataFrame, by: list[str], left_on: Column, right_on: Column, tolerance: float, order: list[str], left_key: list[str]) -> DataFrame:
    """Each left row (left_key identifies it) with the right row whose number lies nearest, within tolerance; ties by order.

    Right columns must not clash with left ones. Left rows without a match stay, with nulls.
    """
    cell = F.floor(left_on / tolerance)
    l = left.withColumn("__at", left_on).withColumn("__bin", F.explode(F.array(cell - 1, cell, cell + 1)))
    r = right.withColumn("__r", right_on).withColumn("__bin", F.floor(right_on / tolerance))
    near = l.join(r, [*by, "__bin"]).withColumn("__d", F.abs(F.col("__r") - F.col("__at"))).where(F.col("__d") <= tolerance)
    ranked = near.withColumn("__k", F.row_number().over(Window.partitionBy(*left_key).orderBy("__d", *order))).where("__k = 1")
    found = ranked.select(*left_key, *(c for c in right.columns if c not in by), F.col("__d").alias("distance"))
    return left.join(found, left_key, "left")


def between_marks(df: DataFrame, by: list[str], order: list[str], is_mark: Column, exactly: int) -> DataFrame:
    """Rows strictly between consecutive marks of a key, numbered, where there are exactly so many. An interval join by counting."""
    w = Window.partitionBy(*by).orderBy(*order)
    marked = df.withColumn("__m", is_mark).withColumn("interval", F.sum(F.col("__m").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    open_ = Window.partitionBy(*by)
    inside = marked.withColumn("__last", F.max("interval").over(open_)).where("not __m and interval > 0 and interval < __last")
    whole = Window.partitionBy(*by, "interval")
    counted = inside.withColumn("__n", F.count("*").over(whole)).where(F.col("__n") == exactly)
    return counted.withColumn("nth", F.row_number().over(whole.orderBy(*order)).cast("long")).drop("__m", "__last", "__n")


def band_join(left: DataFrame, right: DataFrame, value: str, other: str, half: float, scales: tuple[float, ...] = (1.0,)) -> DataFrame:
    """Pairs whose numbers agree within `half`, right scaled by each of scales; "as written" (scale 1) has as_written true.

    Rounding of the bins can't lose a pair: a value is looked up in its own bin and both neighbours.
    """
    cell = F.floor(F.col(value) / (2 * half))
    l = left.withColumn("__bin", F.explode(F.array(cell - 1, cell, cell + 1)))
    r = right.withColumn("scale", F.explode(F.array(*map(F.lit, scales)))).withColumn("__scaled", F.col(other) * F.col("scale")).withColumn("__bin", F.floor(F.col("__scaled") / (2 * half)))
    near = F.abs(F.col(value) - F.col("__scaled")) <= half + 1e-9
    return l.join(r, "__bin").where(near).withColumn("as_written", F.col("scale") == 1).drop("__bin", "__scaled")


def words_of(c: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(c, r"[ \t\n\x0B\f\r]+", " ")), " "), lambda w: w != "")


def _alike(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left and right joined by keys, nulls with nulls; keys stand once."""
    r = right.select(*(F.col(k).alias(f"__s_{k}") for k in keys), *(c for c in right.columns if c not in keys))
    return left.join(r, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys))).drop(*(f"__s_{k}" for k in keys))


BLANK = r"[ \u00A0\u1680\u2000-\u200A\u202F\u205F\u3000]"  # Unicode's space separators


def squeezed(c: Column) -> Column:
    """White space as single blanks, none at the ends, where Unicode's blanks (no-break, ideographic) go too."""
    x = F.trim(F.regexp_replace(c, r"[ \t\n\x0B\f\r]{2,}|[\t\n\x0B\f\r]", " "))
    wide = F.concat(F.substring(x, 1, 1), F.substring(x, -1, 1)).rlike(BLANK)  # seldom: texts aren't searched for it
    return F.when(wide, F.regexp_replace(x, rf"\A{BLANK}++|(?<!{BLANK}){BLANK}++\z", "")).otherwise(x)


FEW = 20_000  # anchors that are sent to all tasks
TRIPLE, PAIR, GRAM = 5, 3, 6  # words from which an anchor is three of them, or one; characters of any other anchor


def _anchor(text: str) -> Column:
    """What any text that holds this one must hold at a place of its own: its second to fourth word; of three or four words
    the longest inner one; else, in scripts without blanks too, six characters from the fourth on."""
    words = F.split(F.col(text), " ")
    inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    triple = F.concat(F.lit("t"), F.array_join(F.slice(words, 2, 3), " "))
    return F.when(F.size(words) >= TRIPLE, triple).when(F.size(words) >= PAIR, F.concat(F.lit("w"), longest)).otherwise(F.concat(F.lit("c"), F.substring(F.col(text), 4, GRAM)))


def _within(inner: DataFrame, inner_key: list[str], outer: DataFrame, outer_key: list[str], text: str) -> DataFrame:
    """inner_key and outer_key of texts of `inner` that a text of `outer` holds. Only keys and anchors meet; texts are fetched
    for the pairs that share an anchor."""
    asked = inner.select(*inner_key, _anchor(text).alias("__k"))
    kinds = {
        "t": F.regexp_extract_all(text, F.lit("(?<![^ ])(?=([^ ]+ [^ ]+ [^ ]+))"), F.lit(1)),
        "w": F.split(F.col(text), " "),
        "c": F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)),  # at every place, in one pass
    }
    few = [r[0] for r in asked.select("__k").distinct().limit(FEW + 1).collect()]
    met = []
    for kind, keys in kinds.items():
        own = asked.where(F.col("__k").startswith(kind))
        if len(few) <= FEW:  # few enough to be sent along: texts are reduced to what is asked before their anchors become rows
            of_kind = [k[1:] for k in few if k.startswith(kind)]
            if not of_kind:
                continue
            keys = F.array_intersect(keys, F.from_json(F.lit(json.dumps(of_kind)), "array<string>"))
        held = outer.select(*outer_key, F.explode(F.array_distinct(keys)).alias("__w")).select(*outer_key, F.concat(F.lit(kind), "__w").alias("__k"))
        met.append(own.join(held, "__k").select(*inner_key, *outer_key))
    if not met:
        return inner.limit(0).select(*inner_key).join(outer.limit(0).select(*outer_key), F.lit(True))
    pairs = reduce(DataFrame.unionByName, met)
    both = _alike(_alike(pairs, inner.select(*inner_key, F.col(text).alias("__a")), inner_key), outer.select(*outer_key, F.col(text).alias("__b")), outer_key)
    return both.where(F.expr("contains(__b, __a)")).select(*inner_key, *outer_key)


LIGHT = 4 << 20  # bytes of quotes that are sent to all tasks
WINDOW, BLOCK = 8, 1 << 20  # bytes of a window, and of a text that are looked at together


def _windows(data, at: int, end: int) -> np.ndarray:
    """The WINDOW bytes at every place of data[at:end] as numbers, without a copy."""
    return np.ndarray((max(end - at - WINDOW + 1, 0),), "<u8", data, at, (1,))


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and each number of it, of all ranges lo to hi."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def _pairs_with(quotes: list[bytes], whole_unit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: rows (keys, then a text) become (keys, number of the quote) for each quote that the text holds, or that holds
    the text of over `whole_unit` characters. A pair is compared if it shares the quote's rarest window, or the rarest of eight of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_windows(x, 0, len(x)) for x in quotes]
        owner, every = np.repeat(np.arange(len(quotes)), [len(x) for x in parts]), np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        owner, every = owner[order], every[order]
        common = np.searchsorted(every, every, "right") - np.searchsorted(every, every)
        rarest = np.lexsort([common, owner])
        rarest = np.sort(rarest[np.unique(owner[rarest], return_index=True)[1]])  # in order of windows, as `every` is
        asked, asker = every[rarest], owner[rarest]
        cell = lambda w: (w * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        marked = np.zeros(1 << 20, bool)
        marked[cell(asked)] = True
        longest = max(map(len, quotes))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).fill_null("")
            held = texts.cast(pa.large_binary())
            data = held.buffers()[2]
            if not data:
                continue
            ends = np.frombuffer(held.buffers()[1], "<i8")[held.offset : held.offset + len(held) + 1]
            met = [np.zeros(0, np.int64)]
            for at in range(int(ends[0]), int(ends[-1]), BLOCK):
                here = _windows(data, at, min(at + BLOCK + WINDOW - 1, int(ends[-1])))
                places = np.flatnonzero(marked[cell(here)])
                which, k = _ranges(np.searchsorted(asked, here[places]), np.searchsorted(asked, here[places], "right"))
                row = np.searchsorted(ends, at + places[which], "right") - 1
                met.append(np.unique(row * len(quotes) + asker[k]))
            text = lambda r: data[int(ends[r]) : int(ends[r + 1])].to_pybytes()
            got, last, own = [], -1, b""
            for r, k in zip(*(x.tolist() for x in np.divmod(np.unique(np.concatenate(met)), len(quotes)))):
                if r != last:
                    last, own = r, text(r)
                if quotes[k] in own:
                    got.append((r, k))
            sizes = np.diff(ends)
            short = np.flatnonzero((sizes <= longest) & (pc.utf8_length(texts).to_numpy(zero_copy_only=False) > whole_unit))
            own = _windows(data, 0, int(ends[-1]))[ends[short, None] + (sizes[short, None] - WINDOW) * np.arange(8) // 7]
            lo, hi = np.searchsorted(every, own), np.searchsorted(every, own, "right")
            best = np.argmin(hi - lo, axis=1)[:, None]
            which, k = _ranges(*(np.take_along_axis(x, best, 1)[:, 0] for x in (lo, hi)))
            for r, k in zip(*(x.tolist() for x in np.divmod(np.unique(short[which] * len(quotes) + owner[k]), len(quotes)))):
                if text(r) in quotes[k]:
                    got.append((r, k))
            if got:
                rows, numbers = zip(*got)
                keys = batch.select(range(batch.num_columns - 1)).take(pa.array(rows))
                yield keys.append_column("__n", pa.array(numbers, pa.int64()))

    return run


def containment_join(quotes: DataFrame, units: DataFrame, quote: str, text: str, order: list[str], quote_key: str, least: int = 12, whole_unit: int = 36, cut: bool = False) -> DataFrame:
    """Each quote with the first unit (by order, which identifies units; nulls come last) whose text holds it, or which of over
    `whole_unit` characters stands in the quote. White space is collapsed; quotes under `least` characters match nothing. cut: quotes are
    cut from collapsed texts and taken as they are, so a blank where one ends must be there. Rows of one quote_key (null is one
    too) are one quote in several readings.

    Up to FEW quotes of LIGHT bytes in all are sent to every task, and units are read once; more of them meet units by anchors."""
    q = quotes.select(quote_key, (F.col(quote) if cut else squeezed(F.col(quote))).alias("__x")).where(F.length("__x") >= least)
    u = units.select(*order, squeezed(F.col(text)).alias("__x"))
    first = F.min(F.struct(*(x for o in order for x in (F.col(o).isNull().alias(f"__no_{o}"), F.col(o))))).alias("__u")
    n, size = q.select(F.octet_length("__x").alias("n")).limit(FEW + 1).agg(F.count("n"), F.sum("n")).first()
    if 0 < n <= FEW and size <= LIGHT and min(least, whole_unit) >= WINDOW:
        texts = [r[0] for r in q.select("__x").distinct().collect()]
        numbered = quotes.sparkSession.createDataFrame(list(enumerate(texts)), "__n long, __x string")
        met = u.mapInArrow(_pairs_with([x.encode() for x in texts], whole_unit), StructType([*u.schema.fields[:-1], StructField("__n", LongType())]))
        found = F.broadcast(numbered.join(met.groupBy("__n").agg(first), "__n"))
        best = q.join(found, "__x").groupBy(quote_key).agg(F.min("__u").alias("__u"))
    else:
        q, u = (df.withColumn(h, F.xxhash64("__x")) for df, h in ((q, "__hq"), (u.where("__x <> ''"), "__hu")))  # rows without an id, or with another's, are told apart
        asked, held = [quote_key, "__hq"], [*order, "__hu"]
        pairs = _within(q, asked, u, held, "__x").unionByName(_within(u.where(F.length("__x") > whole_unit), held, q, asked, "__x"))
        best = pairs.groupBy(quote_key).agg(first)
    return _alike(units, _alike(quotes, best.select(quote_key, *(F.col(f"__u.{o}") for o in order)), [quote_key]), order)


def cascade(left: DataFrame, tiers: list[tuple[str, DataFrame, list[str]]], left_key: list[str], value: str) -> DataFrame:
    """Look rows up tier by tier: (name, table, key columns). The first tier in which exactly one value is found decides.

    Rows that a tier has decided don't take part in later ones.
    """
    rest, parts = left, []
    for name, table, keys in tiers:
        unique = table.groupBy(*keys).agg(F.count_distinct(value).alias("__n"), F.min(value).alias(value)).where("__n = 1").drop("__n")
        found = rest.join(unique, keys).select(*left.columns, value, F.lit(name).alias("tier"))
        parts.append(found)
        rest = rest.join(found.select(*left_key), left_key, "left_anti")
    parts.append(rest.select(*left.columns, F.lit(None).cast(dict(parts[0].dtypes)[value]).alias(value), F.lit(None).cast("string").alias("tier")))
    return reduce(DataFrame.unionByName, parts)


def coverage(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys of expected without actual (missing), of actual without expected (extra), and of actual rows more than one (duplicate)."""
    seen = actual.groupBy(key).agg(F.count("*").alias("n"))
    both = expected.select(key).distinct().withColumn("__e", F.lit(True)).join(seen, key, "full")
    problem = F.filter(F.array(F.when(F.col("n").isNull(), "missing"), F.when(F.col("__e").isNull(), "extra"), F.when(F.col("n") > 1, "duplicate")), lambda x: x.isNotNull())
    return both.select(key, F.explode(problem).alias("problem"))


def reconcile(left: DataFrame, right: DataFrame, key: str, checks: dict[str, tuple[str, str]], tolerance: float = 0.0) -> DataFrame:
    """left against right by key: status ok, mismatch (with the names of differing checks) or missing. checks: name -> columns."""
    r = right.select(key, *(F.col(b).alias(f"__r_{name}") for name, (_, b) in checks.items()), F.lit(True).alias("__there"))
    out = left.join(r, key, "left")

    def differs(name, a):
        x, y = F.col(a), F.col(f"__r_{name}")
        if tolerance:
            return F.coalesce(F.abs(x - y) > tolerance, x.isNull() != y.isNull())
        return ~x.eqNullSafe(y)

    problems = F.filter(F.array(*(F.when(differs(n, a), n) for n, (a, _) in checks.items())), lambda p: p.isNotNull())
    status = F.when(F.col("__there").isNull(), "missing").when(F.size(problems) == 0, "ok").otherwise("mismatch")
    return out.select(*left.columns, status.alias("status"), F.when(F.col("__there"), F.array_join(problems, ",")).otherwise("").alias("problems"))


def diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer difference of two versions of a keyed map: key, old, new where they differ (nulls count as values)."""
    o, n = old.select(key, F.col(value).alias("old")), new.select(key, F.col(value).alias("new"))
    return o.join(n, key, "full").where(~F.col("old").eqNullSafe(F.col("new")))


def valid_at(facts: DataFrame, versions: DataFrame, by: list[str], at: str, since: str, values: list[str], bucket=None) -> DataFrame:
    """Facts with the version in force: [since, next since) of its key. The half-open interval join as an as-of join."""
    return asof_join(facts, versions.withColumn("valid_since", F.col(since)), by, at, since, ["valid_since", *values], bucket)


def carry(items: DataFrame, before: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Fill empty reviewer fields from earlier items by natural key; earlier items without a successor stay, marked stale."""
    old = before.groupBy(*key).agg(*(F.max(f).alias(f"__{f}") for f in fields))
    new = items.join(old, key, "left").select(*key, *(F.coalesce(f, f"__{f}").alias(f) for f in fields), F.lit(False).alias("stale"))
    gone = old.join(items.select(*key).distinct(), key, "left_anti").select(*key, *(F.col(f"__{f}").alias(f) for f in fields), F.lit(True).alias("stale"))
    return new.unionByName(gone)


def expand_preferred(facts: DataFrame, tags: str, documents: DataFrame, tag: str, rank: str, fact_key: str, fallback: DataFrame | None = None) -> DataFrame:
    """Explode each fact's tags and take the best document of each (smallest rank); facts without tags take the fallback documents."""
    best = documents.withColumn("__n", F.row_number().over(Window.partitionBy(tag).orderBy(rank))).where("__n = 1").drop("__n")
    tagged = facts.select("*", F.explode(F.array_distinct(tags)).alias(tag)).join(best, tag)
    if fallback is None:
        return tagged
    none = facts.where(F.coalesce(F.size(tags), F.lit(0)) <= 0)
    return tagged.unionByName(none.withColumn("__one", F.lit(1)).join(fallback.withColumn("__one", F.lit(1)), "__one").drop("__one"), allowMissingColumns=True)
