"""Folds over ordered rows of one key: budgets that skip, budgets that stop, slices, and facts packed by their documents.

Each key's rows (a document's blocks, a slice's requests) are gathered into one array, so a key must be of bounded size:
an issuer's picks or a document's blocks, never a whole corpus. The folds themselves run as `aggregate` in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.binding import once


def _listed(df: DataFrame, by: list[str], order: list[str], fields: list[str]) -> DataFrame:
    row = F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(order)), *fields)
    return df.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("__rows"))


def within_budget(df: DataFrame, by: list[str], order: list[str], cost: str, budget: float, key: str) -> DataFrame:
    """Greedy in order: a row stays if what is used so far leaves room for it; later, smaller rows may still fit."""
    rows = _listed(df, by, order, [key, cost])
    kind = dict(df.dtypes)[key]
    start = F.struct(F.lit(0.0).alias("used"), F.array().cast(f"array<{kind}>").alias("kept"))

    def step(acc, x):
        fits = acc["used"] + x[cost] <= budget
        return F.struct(F.when(fits, acc["used"] + x[cost]).otherwise(acc["used"]).alias("used"), F.when(fits, F.concat(acc["kept"], F.array(x[key]))).otherwise(acc["kept"]).alias("kept"))

    return rows.select(*by, F.explode(F.aggregate("__rows", start, step, lambda acc: acc["kept"])).alias(key))


def slices(df: DataFrame, by: list[str], order: list[str], cost: str, limit: float, key: str) -> DataFrame:
    """Rows in order put into slices of at most `limit`; one that would overflow opens the next. Numbered from 1."""
    rows = _listed(df, by, order, [key, cost])
    kind = dict(df.dtypes)[key]
    start = F.struct(F.lit(0.0).alias("size"), F.lit(0).alias("n"), F.array().cast(f"array<struct<{key}:{kind},slice:int>>").alias("out"))

    def step(acc, x):
        opens = (acc["n"] == 0) | (acc["size"] + x[cost] > limit)
        n = F.when(opens, acc["n"] + 1).otherwise(acc["n"])
        size = F.when(opens, x[cost].cast("double")).otherwise(acc["size"] + x[cost])
        return F.struct(size.alias("size"), n.alias("n"), F.concat(acc["out"], F.array(F.struct(x[key].alias(key), n.alias("slice")))).alias("out"))

    return rows.select(*by, F.explode(F.aggregate("__rows", start, step, lambda acc: acc["out"])).alias("__x")).select(*by, f"__x.{key}", "__x.slice")


def room_left(df: DataFrame, by: list[str], order: list[str], size: str, key: str, most_each: float, most: float, least: float) -> DataFrame:
    """Requests in order: each gets at most most_each and the room left of `most`; less than `least` left, or a request
    cut to the room left, ends it. given: 0 for those that got nothing; cut: whether it got less than it has."""
    rows = _listed(df, by, order, [key, size])
    kind = dict(df.dtypes)[key]
    start = F.struct(F.lit(0.0).alias("used"), F.lit(False).alias("over"), F.array().cast(f"array<struct<{key}:{kind},given:double,cut:boolean>>").alias("out"))

    def step(acc, x):
        room = F.lit(float(most)) - acc["used"]
        over = acc["over"] | (room < least)
        wants = F.least(x[size].cast("double"), F.lit(float(most_each)))
        given = F.when(over, 0.0).otherwise(F.least(wants, room))
        row = F.struct(x[key].alias(key), given.alias("given"), (given < x[size]).alias("cut"))
        return F.struct((acc["used"] + given).alias("used"), (over | (wants > room)).alias("over"), F.concat(acc["out"], F.array(row)).alias("out"))

    return rows.select(*by, F.explode(F.aggregate("__rows", start, step, lambda acc: acc["out"])).alias("__x")).select(*by, "__x.*")


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, sign: str, result: str, decimals: int = 2) -> DataFrame:
    """Rows whose written `result` differs from the signed running total of their key: key columns, i (from 1, among them), expected, written."""
    w = Window.partitionBy(*by).orderBy(*order, value, sign, result)  # ties as their values stand
    moved = F.when(F.col(sign) == "-", -F.col(value)).otherwise(F.col(value)).cast("double")
    rows = df.withColumn("__t", F.sum(moved).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__i", F.row_number().over(w))
    off = F.abs(F.round("__t", decimals) - F.col(result)) > 0.5 * 10**-decimals + 1e-9
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__i"))
    return rows.where(F.col(result).isNotNull() & off).select(*by, place.alias("i"), F.round("__t", decimals).alias("expected"), F.col(result).cast("double").alias("written"))


def pack_by_documents(facts: DataFrame, by: list[str], order: str, docs: str, tokens: DataFrame, doc: str, size: str, most: int, soft: float, hard: float) -> DataFrame:
    """Facts that cite the same documents stay together; groups, largest first, go to the slice that they enlarge least
    within `soft`, else to a new one; a slice's documents beyond `hard` are marked cut.

    Best fit depends on all slices so far, which no expression can fold well, so each key's facts (one bundle) are packed
    by a small function in applyInArrow. A slice is weighed only if it has places left, and travels as one row with its facts, whose
    documents aren't repeated for each of them. Result: key columns, order column, slice (from 1), full and cut documents.
    """
    exploded = facts.select(*by, order, F.explode_outer(F.array_distinct(docs)).alias(doc)).join(tokens.select(doc, size), doc, "left")
    exploded = exploded.repartition(*by)  # for both groupings below
    sized = exploded.groupBy(*by, order).agg(F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col(doc).isNotNull(), F.struct(F.col(doc).cast("string").alias("k"), F.coalesce(size, F.lit(0)).cast("double").alias("v")))))).alias("__docs"))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, [(order, "ascending")]))
        lists = rows.column("__docs").combine_chunks()
        names, values, edge = lists.keys.to_pylist(), lists.items.to_pylist(), lists.offsets.to_pylist()
        weights = dict(zip(names, values))
        groups: dict[frozenset, list] = {}
        for at in range(rows.num_rows):
            groups.setdefault(frozenset(names[edge[at] : edge[at + 1]]), []).append(at)

        def load(keys) -> float:
            return sum(map(weights.__getitem__, keys))

        chunks = [(keys, part[i : i + most]) for keys, part in sorted(groups.items(), key=lambda g: (-load(g[0]), g[1][0])) for i in range(0, len(part), most)]
        bins: list[tuple[set, list]] = []
        loads: list[float] = []
        open_: list[int] = []  # slices with places left
        for keys, part in chunks:
            fitting = []
            for n in open_:
                if len(bins[n][1]) + len(part) <= most:
                    now, then = loads[n], load(bins[n][0] | keys)
                    if then <= soft or then == now:
                        fitting.append((then - now, n))
            if fitting:
                n = min(fitting)[1]
                have, members = bins[n]
                have |= keys
                members += part
                loads[n] = load(have)
            else:
                n = len(bins)
                bins.append((set(keys), list(part)))
                loads.append(load(bins[n][0]))
                open_.append(n)
            if len(bins[n][1]) >= most:
                open_.remove(n)
        out = []
        for n, (have, members) in enumerate(sorted(bins, key=lambda b: min(b[1])), 1):
            full, cut, used = [], [], 0.0
            for k in sorted(have):
                fits = not full or used + weights[k] <= hard
                (full if fits else cut).append(k)
                used += weights[k] if fits else 0.0
            out.append((members, n, full, cut))
        members, number, full, cut = zip(*out)
        held = rows.column(order).combine_chunks().take(pa.array([at for m in members for at in m], pa.int64()))
        ends = pa.array(np.concatenate([[0], np.cumsum([len(m) for m in members])]), pa.int32())
        texts = pa.list_(pa.string())
        first = pa.array([0] * len(out), pa.int64())
        columns = [rows.column(c).take(first) for c in by] + [pa.ListArray.from_arrays(ends, held), pa.array(number, pa.int32()), pa.array(full, texts), pa.array(cut, texts)]
        return pa.table(columns, [*by, "__members", "slice", "full", "cut"])

    kinds = dict(facts.dtypes)
    packed = sized.groupBy(*by).applyInArrow(pack, ", ".join([*(f"`{c}` {kinds[c]}" for c in by), f"__members array<{kinds[order]}>", "slice int", "full array<string>", "cut array<string>"]))
    return packed.select(*by, F.explode("__members").alias(order), "slice", "full", "cut")


def cut_long(text: Column | str, limit: int, breaks: Callable[[Column], Column]) -> Column:
    """A long text cut into pieces of `limit` characters at most (a line counts one more than its length): array of struct(piece,
    size). A piece takes as many lines as fit and ends before the last line of them, or the next one, where `breaks` holds; without
    one in sight it ends where it is full. Lines that are longer are cut first. The pieces joined by line ends are the lines again."""
    wide = limit - 1
    lines = F.split(F.col(text) if isinstance(text, str) else text, "\n")
    whole = lambda x: F.struct(x.alias("x"), (F.length(x) + 1).alias("n"), breaks(x).alias("b"))
    part = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.length(x) - 1) / wide).cast("int")), lambda k: once(F.substr(x, k * wide + 1, F.lit(wide)), lambda y: F.struct(y.alias("x"), (F.length(y) + 1).alias("n"), ((k == 0) & breaks(x)).alias("b"))))
    rows = F.flatten(F.transform(lines, lambda x: F.when(F.length(x) <= wide, F.array(whole(x))).otherwise(part(x))))
    ends = "array<struct<at:int,size:int>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("from"), F.lit(0).alias("size"), F.lit(-1).alias("mark"), F.lit(0).alias("before"), F.array().cast(ends).alias("done"))

    def closed(done: Column, at: Column, size: Column) -> Column:
        return F.array_append(done, F.struct(at.cast("int").alias("at"), size.cast("int").alias("size")))

    def step(s: Column, row: Column) -> Column:
        i, n = s["at"], row["n"]
        full = s["size"] + n > limit
        back = full & ~row["b"] & (s["mark"] > s["from"])
        rest = s["size"] - s["before"]  # what stands behind the last break
        again = back & (rest + n > limit)
        done = F.when(again, closed(closed(s["done"], s["mark"], s["before"]), i, rest)).when(back, closed(s["done"], s["mark"], s["before"])).when(full, closed(s["done"], i, s["size"])).otherwise(s["done"])
        first = F.when(again, i).when(back, s["mark"]).when(full, i).otherwise(s["from"])
        size = F.when(again, n).when(back, rest + n).when(full, n).otherwise(s["size"] + n)
        mark = F.when(row["b"], i).when(full, -1).otherwise(s["mark"])
        before = F.when(row["b"], size - n).otherwise(s["before"])
        return F.struct((i + 1).alias("at"), first.cast("int").alias("from"), size.cast("int").alias("size"), mark.cast("int").alias("mark"), before.cast("int").alias("before"), done.cast(ends).alias("done"))

    def pieces(bound: Column) -> Column:
        last = F.aggregate(bound, start, step)
        ended = once(last, lambda s: F.filter(closed(s["done"], s["at"], s["size"]), lambda c: c["size"] > 0))
        return once(ended, lambda cuts: written(bound, cuts))

    def written(bound: Column, cuts: Column) -> Column:
        return F.transform(cuts, lambda c, k: F.struct(F.array_join(F.transform(F.slice(bound, F.when(k == 0, 1).otherwise(F.get(cuts, k - 1)["at"] + 1), c["at"] - F.when(k == 0, 0).otherwise(F.get(cuts, k - 1)["at"])), lambda r: r["x"]), "\n").alias("piece"), c["size"].alias("size")))

    return once(rows, pieces)
