"""Checking figures against their sources: by number, by label, by recomputing from neighbours, in tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pairs import pair_of
from ..functions.sizes import small
from ..functions.text import same_number
from ..sources.staging import staged

POOL, RECENT = 80, 40
BIN = 8  # units of a figure's last digit that a bin is wide
LIGHT = 256  # numbers of a source that its figures are compared with one by one


def close(a: Column, b: Column, decimals: Column) -> Column:
    return same_number(a, b, decimals)


def neighbours(df: DataFrame, by: list[str], order: list[str], value: str, recent: int = RECENT) -> DataFrame:
    """Each row with the values of the `recent` rows before it within its key, oldest first: pool."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-recent, -1)
    return df.withColumn("pool", F.collect_list(value).over(w))


def recompute(df: DataFrame, value: str, decimals: str, pool: str, most: int = POOL, wider: str | None = None, key_figures: str | None = None) -> Column:
    """The first pair of values that gives a figure by sum, difference, product, ratio, percent or growth, as struct
    (op, a, b, i, j); null if none does.

    Single digits aren't recomputed, nor is a figure from a copy of itself, nor by a sum or difference with a number under
    ten units of its last digit. pool: the figures of its own row, all of them; after them come the first `most` values of
    wider that aren't in it, and key_figures. One of a pair at least is a value of the own row. The other number of a pair is
    looked up among the sorted ones (functions.pairs), so a row costs a sort and needs no join.
    """
    v, d = F.col(value), F.col(decimals)
    own = F.col(pool)
    none = F.array().cast(df.schema[pool].dataType)
    beyond = F.slice(F.filter(F.coalesce(F.col(wider), none), lambda x: ~F.array_contains(own, x)), 1, most) if wider else none
    last = F.coalesce(F.col(key_figures), none) if key_figures else none
    near = F.filter(F.concat(own, beyond, last) if wider or key_figures else own, lambda x: (x != 0) & ~same_number(x, v, d))
    single = (v == F.floor(v)) & (F.abs(v) < 10)
    near = F.when(~single, near.cast("array<double>"))
    return pair_of(v.cast("double"), d.cast("int"), near, F.transform(near, lambda x: F.array_contains(own.cast("array<double>"), x)))


def _bin(cell: Column) -> Column:
    return F.floor(cell / BIN)


def _bins(cell: Column) -> Column:
    """The bins in which numbers up to two cells away stand: one, or two at the edge of one."""
    return F.sequence(_bin(cell - 2), _bin(cell + 2))


def singled_out(figures: DataFrame, numbers: DataFrame, by: list[str], key: str, value: str, decimals: str, number: str, label: str | None = None, window: str | None = None) -> DataFrame:
    """key, found, slips of every figure: whether its source (by) has its number, and whether it has the number one unit
    of the last digit up or down, so that a match proves little. With label (stems of the figure's own name) and window
    (stems around the number in the source) only numbers that stand next to a word of the label count, for slips too; a
    figure without a label is never found. Numbers meet figures in bins of the figure's own width."""
    unit = F.pow(F.lit(10.0), -F.col(decimals))
    cell = F.floor(F.abs(F.col(value)) / unit + 0.5)
    fig = figures.withColumn("__cell", cell).withColumn("__bin", F.explode(_bins(F.col("__cell"))))
    places = range(16)  # digits a double can have behind its point: a constant, so no table of widths is sent about
    around = [F.col(window).alias("__around")] if window else []
    src = numbers.select(*by, F.abs(F.col(number)).alias("__n"), *around).distinct()
    wide = figures.agg(F.collect_set(F.when(F.col(decimals).between(0, places[-1]), F.col(decimals).cast("int"))).alias("w")).first()["w"]  # at most 16 numbers
    src = src.withColumn("__d", F.explode(F.array(*(F.lit(d) for d in sorted(wide))).cast("array<int>"))).withColumn("__bin", _bin(F.floor(F.col("__n") * F.pow(F.lit(10.0), F.col("__d")) + 0.5)))
    met = fig.withColumn("__d", F.col(decimals).cast("int")).join(src, [*by, "__bin", "__d"])
    beside = F.coalesce(F.arrays_overlap(F.col(label), "__around"), F.lit(False)) if label and window else F.lit(True)
    at = lambda shift: beside & (F.abs(F.abs(F.col(value)) + shift * unit - F.col("__n")) <= 0.5 * unit + 1e-9)
    flags = met.groupBy(key).agg(F.bool_or(at(0)).alias("found"), F.bool_or(at(1) | at(-1)).alias("slips"))
    return figures.select(key).join(flags, key, "left").select(key, F.coalesce("found", F.lit(False)).alias("found"), F.coalesce("slips", F.lit(False)).alias("slips"))


def classify(figures: DataFrame, key: str, tiers: list[tuple[str, DataFrame]], otherwise: str = "unverified") -> DataFrame:
    """The first tier whose table lists a figure's key names its class; figures of earlier tiers leave later ones out."""
    ranked = [t.select(key).distinct().select(key, F.lit(i).alias("__t"), F.lit(name).alias("__c")) for i, (name, t) in enumerate(tiers)]
    best = reduce(DataFrame.unionByName, ranked).groupBy(key).agg(F.min_by("__c", "__t").alias("class"))
    return figures.join(best, key, "left").withColumn("class", F.coalesce("class", F.lit(otherwise)))


def written_results(statements: DataFrame, computed: str, result: str, decimals: str) -> DataFrame:
    """Statements "formula = result" with status holds, rounding (off by one unit of the last digit at most) or error."""
    unit = F.pow(F.lit(10.0), -F.col(decimals))
    off = F.abs(F.col(computed) - F.col(result))
    return statements.withColumn("status", F.when(F.col(computed).isNull(), "unreadable").when(off <= 0.5 * unit + 1e-9, "holds").when(off <= 1.5 * unit, "rounding").otherwise("error"))


def best_excerpt(units: DataFrame, key: list[str], score: list) -> DataFrame:
    """Of each key's candidate passages the first by score."""
    return units.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(*score))).where("__k = 1").drop("__k")


def gate(items: DataFrame, by: list[str], verdict: str, accepted: list[str], blocking: list[str]) -> DataFrame:
    """Counts of accepted, blocked and open items of each key, and whether it passes: nothing open, nothing blocked.
    Verdicts are compared in lower case with blanks as hyphens."""
    v = F.regexp_replace(F.lower(F.trim(F.col(verdict))), "[ _]+", "-")
    counted = items.groupBy(*by).agg(F.count_if(v.isin(accepted)).alias("accepted"), F.count_if(v.isin(blocking)).alias("blocked"), F.count("*").alias("__n"))
    return counted.withColumn("open", F.col("__n") - F.col("accepted") - F.col("blocked")).withColumn("passed", (F.col("open") == 0) & (F.col("blocked") == 0)).drop("__n")


def carried_tags(lines: DataFrame, doc: list[str], line: str, tags: Column, block: Column) -> DataFrame:
    """Lines with the tags that hold for them: their own, else those of the last line of their block that had some."""
    marked = lines.withColumn("__b", F.sum(block.cast("int")).over(Window.partitionBy(*doc).orderBy(line).rowsBetween(Window.unboundedPreceding, 0))).withColumn("__own", F.when(F.size(tags) > 0, tags))
    w = Window.partitionBy(*doc, "__b").orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("tags", F.coalesce(F.last("__own", ignorenulls=True).over(w), F.array().cast("array<string>"))).drop("__b", "__own")


SCALE_POWERS = (0, 3, 6, 9, -3, -6)  # as written, then in thousands, millions, billions, and the other way
REACH = 40  # powers of ten on either side of one


def _ten(e: Column) -> Column:
    """Ten to the power of e, looked up."""
    return F.get(F.array(*(F.lit(float(f"1e{k}")) for k in range(-REACH, REACH + 1))), e + REACH)


def checked(figures: DataFrame, numbers: DataFrame, key: str, value: str, decimals: str, cites: str, tiers: list[tuple[str, str, bool]], *, label: str | None = None, unit: str | None = None, pool: str | None = None, written: str | None = None, own: str | None = None, scales: tuple[int, ...] = SCALE_POWERS) -> DataFrame:
    """Every figure with the class of the first tier that explains it, and the number that does: class, number, scale.

    tiers: (class, kind of source, singled) in order. A figure cites sources as array<struct<kind, ref>>; numbers has kind, ref,
    number (or an array of those that share the rest), around (array of stems beside it) and unit. A number explains a figure if it agrees to the figure's last
    digit at one of the powers of ten, as written first, and no units clash. In a tier that must be singled out (a long
    text, where some number always fits) it counts only if a word of the figure's label stands beside it and no number there
    agrees with the figure one unit of its last digit up or down; without that the figure is `weak`, by the last resort.
    After the tiers come `recomputed` (from two numbers of pool) and `formula` (written holds the status of the formula that ends in
    the figure), then `weak`, then `no fact` (single digits), else `unverified`.

    own: numbers that came with the row, as array<struct<kind, number, around, unit>>, for sources that need no looking up; the figure doesn't
    cite those. They count in the tiers of their kinds like any other.

    All tiers are one join: figures meet the numbers of sources of at most LIGHT numbers as they are, by the source, and those of larger
    ones in bins of a few units of the last digit, once for each power of ten. Sources are counted first, by a hash: two that share one
    are large together, which changes no result. What lies too far off at every power goes before anything is computed, and flags of every tier
    are aggregated by figure, so a figure with many matches is reduced before it is shuffled. What is recomputed is only what no tier
    explains.
    """
    v, d = F.abs(F.col(value).cast("double")), F.col(decimals).cast("int")
    none = F.array().cast("array<string>")
    fig = figures.select(key, v.alias("__v"), d.alias("__d"), F.col(cites).alias("__cites"), (F.col(label) if label else none).alias("__label"), (F.col(unit) if unit else F.lit(None).cast("string")).alias("__unit"))
    asked = fig.where("__d between 0 and 15").select("*", F.explode("__cites").alias("__c")).select(key, "__v", "__d", "__label", "__unit", F.col("__c.kind").alias("kind"), F.col("__c.ref").alias("ref"))
    listed = F.col("number") if dict(numbers.dtypes)["number"].startswith("array") else F.array("number")
    listed = F.transform(F.filter(listed, lambda n: n.isNotNull()), lambda n: F.abs(n.cast("double")))
    src = lambda df: df.select("kind", "ref", listed.alias("__ns"), F.coalesce("around", none).alias("__around"), F.col("unit").alias("__nu")).where("size(__ns) > 0")
    spot = F.hash("kind", "ref")
    counted = src(numbers).groupBy(spot.alias("__spot")).agg(F.sum(F.size("__ns")).alias("n"))
    crowded = small(staged(counted.where(F.col("n") > LIGHT).select("__spot"), "crowded"))
    large = lambda df, how: df.join(crowded, spot == F.col("__spot"), how)
    ranges = src(large(numbers, "left_semi")).groupBy("kind", "ref").agg(F.min(F.array_min("__ns")).alias("__lo"), F.max(F.array_max("__ns")).alias("__hi"))
    x, unit_at = F.col("__v") * _ten(F.col("__s")), _ten(-F.col("__e"))
    reach = lambda v, d: 1.6 * _ten(-d) + 4e-15 * v  # noqa: E731  one and a half units, and what multiplying may lose
    reaching = lambda df, v, d: df.withColumn("__from", v - reach(v, d)).withColumn("__to", v + reach(v, d))
    near = lambda n, *steps: reduce(Column.__or__, ((n * s >= F.col("__from")) & (n * s <= F.col("__to")) for s in steps))
    down = [F.lit(float(f"1e{-s}")) for s in scales]
    scaled = lambda df: df.withColumn("__s", F.explode(F.array(*map(F.lit, scales)))).withColumn("__e", F.col("__d") - F.col("__s")).withColumn("__cell", F.floor(F.col("__v") * _ten(F.col("__d")) + 0.5)).where("__cell < 9e15")
    one = lambda df: df.select("*", F.explode("__ns").alias("__n")).drop("__ns")
    spans = lambda df: reaching(df, F.col("__v"), F.col("__d"))
    few = one(spans(large(asked, "left_anti").join(src(large(numbers, "left_anti")), ["kind", "ref"]))).where(near(F.col("__n"), *down))
    powers = [r["e"] for r in figures.select(d.alias("d")).distinct().where("d between 0 and 15").select(F.explode(F.array(*(F.col("d") - s for s in scales))).alias("e")).distinct().collect()]  # 16 numbers of decimals by six scales at most
    many = one(src(large(numbers, "left_semi"))).distinct()
    many = many.withColumn("__e", F.explode(F.array(*map(F.lit, sorted(powers))).cast("array<int>"))).withColumn("__bin", _bin(F.floor(F.col("__n") * _ten(F.col("__e")) + 0.5)))
    binned = scaled(large(asked, "left_semi").join(small(staged(ranges, "ranges")), ["kind", "ref"]))
    binned = binned.where((x + 3 * unit_at >= 0.999 * F.col("__lo")) & (x - 3 * unit_at <= 1.001 * F.col("__hi"))).drop("__lo", "__hi").withColumn("__bin", F.explode(_bins(F.col("__cell"))))
    met = scaled(few).unionByName(spans(binned).join(many, ["kind", "ref", "__e", "__bin"]).drop("__bin"))
    met = met.where(near(F.col("__n"), _ten(-F.col("__s"))) & (F.col("__n") * _ten(F.col("__e")) < 9e15))
    half = lambda u: 0.5 * u * (1 + 1e-12) + 1e-9 * F.least(F.lit(1.0), u)
    off = lambda x, n, u, shift: F.abs(x + shift * u - n) <= half(u)
    slips = lambda x, n, u: off(x, n, u, 1) | off(x, n, u, -1)
    clash = lambda a, b: F.coalesce(a != b, F.lit(False))
    shares = lambda a, b: F.coalesce(F.arrays_overlap(a, b), F.lit(False))
    fits = ~clash(F.col("__unit"), F.col("__nu"))
    rank = F.array_position(F.array(*map(F.lit, scales)), F.col("__s")).cast("int")
    met = met.select(key, "kind", "__n", rank.alias("__rank"), (off(x, F.col("__n"), unit_at, 0) & fits).alias("__hit"), (slips(x, F.col("__n"), unit_at) & fits).alias("__slip"), shares("__label", "__around").alias("__beside"))
    plain = {kind: i for i, (_, kind, singled) in reversed(list(enumerate(tiers))) if not singled}
    tier_of = lambda kind: reduce(lambda c, kv: c.when(kind == kv[0], kv[1]), plain.items(), F.when(F.lit(False), -1))
    tier = tier_of(F.col("kind"))
    flags = [F.min(F.when(F.col("__hit") & tier.isNotNull(), F.struct(tier.alias("tier"), F.col("__rank").alias("rank"), F.col("__n").alias("n")))).alias("__plain"), F.bool_or("__hit").alias("__some")]
    alone = [(i, kind) for i, (_, kind, singled) in enumerate(tiers) if singled]
    for i, kind in alone:
        here = (F.col("kind") == kind) & F.col("__beside")
        flags += [F.min(F.when(here & F.col("__hit"), F.struct(F.lit(i).alias("tier"), F.col("__rank").alias("rank"), F.col("__n").alias("n")))).alias(f"__t{i}"), F.bool_or(here & F.col("__slip")).alias(f"__x{i}")]
    found = met.where("__hit or __slip").groupBy(key).agg(*flags)
    rows = figures
    if own:
        words, kept = F.col(label) if label else none, F.col(unit) if unit else F.lit(None).cast("string")
        readable = d.between(0, 15) & (F.floor(v * _ten(d) + 0.5) < 9e15)
        number = lambda m: F.abs(m["number"].cast("double"))
        rows = reaching(rows, v, d)
        by_hand = F.filter(F.when(readable, F.col(own)), lambda m: near(number(m), *down) & ~clash(kept, m["unit"]))
        steps = F.array(*(F.struct(F.lit(i + 1).alias("rank"), step.alias("down"), (v * _ten(F.lit(s))).alias("x"), _ten(F.lit(s) - d).alias("u")) for i, (s, step) in enumerate(zip(scales, down))))
        wary = lambda m: m["kind"].isin([kind for _, kind in alone])  # noqa: E731  only there slips count
        pair = lambda m: lambda p: F.struct(m["kind"].alias("kind"), p["rank"].alias("rank"), number(m).alias("n"), off(p["x"], number(m), p["u"], 0).alias("hit"), (wary(m) & slips(p["x"], number(m), p["u"])).alias("slip"), (wary(m) & shares(words, m["around"])).alias("beside"))
        pairs = F.flatten(F.transform(by_hand, lambda m: F.transform(F.filter(steps, lambda p: near(number(m), p["down"]) & (number(m) < 9e15 * p["u"])), pair(m))))
        rows = rows.withColumn("__near", F.filter(pairs, lambda p: p["hit"] | p["slip"]))
        least = lambda i, p: F.struct(i.alias("tier"), p["rank"].alias("rank"), p["n"].alias("n"))
        rows = rows.withColumn("__own", F.array_min(F.transform(F.filter("__near", lambda p: p["hit"] & tier_of(p["kind"]).isNotNull()), lambda p: least(tier_of(p["kind"]), p))))
        rows = rows.withColumn("__own_some", F.exists("__near", lambda p: p["hit"]))
        for i, kind in alone:
            beside = F.filter("__near", lambda p: (p["kind"] == kind) & p["beside"])
            rows = rows.withColumn(f"__own{i}", F.array_min(F.transform(F.filter(beside, lambda p: p["hit"]), lambda p: least(F.lit(i), p)))).withColumn(f"__ownx{i}", F.exists(beside, lambda p: p["slip"]))
        rows = rows.drop("__near", "__from", "__to")
    if pool:
        rows = rows.withColumn("__pool", F.when(F.col("__own").isNull(), F.col(pool)) if own else F.col(pool))  # what a plain tier explains here needs no search
    rows = rows.join(found, key, "left")
    both = lambda a, b: F.least(a, b) if own else a
    true = lambda *c: reduce(Column.__or__, (F.coalesce(y, F.lit(False)) for y in c))
    some = true(F.col("__some"), *([F.col("__own_some")] if own else []))
    first = [both(F.col("__plain"), F.col("__own"))] + [F.when(~true(F.col(f"__x{i}"), *([F.col(f"__ownx{i}")] if own else [])), both(F.col(f"__t{i}"), F.col(f"__own{i}"))) for i, _ in alone]
    rows = rows.withColumn("__first", F.least(*first) if len(first) > 1 else first[0])
    names, powers_of = (F.array(*map(F.lit, y)) for y in ([name for name, *_ in tiers], scales))
    rows = rows.withColumn("__best", F.when(F.col("__first").isNotNull(), F.struct(F.get(names, F.col("__first.tier")).alias("class"), F.col("__first.n").alias("number"), F.get(powers_of, F.col("__first.rank") - 1).alias("scale"))))
    left = F.col("__best").isNull()
    other = lambda name: F.struct(F.lit(name).alias("class"), F.lit(None).cast("double").alias("number"), F.lit(None).cast("int").alias("scale"))
    if pool:
        rows = rows.withColumn("__pool", F.when(left, F.col("__pool")))  # a figure that is explained has no pool to search
        rows = rows.withColumn("__pair", recompute(rows, value, decimals, "__pool"))
    pair = F.col("__pair").isNotNull() if pool else F.lit(False)
    held = F.col(written).isin("holds", "rounding") if written else F.lit(False)
    single = (F.col(value) == F.floor(F.col(value))) & (v < 10) & (d == 0)
    rows = rows.withColumn("__best", F.when(~left, F.col("__best")).when(pair, other("recomputed")).when(F.coalesce(held, F.lit(False)), other("formula")).when(some, other("weak")).when(single, other("no fact")).otherwise(other("unverified")))
    return rows.select(*figures.columns, "__best.class", "__best.number", "__best.scale")
