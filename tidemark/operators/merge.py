"""Merges with a declared winner, ordinals and dependency order.

`dropDuplicates` promises neither the first nor the last row, so every choice here has a total order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row for each key: the first by order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def first_listed(parts: list[DataFrame], key: list[str], order: list) -> DataFrame:
    """Union of tables in order of priority; the first table that lists a key wins, within it the first row by order."""
    marked = [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)]
    return keep_first(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked), key, ["__part", *order]).drop("__part")


def last_group_wins(parts: list[DataFrame], key: list[str], order: list) -> DataFrame:
    """Union of groups of readings; a later group replaces earlier ones by key, within it the last row by order (ascending)."""
    marked = [p.withColumn("__part", F.lit(i)) for i, p in enumerate(parts)]
    return keep_first(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked), key, [F.desc("__part"), *(F.desc(o) for o in order)]).drop("__part")


def insert_only(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows against a register that is never rewritten: action insert, skip (identical) or conflict for each."""
    values = [c for c in new.columns if c != key]
    o = old.select(key, F.struct(*values).alias("__old"))
    out = new.join(o, key, "left")
    action = F.when(F.col("__old").isNull(), "insert").when(F.col("__old").eqNullSafe(F.struct(*values)), "skip").otherwise("conflict")
    return out.withColumn("action", action).drop("__old")


def fill_nulls(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """old with the given fields filled from new where they are null; nothing else changes, and no row goes or comes."""
    n = new.select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    kept = [F.coalesce(c, f"__{c}").alias(c) if c in fields else F.col(c) for c in old.columns]
    return old.join(n, key, "left").select(*kept)


def upsert_unless_final(old: DataFrame, new: DataFrame, key: list[str], field: str, final: list[str]) -> DataFrame:
    """Monotone upsert: a final value never changes; others take the new one. status: kept, changed, added or conflict."""
    o, n = old.select(*key, F.col(field).alias("__o")), new.select(*key, F.col(field).alias("__n"))
    both = o.join(n, key, "full")
    done = F.coalesce(F.col("__o").isin(final), F.lit(False))
    value = F.when(done, F.col("__o")).otherwise(F.coalesce("__n", "__o"))
    status = (
        F.when(done & F.col("__n").isNotNull() & (F.col("__n") != F.col("__o")), "conflict")
        .when(F.col("__o").isNull(), "added")
        .when(value.eqNullSafe(F.col("__o")), "kept")
        .otherwise("changed")
    )
    return both.select(*key, value.alias(field), status.alias("status"))


def overlay(planned: DataFrame, disk: DataFrame, key: list[str]) -> DataFrame:
    """Planned rows shadow those on disk by key."""
    return planned.unionByName(disk.join(planned.select(*key).distinct(), key, "left_anti"))


def merge_selections(df: DataFrame, key: str, flags: list[str], sets: list[str]) -> DataFrame:
    """Union of selections of one key: flags by OR, sets by union, where a null or empty set means everything (result null)."""
    all_of = {s: F.bool_or(F.coalesce(F.size(s) <= 0, F.lit(True))) for s in sets}
    united = {s: F.array_sort(F.array_distinct(F.flatten(F.collect_list(s)))) for s in sets}
    return df.groupBy(key).agg(*(F.bool_or(f).alias(f) for f in flags), *(F.when(~all_of[s], united[s]).alias(s) for s in sets))


def ordinals(df: DataFrame, by: list[str], order: list, name: str = "ordinal") -> DataFrame:
    """Number the rows of a key from 1, and the suffix that shows from the second on."""
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    return numbered.withColumn("suffix", F.when(F.col(name) > 1, F.concat(F.lit("-"), F.col(name).cast("string"))).otherwise(""))


def renumber(df: DataFrame, order: list[str], prefix: str, group: Column, width: int = 3) -> DataFrame:
    """Number all rows in order across groups, without one task for all: counts of groups are summed, rows numbered within.

    group: a column that sorts before the rest of order (a slice number). Adds number and label (prefix and padded number).
    """
    df = df.withColumn("__g", group)
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy("__g").agg(F.count("*").alias("__c")).withColumn("__s", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    within = F.row_number().over(Window.partitionBy("__g").orderBy(*order))
    out = df.withColumn("__k", within).join(starts, "__g")
    number = (F.col("__s") + F.col("__k")).cast("long")
    return out.withColumn("number", number).withColumn("label", F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))).drop("__g", "__k", "__s")


def full_or_nothing(derived: DataFrame, facts: DataFrame, key: str, inputs: str, value: str) -> DataFrame:
    """A derived row has its inputs' values (in order) only if all of them have one."""
    each = derived.select(key, F.posexplode(inputs).alias("__p", "__i"))
    got = each.join(facts.select(F.col(key).alias("__i"), F.col(value).alias("__v")), "__i", "left")
    whole = got.groupBy(key).agg(F.count("*").alias("__n"), F.count("__v").alias("__m"), F.array_sort(F.collect_list(F.struct("__p", "__v"))).alias("__l"))
    return derived.join(whole, key, "left").withColumn("values", F.when(F.col("__n") == F.col("__m"), F.transform("__l", lambda x: x["__v"]))).drop("__n", "__m", "__l")


def route(rows: DataFrame, rules: DataFrame, key: str, conditions: list[str], default: str) -> DataFrame:
    """First rule, by its order, whose non-null conditions all equal the row's; else the default destination.

    rules: condition columns of the same names, order, destination. Rules are a small table of settings.
    """
    r = rules.select(*(F.col(c).alias(f"__{c}") for c in conditions), F.col("order").alias("__o"), F.col("destination").alias("__d"))
    fits = reduce(lambda a, b: a & b, [F.col(f"__{c}").isNull() | (F.col(f"__{c}") == F.col(c)) for c in conditions])
    best = rows.join(r, fits).groupBy(key).agg(F.min_by("__d", "__o").alias("destination"))
    return rows.join(best, key, "left").withColumn("destination", F.coalesce("destination", F.lit(default)))


def route_by_trust(writes: DataFrame, trust: DataFrame, staged: DataFrame, bundle: str, path: str, company: str, digest: str, wanted: str, trusted: int = 2) -> DataFrame:
    """Writes with level and destination. A bundle is trusted as its least trusted company is (a company without a level not at
    all): from `trusted` on its writes go to a branch, others are staged. Where publishing is wanted a trusted write is
    published if the bytes that were staged at its path are the same."""
    known = writes.join(trust.select(company, F.col("level").alias("__level")), company, "left")
    least = known.groupBy(bundle).agg(F.min(F.coalesce("__level", F.lit(0))).alias("level"))
    there = staged.groupBy(path).agg(F.max_by(digest, "at").alias("__have"))
    rows = writes.join(least, bundle).join(there, path, "left")
    same = F.coalesce(F.col("__have") == F.col(digest), F.lit(False))
    to = F.when(F.col("level") < trusted, "staged").when(F.col(wanted) & same, "published").otherwise("branch")
    return rows.withColumn("destination", to).drop("__have")


def against_existing(planned: DataFrame, existing: DataFrame, key: str, digest: str, body: str, closed: Column) -> DataFrame:
    """What each planned write does to what is there: new, same, header (the body stays), replaced, or refused where its deadline has
    passed (closed holds) and more than the header differs."""
    there = existing.select(key, F.col(digest).alias("__d"), F.col(body).alias("__b"))
    met = planned.join(there, key, "left")
    does = F.when(F.col("__d").isNull(), "new").when(F.col("__d") == F.col(digest), "same").when(F.col("__b") == F.col(body), "header").when(closed, "refused").otherwise("replaced")
    return met.withColumn("does", does).drop("__d", "__b")
