"""Choosing rows: what is due, what was latest, which documents a request means, and checks of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import asof_join

from .merge import keep_first


def due(tests: DataFrame, at: Column, since: str, until: str, readable: str | None = None, day: Column | None = None) -> DataFrame:
    """Tests in force at a period (until excluded, nulls open) and, with `readable`, readable on a day."""
    inside = (at >= F.coalesce(F.col(since), at)) & (F.col(until).isNull() | (at < F.col(until)))
    return tests.where(inside if readable is None else inside & (F.col(readable).isNull() | (F.col(readable) <= day)))


def fan_out(definitions: DataFrame, key: str, holders: str) -> DataFrame:
    """A definition for each of its holders, id[holder]; one without holders stays as it is. First listed wins by id."""
    each = definitions.withColumn("holder", F.explode_outer(holders))
    return each.withColumn(key, F.when(F.col("holder").isNotNull(), F.concat(F.col(key), F.lit("["), F.col("holder").cast("string"), F.lit("]"))).otherwise(F.col(key)))


def fallback(df: DataFrame, by: list[str], preferred: Column, order: list) -> DataFrame:
    """Of each key the first of the preferred rows by order, else the first of the others."""
    return keep_first(df.withColumn("__p", F.when(preferred, 0).otherwise(1)), by, ["__p", *order]).drop("__p")


def only_without(candidates: DataFrame, blockers: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first candidate of each key, for keys that no blocker has: a prospectus counts only without an annual report."""
    return keep_first(candidates.join(blockers.select(*by).distinct(), by, "left_anti"), by, order)


def seeded_shuffle(df: DataFrame, by: list[str], place: str, fixed: Column, key: str, seed: str) -> DataFrame:
    """Rows of a key put into the order of hash(seed, key), but for fixed rows, which keep their places."""
    rows = df.withColumn("__f", fixed).withColumn("__h", F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256))
    free, kept = rows.where("not __f"), rows.where("__f")
    slots = free.select(*by, place, F.row_number().over(Window.partitionBy(*by).orderBy(place)).alias("__n"))
    dealt = free.drop(place).withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy("__h")))
    return dealt.join(slots, [*by, "__n"]).select(*df.columns).unionByName(kept.select(*df.columns))


def after_latest(df: DataFrame, by: list[str], order: str, mark: Column) -> DataFrame:
    """Rows of each key after its last marked one; all rows of a key without any."""
    last = df.where(mark).groupBy(*by).agg(F.max(order).alias("__last"))
    return df.join(last, by, "left").where(F.col("__last").isNull() | (F.col(order) > F.col("__last"))).drop("__last")


def select_by_request(requests: DataFrame, filings: DataFrame, entity: str, filed: str, order: list, items: str | None = None) -> DataFrame:
    """Each request (request_id, entity, form, since, until, latest: how many) with the filings it means, newest first.

    Null bounds are open, a null `latest` means all. With items, a column of arrays on both sides, a request that names some
    means only filings with one of them. The join is on entity and form; the rest filters its result.
    """
    if items:
        wanted = requests.withColumnRenamed(items, "__items")
        met = wanted.join(filings, [entity, "form"]).where(F.coalesce(F.size("__items") == 0, F.lit(True)) | F.arrays_overlap("__items", items)).drop("__items")
    else:
        met = requests.join(filings, [entity, "form"])
    met = met.where(f"(since is null or {filed} >= since) and (until is null or {filed} <= until)")
    ranked = met.withColumn("nth", F.row_number().over(Window.partitionBy("request_id").orderBy(*order)))
    return ranked.where("latest is null or nth <= latest")


def in_force(asked: DataFrame, filings: DataFrame, entity: str, as_of: str, filed: str, kinds: dict[str, list[str]], values: list[str], bucket=None) -> DataFrame:
    """For each row of asked, and each kind of standing document (its forms), the entity's last one filed by that day: kind and values,
    null where there is none. kinds: for example annual: 10-K, 20-F and 40-F, and proxy: DEF 14A."""
    kind = F.create_map(*(F.lit(x) for name, forms in kinds.items() for form in forms for x in (form, name)))
    standing = filings.withColumn("kind", F.element_at(kind, F.col("form"))).where("kind is not null")
    rows = asked.withColumn("kind", F.explode(F.array(*map(F.lit, kinds))))
    return asof_join(rows, standing, [entity, "kind"], as_of, filed, values, bucket)


def upcoming(issuers: DataFrame, quarters: DataFrame, released: DataFrame, key: str, day: str, start: Column, end: Column) -> DataFrame:
    """Expected releases of issuers in a window, quarters already released left out. quarters: key, period and the expected day."""
    return issuers.join(quarters, key).where(F.col(day).between(start, end)).join(released.select(key, "period").distinct(), [key, "period"], "left_anti")


def override(own: DataFrame, others: DataFrame, key: list[str], value: str) -> DataFrame:
    """Rows of `own` with the value of the same key in `others` above their own; overridden says which."""
    o = others.groupBy(*key).agg(F.max(value).alias("__o"))
    return own.join(o, key, "left").withColumn("overridden", F.col("__o").isNotNull()).withColumn(value, F.coalesce("__o", value)).drop("__o")


def remapped(df: DataFrame, mapping: DataFrame, old: str, new: str, key: list[str], refs: str) -> DataFrame:
    """df with the array column refs rewritten by mapping (old to new); references nobody maps stay, in their order."""
    each = df.select(*key, F.posexplode(refs).alias("__i", old)).join(mapping.select(old, new), old, "left")
    back = each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__i", F.coalesce(new, old).alias("r")))), lambda x: x["r"]).alias("__refs"))
    return df.join(back, key, "left").withColumn(refs, F.coalesce("__refs", F.array_compact(F.array(F.lit(None).cast(mapping.schema[new].dataType))))).drop("__refs")


def structure_errors(df: DataFrame, key: list[str], required: list[str], allowed: dict[str, list[str]], one_of: list[list[str]]) -> DataFrame:
    """A row for each breach of a table's shape: required columns that are null, words outside the allowed ones, and groups of
    columns of which not exactly one is given."""
    checks = [F.when(F.col(c).isNull(), f"{c} is missing") for c in required]
    checks += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(words), F.concat(F.lit(f"{c} is "), F.col(c).cast("string"))) for c, words in allowed.items()]
    for group in one_of:
        given = sum((F.col(c).isNotNull().cast("int") for c in group), F.lit(0))
        checks.append(F.when(given != 1, F.concat(F.lit(f"of {', '.join(group)}: "), given.cast("string"))))
    return df.select(*key, F.explode(F.array_compact(F.array(*checks))).alias("error"))


def verify_files(manifest: DataFrame, files: DataFrame, key: str, digest: str) -> DataFrame:
    """Files against a manifest: missing, unlisted or changed; files as listed give no row."""
    both = manifest.select(key, F.col(digest).alias("__want")).join(files.select(key, F.col(digest).alias("__have"), F.lit(True).alias("__there")), key, "full")
    problem = F.when(F.col("__there").isNull(), "missing").when(F.col("__want").isNull(), "unlisted").when(F.col("__want") != F.col("__have"), "changed")
    return both.select(key, problem.alias("problem")).where("problem is not null")


def new_errors(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Errors that weren't there before, as a set: an error known once is known however often it comes back."""
    return after.join(before.select(*key).distinct(), key, "left_anti")


def natural_order(c: Column) -> list[Column]:
    """Order columns for ids such as F2 and F10: by prefix, then by number."""
    return [F.regexp_extract(c, "^([^0-9]*)", 1), F.regexp_extract(c, "([0-9]+)$", 1).try_cast("long"), c]


def top(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value: a report."""
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(n)


def distinct_weight(df: DataFrame, by: list[str], key: str, sizes: DataFrame, size: str) -> DataFrame:
    """Sum of the sizes of each group's distinct keys."""
    return df.select(*by, key).distinct().join(sizes.select(key, size), key).groupBy(*by).agg(F.sum(size).alias(size))


def walk(documents: DataFrame, key: str, data: str) -> DataFrame:
    """Leaves of nested VARIANT documents, however deep: key, path and value as text; a level of lateral explodes at a time,
    until no document has a further one."""
    tvf = documents.sparkSession.tvf
    at = documents.select(F.col(key).alias("__key"), F.lit("$").alias("path"), F.col(data).alias("v")).where("v is not null")
    nested = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
    step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
    leaves = []
    while True:
        leaves.append(at.where(~nested).select("__key", "path", F.col("v").cast("string").alias("value")))
        if at.where(nested).isEmpty():
            break
        at = at.where(nested).lateralJoin(tvf.variant_explode(F.col("v").outer())).select("__key", F.concat("path", step).alias("path"), F.col("value").alias("v"))
    return reduce(DataFrame.unionByName, leaves).withColumnRenamed("__key", key)
