"""Edits of documents as table operations: sections, front matter, fields, tags added, outputs of slices put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import _col, front_matter, headings
from .units import TAG


def sections_of(documents: DataFrame, key: list[str], text: str, level: int = 2) -> DataFrame:
    """key, place, title, number (of "9. Risks" or "9A Risks") and body of a document's sections."""
    parts = documents.select(*key, F.posexplode(headings(text, level)).alias("place", "__s")).select(*key, "place", "__s.title", "__s.body")
    return parts.withColumn("number", F.nullif(F.regexp_extract("title", r"^([0-9]+[A-Z]?)(?:[.): ]|$)", 1), F.lit("")))


def joined_sections(sections: DataFrame, key: list[str], level: int = 2) -> DataFrame:
    """Sections put together again: key and text."""
    one = F.when((F.col("place") == 0) & (F.col("title") == ""), F.col("body")).otherwise(F.concat(F.lit("#" * level + " "), "title", F.lit("\n"), "body"))
    listed = F.array_sort(F.collect_list(F.struct("place", one.alias("t"))))
    return sections.groupBy(*key).agg(F.array_join(F.transform(listed, lambda x: x["t"]), "\n").alias("text"))


def _named(sections: DataFrame, key: list[str]) -> DataFrame:
    """key, place and __name for each way to name a section: its number, its title, its title without the number."""
    title = F.lower("title")
    names = F.array_distinct(F.array_compact(F.array(F.lower("number"), title, F.regexp_replace(title, r"^[0-9]+[a-z]?[.):]? +", ""))))
    return sections.select(*key, "place", F.explode(names).alias("__name"))


def without_sections(sections: DataFrame, key: list[str], targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections without those that a target (key, name) names by number or title, and the targets that name none."""
    asked = targets.withColumn("__name", F.lower("name"))
    matched = _named(sections, key).join(asked, [*key, "__name"])
    left = sections.join(matched.select(*key, "place").distinct(), [*key, "place"], "left_anti")
    return left, targets.join(matched.select(*key, "name").distinct(), [*key, "name"], "left_anti")


def patch_sections(sections: DataFrame, key: list[str], changes: DataFrame, history: str = "Version history") -> tuple[DataFrame, DataFrame]:
    """Sections with new bodies, and changes that name no section. changes: key, section (a number or a title), body. A change
    of the history section is added at its end, and begins one where there is none; all others replace the whole body."""
    c = changes.groupBy(*key, "section").agg(F.max("body").alias("__new")).withColumn("__name", F.lower("section"))
    met = _named(sections, key).join(c, [*key, "__name"]).groupBy(*key, "place").agg(F.max("__new").alias("__new"), F.max("section").alias("__of"))
    added = F.concat(F.regexp_replace("body", "\n+$", ""), F.lit("\n\n"), "__new", F.lit("\n"))
    patched = sections.join(met.drop("__of"), [*key, "place"], "left").withColumn("body", F.when(F.col("__new").isNull(), F.col("body")).when(F.lower("title") == history.lower(), added).otherwise(F.concat(F.lit("\n"), "__new", F.lit("\n")))).drop("__new")
    lost = c.join(met.select(*key, F.col("__of").alias("section")).distinct(), [*key, "section"], "left_anti")
    last = sections.groupBy(*key).agg((F.max("place") + 1).alias("place"))
    begun = lost.where(F.col("__name") == history.lower()).join(last, key).select(*key, "place", F.lit(history).alias("title"), F.concat(F.lit("\n"), "__new", F.lit("\n")).alias("body"), F.lit(None).cast("string").alias("number"))
    return patched.select(*sections.columns).unionByName(begun.select(*sections.columns)), lost.where(F.col("__name") != history.lower()).select(*key, "section")


def newest_first(text: Column, heading: str, entry: Column) -> Column:
    """A text with an entry right under a heading; under a new heading at its end if it has none; unchanged if it holds it."""
    at = F.instr(text, F.lit(f"\n{heading}\n"))
    size = len(heading) + 2
    under = F.concat(F.substr(text, F.lit(1), at + size - 1), F.lit("\n"), entry, F.lit("\n\n"), F.regexp_replace(F.substr(text, at + size), "^\n+", ""))
    return F.when(text.contains(entry), text).when(at > 0, under).otherwise(F.concat(F.regexp_replace(text, "\n+$", ""), F.lit(f"\n\n{heading}\n\n"), entry, F.lit("\n")))


def set_front_matter(text: Column | str, name: str, value: Column) -> Column:
    """A text with one top-level line of its front matter set, or added at its end; null without front matter."""
    parts = front_matter(text)
    lines = F.split(parts["front"], "\n")
    line = F.concat(F.lit(f"{name}: "), value)
    fits = lambda x: x.rlike(f"^{name}:(?: |$)")
    new = F.when(F.exists(lines, fits), F.transform(lines, lambda x: F.when(fits(x), line).otherwise(x))).otherwise(F.array_append(lines, line))
    return F.when(parts["front"].isNotNull(), F.concat(F.lit("---\n"), F.array_join(new, "\n"), F.lit("\n---\n"), parts["body"]))


def overlay_fields(df: DataFrame, owned: dict[str, Column]) -> DataFrame:
    """Fields that the pipeline owns laid over what a document says; others stay."""
    return df.withColumns(owned)


def set_fields(documents: DataFrame, key: list[str], data: str, changes: DataFrame) -> DataFrame:
    """Map documents (map<string,string>) with fields set by path (key, path, value); the last change of a path holds, a null
    value takes the field away."""
    each = changes.groupBy(*key, "path").agg(F.last("value").alias("value")).groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("path", "value"))).alias("__new"))
    joined = documents.join(each, key, "left")
    merged = F.map_filter(F.map_concat(F.map_filter(data, lambda k, _: ~F.coalesce(F.map_contains_key("__new", k), F.lit(False))), F.coalesce("__new", F.create_map().cast("map<string,string>"))), lambda _, v: v.isNotNull())
    return joined.withColumn(data, merged).drop("__new")


def apply_tag_repairs(texts: DataFrame, key: list[str], text: str, repairs: DataFrame) -> DataFrame:
    """Texts with tags added, in the order of the repairs (key, n, find, replace), and problems. A repair counts only if what it
    finds stands in the text once, and its replacement without source tags is that too, so no substance changes."""
    bare = lambda c: F.regexp_replace(c, rf" ?{TAG}", "")
    listed = repairs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("n", "find", "replace"))).alias("__r"))
    start = F.struct(F.col(text).alias("t"), F.array().cast("array<string>").alias("problems"))

    def step(at, r):
        times = (F.length(at["t"]) - F.length(F.replace(at["t"], r["find"], F.lit("")))) / F.length(r["find"])
        tags = lambda c: F.size(F.regexp_extract_all(c, F.lit(TAG), F.lit(1)))
        only_tags = (bare(r["replace"]) == bare(r["find"])) & (tags(r["replace"]) > tags(r["find"])) & ~r["replace"].rlike(rf"{TAG}[A-Za-z0-9]")
        problem = F.when(times != 1, F.concat(F.lit("repair "), r["n"].cast("string"), F.lit(": stands "), times.cast("int").cast("string"), F.lit(" times"))).when(~only_tags, F.concat(F.lit("repair "), r["n"].cast("string"), F.lit(": changes more than tags")))
        return F.struct(F.when(problem.isNull(), F.replace(at["t"], r["find"], r["replace"])).otherwise(at["t"]).alias("t"), F.when(problem.isNull(), at["problems"]).otherwise(F.array_append(at["problems"], problem)).alias("problems"))

    joined = texts.join(listed, key, "left")
    done = F.aggregate(F.coalesce("__r", F.array().cast("array<struct<n:int,find:string,replace:string>>")), start, step)
    return joined.withColumn("__d", done).withColumn(text, F.col("__d.t")).withColumn("problems", F.col("__d.problems")).drop("__d", "__r")


def mark_effective(text: Column | str) -> Column:
    """The first "doc_status: proposed" line set to effective; null without one."""
    t = _col(text)
    parts = F.split(t, r"(?m)(?<=^doc_status: )proposed(?=[ \t]*$)", 2)
    return F.when(F.size(parts) > 1, F.concat_ws("effective", parts))


def merged_audits(rows: DataFrame, by: list[str], slice_: str, place: str, id_: str, prefix: str, text: str) -> DataFrame:
    """Findings of several slices numbered through: prefix1, prefix2 … by slice and place, with old_id; references to ids of the
    same slice inside their texts follow, all at once, so that none is renamed twice."""
    order = Window.partitionBy(*by).orderBy(slice_, place)
    new = rows.withColumn("__new", F.concat(F.lit(prefix), F.row_number().over(order).cast("string")))
    maps = new.groupBy(*by, slice_).agg(F.map_from_entries(F.collect_set(F.struct(F.col(id_), F.col("__new")))).alias("__map"))
    words = F.split("__t", r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?=[A-Za-z0-9])")
    moved = new.join(maps, [*by, slice_]).withColumn("__t", F.col(text))
    rewritten = F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at("__map", w), w)), "")
    return moved.withColumn(text, rewritten).withColumn("old_id", F.col(id_)).withColumn(id_, F.col("__new")).drop("__new", "__map", "__t")


def aligned(left: DataFrame, right: DataFrame, key: list[str], fields: list[str], votes: DataFrame, voted: str) -> DataFrame:
    """Fields of two documents of a key that differ: field, left, right, and which side takes the other's value. The left does,
    but for `voted`, where the right does if all votes (key, value) of the key are for the left's value."""
    unanimous = votes.groupBy(*key).agg(F.when(F.count_distinct("value") == 1, F.max("value")).alias("__v"))
    a = left.select(*key, F.explode(F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f).cast("string"))))).alias("field", "left"))
    b = right.select(*key, F.explode(F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f).cast("string"))))).alias("field", "right"))
    met = a.join(b, [*key, "field"]).where(F.col("left") != F.col("right")).join(unanimous, key, "left")
    takes = F.when((F.col("field") == voted) & F.coalesce(F.col("__v") == F.col("left"), F.lit(False)), "right").otherwise("left")
    return met.select(*key, "field", "left", "right", takes.alias("takes"))
