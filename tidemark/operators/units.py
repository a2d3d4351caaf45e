"""Units of a text that are checked one by one: sentences and table rows of Markdown, values of nested documents, with the
source tags that hold for each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import _col, figures, sentences
from ..functions.values import row_cells

#: Fixed value: how a source tag is written.
TAG = r"\[src:([A-Za-z0-9][A-Za-z0-9._-]*(?:#[A-Za-z0-9._–-]+)?)\]"


def tags_of(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TAG), F.lit(1))


def markdown_units(documents: DataFrame, key: list[str], text: str) -> DataFrame:
    """key, line (from 1), place, kind, unit, own, context, cells, header and table of the units of Markdown documents.

    A sentence's context is the tags of its line, then those of the last line before it that is no list item, so a list
    has the tags of the line that leads into it. A table row's context is the tags of its Source cell, or of the whole row
    without one; then those of the line above the table and of the line below it, at most one blank line away. Header and
    separator rows are no units, nor is front matter.
    """
    body = F.regexp_replace(F.col(text), r"\A---[ \t]*\n(?:[^\n]*\n)*?---[ \t]*(?=\n|\z)", "")
    shift = F.size(F.split(F.col(text), "\n")) - F.size(F.split(body, "\n"))
    lines = documents.select(*key, shift.alias("__s"), F.posexplode(F.split(body, "\n")).alias("__i", "x")).select(*key, (F.col("__i") + 1 + F.col("__s")).alias("line"), "x")
    w = Window.partitionBy(*key).orderBy("line")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    none = F.array().cast("array<string>")
    lines = lines.withColumn("__blank", F.trim("x") == "").withColumn("__row", F.ltrim("x").startswith("|")).withColumn("own", tags_of("x"))
    lines = lines.withColumn("__opens", (F.col("__row") & ~F.coalesce(F.lag("__row").over(w), F.lit(False))).cast("int")).withColumn("table", F.sum("__opens").over(so_far))
    item = F.col("x").rlike(r"^\s*(?:[-*]|[0-9]+[.])\s")
    lines = lines.withColumn("__lead", F.last(F.when(~item & ~F.col("__blank") & ~F.col("__row"), F.col("own")), ignorenulls=True).over(so_far))
    plain = lines.where("not __blank and not __row").select(*key, "line", F.posexplode(sentences("x")).alias("place", "unit"), "own", "__lead")
    said = plain.select(*key, "line", "place", F.lit("sentence").alias("kind"), "unit", tags_of("unit").alias("own"), F.array_distinct(F.concat("own", F.coalesce("__lead", none))).alias("context"), none.alias("cells"), none.alias("header"), F.lit(None).cast("long").alias("table"))

    # The line above a table and the one below it: the nearest that isn't blank, at most two away.
    near = lambda step: F.coalesce(*(F.when((F.lag("line", k * step).over(w).isNotNull()) & ~F.lag("__blank", k * step).over(w) & (~F.lag("__blank", step).over(w) if k == 1 else F.lag("__blank", step).over(w)), F.lag("own", k * step).over(w)) for k in (1, 2)), none)
    edges = lines.withColumn("__above", near(1)).withColumn("__below", near(-1)).where("__row")
    rows = edges.withColumn("__cells", row_cells("x")).withColumn("__n", F.row_number().over(Window.partitionBy(*key, "table").orderBy("line")))
    t = Window.partitionBy(*key, "table").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("header", F.first("__cells").over(t)).withColumn("__caption", F.first("__above").over(t)).withColumn("__foot", F.last("__below").over(t)).where("__n > 2")
    source = F.array_position(F.transform("header", lambda h: F.lower(h).rlike("^sources?$")), F.lit(True)).cast("int")
    row_tags = F.when(source > 0, F.coalesce(tags_of(F.get("__cells", source - 1)), none)).otherwise(F.col("own"))
    table = rows.select(*key, "line", F.lit(0).alias("place"), F.lit("row").alias("kind"), F.col("x").alias("unit"), none.alias("own"), F.concat(row_tags, "__caption", "__foot").alias("context"), F.col("__cells").alias("cells"), "header", (F.col("table") - 1).alias("table"))
    return said.unionByName(table)


def nested_units(documents: DataFrame, key: str, data: str, skip: list[str], sources: list[str] = ["source", "settlement_source"]) -> DataFrame:  # noqa: B006
    """key, path, value (text) and tags of the leaves of nested VARIANT documents, however deep. A leaf's tags are the texts
    under `sources` of every mapping it sits in, outermost first; what stands under those and `skip` keys is left out."""
    tvf = documents.sparkSession.tvf
    none = F.array().cast("array<string>")
    at = documents.select(F.col(key).alias("__key"), F.lit("").alias("path"), F.col(data).alias("v"), none.alias("tags")).where("v is not null")
    kind = F.schema_of_variant("v")
    leaves = []
    while True:
        nested = kind.rlike("^(OBJECT|ARRAY)")
        leaves.append(at.where(~nested).select("__key", "path", F.col("v").cast("string").alias("value"), "tags"))
        inner = at.where(nested)
        if inner.isEmpty():  # as many rounds as the deepest document has levels
            break
        own = F.array_compact(F.array(*(F.when(kind.startswith("OBJECT"), F.try_variant_get("v", f"$.{s}", "string")) for s in sources)))
        inner = inner.withColumn("tags", F.concat("tags", own))
        opened = inner.lateralJoin(tvf.variant_explode(F.col("v").outer())).where(F.col("key").isNull() | ~F.col("key").isin(*sources, *skip))
        step = F.when(F.col("key").isNotNull(), F.when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))).otherwise(F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        at = opened.select("__key", step.alias("path"), F.col("value").alias("v"), "tags").where("v is not null")
    return reduce(DataFrame.unionByName, leaves).withColumnRenamed("__key", key)


def untagged(units: DataFrame, key: list[str]) -> DataFrame:
    """Sentences that state a quantity and have no source tag, each once a document."""
    return units.where((F.col("kind") == "sentence") & (F.size("own") == 0) & (F.size(figures("unit")) > 0)).groupBy(*key, "unit").agg(F.min("line").alias("line"))


def unreadable(units: DataFrame, documents: DataFrame, tag: str, text: str, reason: str) -> DataFrame:
    """Tags that units cite whose document has no text, each once, with why."""
    cited = units.select(F.explode(F.array_distinct(F.concat("own", "context"))).alias(tag)).distinct()
    met = cited.join(documents.select(tag, text, reason, F.lit(True).alias("__there")), tag, "left").where(f"{text} is null")
    return met.select(tag, F.when(F.col("__there"), F.col(reason)).otherwise("not registered").alias("reason"))


def cjk_lines(documents: DataFrame, key: list[str], text: str) -> DataFrame:
    """Numbers (from 1) of the lines that hold Chinese, Japanese or Korean characters."""
    lines = documents.select(*key, F.posexplode(F.split(text, "\n")).alias("__i", "__x"))
    return lines.where(F.col("__x").rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]")).select(*key, (F.col("__i") + 1).alias("line"))
