"""Gaps and islands: merged windows, streaks, sections and numbered runs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_spans(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Overlapping or touching spans of a key joined: start, end and the number of spans in each."""
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    island = df.withColumn("__o", opened).withColumn("__i", F.sum("__o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*by, "__i").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("__i")


def hit_windows(lines: DataFrame, doc: list[str], line: str, text: str, patterns: list[str], around: int = 12, hits: int = 6) -> DataFrame:
    """Windows of `around` lines either side of the first hits of each pattern, merged, in document order."""
    found = lines.select(*doc, line, F.explode(F.filter(F.array(*(F.when(F.col(text).rlike(p), F.lit(i)) for i, p in enumerate(patterns))), lambda x: x.isNotNull())).alias("pattern"))
    first = found.withColumn("__k", F.row_number().over(Window.partitionBy(*doc, "pattern").orderBy(line))).where(F.col("__k") <= hits)
    spans = first.select(*doc, F.greatest(F.col(line) - around, F.lit(0)).alias("start"), (F.col(line) + around).alias("end"))
    return merge_spans(spans, doc, "start", "end")


def cut_at_budget(df: DataFrame, by: list[str], order: list[str], cost: str, budget: float) -> DataFrame:
    """Rows of a key in order as long as their costs together stay within the budget."""
    total = F.sum(cost).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__t", total).where(F.col("__t") <= budget).drop("__t")


def consecutive(df: DataFrame, by: list[str], period: str, holds: Column, n: int) -> DataFrame:
    """For each key and period whether `holds` is true in n adjacent periods ending there: streak and triggered.

    A missing period, or a null in `holds`, breaks the streak.
    """
    w = Window.partitionBy(*by).orderBy(period)
    true = df.withColumn("__h", F.coalesce(holds, F.lit(False)))
    broken = ~F.col("__h") | F.coalesce(F.lag(period).over(w) != F.col(period) - 1, F.lit(True)) | ~F.coalesce(F.lag("__h").over(w), F.lit(False))
    grouped = true.withColumn("__b", broken.cast("int")).withColumn("__g", F.sum("__b").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.when(F.col("__h"), F.row_number().over(Window.partitionBy(*by, "__g").orderBy(period))).otherwise(0).cast("long")
    return grouped.withColumn("streak", streak).withColumn("triggered", F.col("streak") >= n).drop("__h", "__b", "__g")


def sections(lines: DataFrame, doc: list[str], line: str, heading: Column) -> DataFrame:
    """Spans from a heading to the next different one; repeats of a heading go on; of several spans the longest counts.

    Lines before the first heading belong to none.
    """
    w = Window.partitionBy(*doc).orderBy(line)
    named = lines.withColumn("heading", F.last(heading, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("heading is not null")
    change = F.coalesce(F.col("heading") != F.lag("heading").over(w), F.lit(True)).cast("int")
    runs = named.withColumn("__c", change).withColumn("__r", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy(*doc, "heading", "__r").agg(F.min(line).alias("start"), F.max(line).alias("end"))
    best = Window.partitionBy(*doc, "heading").orderBy(F.desc(F.col("end") - F.col("start")), "start")
    return spans.withColumn("__k", F.row_number().over(best)).where("__k = 1").drop("__k", "__r")


def longest_numbered_run(numbers: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of (place, number) pairs, the longest chain with rising places and numbers that go up by one; the first of equals."""
    best: dict[int, tuple[int, int, int | None]] = {}  # number -> length, index of its last pair
    back: list[int | None] = []
    top = (0, -1)
    for i, (_, n) in enumerate(numbers):
        length, j = best.get(n - 1, (0, None, None))[:2]
        back.append(j)
        if length + 1 > best.get(n, (0, None, None))[0]:
            best[n] = (length + 1, i, None)
        if length + 1 > top[0]:
            top = (length + 1, i)
    chain, i = [], top[1] if numbers else None
    while i is not None and i >= 0:
        chain.append(numbers[i])
        i = back[i]
    return chain[::-1]


def page_numbers(texts: DataFrame, key: str, text: str, least_pages: int = 4) -> DataFrame:
    """Page footers of each document: lines that hold a bare number, in the longest run that goes up by one.

    A chain over an ordered list is a fold, so each document's numbers go through a Python function, batch by batch.
    """
    bare = F.expr(f"filter(transform(split({text}, '\\n'), (l, i) -> struct(i as line, try_cast(trim(l) as int) as number)), x -> x.number is not null)")
    listed = texts.select(key, bare.alias("numbers")).where("size(numbers) > 0")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, numbers in zip(batch[key], batch["numbers"]):
                chain = longest_numbered_run([(x["line"], x["number"]) for x in numbers])
                if len(chain) >= least_pages:
                    out += [(k, line, n) for line, n in chain]
            yield pd.DataFrame(out, columns=[key, "line", "page"])

    return listed.mapInPandas(run, f"{key} {dict(texts.dtypes)[key]}, line int, page int")
