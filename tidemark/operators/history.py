"""Versions of paths over time: a landed log of changes as intervals, and what stood there at a moment.

log: path, at, commit, content (null where the path was removed) and any order among changes of one moment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import asof_join


def versions(log: DataFrame, path: list[str], at: str, order: list[str], content: str) -> DataFrame:
    """path, since, until, commit columns of order, content and content_hash: an interval for each change of content. Changes of one
    moment count as the last of them; a change to what stands there already begins none; until is null for what still stands,
    and a removed path has no interval."""
    last = log.groupBy(*path, at).agg(F.max_by(F.struct(*order, content), F.struct(*order)).alias("__v"))
    w = Window.partitionBy(*path).orderBy(at)
    text = F.col(f"__v.{content}")
    changed = last.withColumn("__h", F.sha2(text, 256)).withColumn("__before", F.lag("__h").over(w)).withColumn("__first", F.row_number().over(w) == 1)
    changed = changed.where(F.col("__first") | ~F.col("__h").eqNullSafe(F.col("__before")))
    spans = changed.withColumn("until", F.lead(at).over(w)).where("__h is not null")
    return spans.select(*path, F.col(at).alias("since"), "until", *(F.col(f"__v.{c}").alias(c) for c in dict.fromkeys([*order, content])), F.col("__h").alias("content_hash"))


def first_added(log: DataFrame, path: list[str], at: str, content: str) -> DataFrame:
    """When each path was there first, and all paths ever present: removals don't count."""
    return log.where(F.col(content).isNotNull()).groupBy(*path).agg(F.min(at).alias("first_added"))


def before(asked: DataFrame, log: DataFrame, path: list[str], moment: str, at: str, order: list[str], content: str, bucket=None) -> DataFrame:
    """asked with the content, and the commit columns, that stood at its path right before its moment; null if nothing did. With a bucket of
    time (see asof_join) a path with very many changes is more than one task."""
    last = log.groupBy(*path, at).agg(F.max_by(F.struct(*order, content), F.struct(*order)).alias("__v")).select(*path, F.col(at).alias("__at"), *(F.col(f"__v.{c}").alias(c) for c in dict.fromkeys([*order, content])))
    return asof_join(asked, last, path, moment, "__at", list(dict.fromkeys([*order, content])), bucket, strict=True)


def first_where(log: DataFrame, path: list[str], at: str, order: list[str], wanted: Column) -> DataFrame:
    """The first change of each path that meets a predicate: path, at and the columns of order; paths without one are left out."""
    return log.where(wanted).groupBy(*path).agg(F.min(F.struct(at, *order)).alias("__v")).select(*path, "__v.*")
