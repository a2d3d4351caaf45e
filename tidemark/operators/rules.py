"""Written tests on readings: comparisons over adjacent periods, changes, bands, and three-valued combinations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sizes import small
from .islands import consecutive
from .merge import keep_first

#: Outcomes from best to worst for a reader.
OUTCOMES = ["pass", "warn", "fail", "undetermined", "not_due"]


def holds(op: Column, value: Column, low: Column, high: Column, before: Column) -> Column:
    """Whether a rule's condition holds; null where a number it needs is missing. increase and decrease compare with the
    period right before, outside with a pair of thresholds, event with zero."""
    return (
        F.when(op == "<", value < low).when(op == "<=", value <= low).when(op == ">", value > low).when(op == ">=", value >= low)
        .when(op == "outside", ~value.between(low, high)).when(op == "increase", value > before).when(op == "decrease", value < before).when(op == "event", value > 0)
    )


def latest_readings(readings: DataFrame, key: list[str], group: str, order: list) -> DataFrame:
    """Of readings of one key the last group's, and within it the last by order."""
    return keep_first(readings, key, [F.desc(group), *(F.desc(o) for o in order)])


def triggers(readings: DataFrame, rules: DataFrame, entity: list[str], period: str, value: str) -> DataFrame:
    """Every rule on every reading of its metric: rule columns, streak and triggered. Rules are a small dimension and are
    joined by metric; `n` of them adjacent periods must hold. A gap, or a missing number, breaks a streak."""
    w = Window.partitionBy(*entity, "metric").orderBy(period)
    before = F.when(F.lag(period).over(w) == F.col(period) - 1, F.lag(value).over(w))
    rows = readings.withColumn("__before", before).join(rules, "metric")
    rows = rows.withColumn("__holds", holds(F.col("op"), F.col(value), F.col("low"), F.col("high"), F.col("__before")))
    runs = consecutive(rows, [*entity, "rule_id"], period, F.col("__holds"), 1).drop("triggered")
    return runs.withColumn("triggered", F.when(F.col("__holds").isNotNull(), F.col("streak") >= F.col("n"))).drop("__before")


def evaluate(readings: DataFrame, rules: DataFrame, entities: DataFrame, entity: list[str], period: str, value: str, at: int) -> DataFrame:
    """One outcome for each entity and test at a period. rules: test_id, rule_id, metric, op, low, high, n, severity (fail
    or warn), since, until (periods, until excluded). A test fails if a fail rule triggers, warns if a warn rule does; with
    no reading at that period for a fail rule it is undetermined; outside its validity it is not_due."""
    fired = triggers(readings, rules, entity, period, value).where(F.col(period) == at).select(*entity, "rule_id", "triggered", "streak")
    asked = entities.select(*entity).distinct().join(small(rules))  # every entity has every rule
    seen = asked.join(fired, [*entity, "rule_id"], "left")
    fails, warns = F.col("severity") == "fail", F.col("severity") == "warn"
    due = F.bool_or((F.lit(at) >= F.coalesce("since", F.lit(at))) & (F.lit(at) < F.coalesce("until", F.lit(at + 1))))
    any_of = lambda cond: F.coalesce(F.bool_or(cond & F.col("triggered")), F.lit(False))
    blank = F.coalesce(F.bool_or(fails & F.col("triggered").isNull()), F.lit(False))
    outcome = F.when(~due, "not_due").when(any_of(fails), "fail").when(blank, "undetermined").when(any_of(warns), "warn").otherwise("pass")
    return seen.groupBy(*entity, "test_id").agg(outcome.alias("outcome"), F.coalesce(F.max(F.when(fails, F.col("streak"))), F.lit(0)).cast("long").alias("streak"))


def any_of(conditions: list[Column]) -> Column:
    """Three-valued OR: true beats unknown beats false."""
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def all_of(conditions: list[Column]) -> Column:
    """Three-valued AND: false beats unknown beats true."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def trailing(df: DataFrame, entity: list[str], period: str, value: str, periods: int, fn, out: str) -> DataFrame:
    """fn (F.sum, F.avg, F.max, F.min) over a reading and those of the periods - 1 adjacent ones before; null if any is missing."""
    w = Window.partitionBy(*entity).orderBy(period).rangeBetween(-(periods - 1), 0)
    return df.withColumn(out, F.when(F.count(value).over(w) == periods, fn(value).over(w)))


def year_over_year(df: DataFrame, entity: list[str], period: str, value: str, back: int, out: str) -> DataFrame:
    """Growth in percent against exactly `back` periods earlier; null without that reading or where it is zero."""
    w = Window.partitionBy(*entity).orderBy(period).rangeBetween(-back, -back)
    old = F.max(value).over(w)
    return df.withColumn(out, F.when(old != 0, 100 * (F.col(value) - old) / F.abs(old)))


def stale(reviews: DataFrame, key: list[str], reviewed: str, at: int, most: int) -> DataFrame:
    """Keys whose last review lies more than `most` quarters before quarter index `at`; never reviewed is stale."""
    last = reviews.groupBy(*key).agg(F.max(reviewed).alias("last"))
    return last.withColumn("stale", F.col("last").isNull() | (F.lit(at) - F.col("last") > most))
