"""Tagged facts: nested maps to rows, annual figures, and dependencies between derived facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged

ROW = "struct<val: double, start: string, end: string, filed: string, accn: string, form: string, fp: string>"
SCHEMA = f"map<string, map<string, struct<units: map<string, array<{ROW}>>>>>"


def flatten(companies: DataFrame, key: str, facts: str) -> DataFrame:
    """A row a fact from facts: map(taxonomy, map(concept, struct(units: map(unit, rows))))."""
    a = companies.select(key, F.explode(facts).alias("taxonomy", "c")).select(key, "taxonomy", F.explode("c").alias("concept", "u"))
    b = a.select(key, "taxonomy", "concept", F.explode("u.units").alias("unit", "r")).select(key, "taxonomy", "concept", "unit", F.explode("r").alias("r"))
    dated = [F.col(f"r.{c}").try_cast("date").alias(c if c != "end" else "period_end") for c in ("start", "end", "filed")]
    return b.select(key, "taxonomy", "concept", "unit", F.col("r.val").alias("val"), *dated, F.col("r.accn").alias("accession"), F.col("r.form").alias("form"), F.col("r.fp").alias("fp"))


def annual(facts: DataFrame, key: str, forms: tuple[str, ...] = ("10-K", "10-K/A", "20-F", "20-F/A", "40-F")) -> DataFrame:
    """Full-year rows: annual forms, no quarter, 330 to 400 days (or a moment); of taxonomies us-gaap, others only without it."""
    days = F.datediff("period_end", "start")
    rows = facts.where(F.col("form").isin(*forms) & (F.col("fp").isNull() | (F.col("fp") == "FY")) & (F.col("start").isNull() | days.between(330, 400)))
    main = rows.where("taxonomy = 'us-gaap'")
    return main.unionByName(rows.where("taxonomy <> 'us-gaap'").join(main.select(key, "concept").distinct(), [key, "concept"], "left_anti"))


def depth(facts: DataFrame, key: str, inputs: str) -> DataFrame:
    """Every fact with its depth over the facts that it is derived from (0: from none of them), a stored table a level.
    Facts in a cycle, or above one, have null: they have no order. Inputs that are no facts don't count."""
    ids = facts.select(key)
    edges = staged(facts.select(key, F.explode(inputs).alias("__on")).join(ids.select(F.col(key).alias("__on")), "__on", "left_semi").distinct(), "edges")
    known = staged(ids.join(edges, key, "left_anti").distinct().withColumn("depth", F.lit(0)), "depth")
    level = 0
    while True:
        level += 1
        waits = edges.join(known.select(F.col(key).alias("__on")), "__on", "left_anti").select(key).distinct()
        ready = edges.select(key).distinct().join(waits, key, "left_anti").join(known, key, "left_anti").withColumn("depth", F.lit(level))
        ready = staged(ready, "depth")
        if ready.isEmpty():
            return facts.join(known, key, "left")
        known = staged(known.unionByName(ready), "depth")


def context_of(slices: DataFrame, facts: DataFrame, key: str, number: str, inputs: str) -> DataFrame:
    """Facts of other slices that a slice's derived facts take as inputs: number, key."""
    here = slices.join(facts.select(key, inputs), key).select(number, F.explode(inputs).alias("__on")).distinct()
    there = slices.select(F.col(key).alias("__on"), F.col(number).alias("__n"))
    return here.join(there, "__on").where(F.col(number) != F.col("__n")).select(number, F.col("__on").alias(key)).distinct()
