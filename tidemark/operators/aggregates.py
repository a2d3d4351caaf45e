"""Scores, roll-ups, streaks and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def calibration(df: DataFrame, probability: str, outcome: str, groups: list[str]) -> DataFrame:
    """Brier score, mean probability, observed frequency and count: overall and by each group column, in one pass.

    Rows without a numeric probability or outcome don't count. Rounded to 4 places, half to even.
    """
    rows = df.where(F.col(probability).isNotNull() & F.col(outcome).isNotNull())
    sets = ", ".join(["()", *(f"({g})" for g in groups)])
    names = ", ".join(groups)
    scope = "case " + " ".join(f"when grouping({g}) = 0 then '{g}'" for g in groups) + " else 'all' end"
    value = f"coalesce({', '.join(f'cast({g} as string)' for g in groups)})"
    return rows.sparkSession.sql(
        f"""SELECT {scope} AS scope, {value} AS value, count(*) AS n,
            bround(avg(power({probability} - {outcome}, 2)), 4) AS brier, bround(avg({probability}), 4) AS mean_probability, bround(avg({outcome}), 4) AS observed
            FROM {{rows}} GROUP BY GROUPING SETS ({sets})""".replace("{names}", names),
        rows=rows,
    )


def budget_stage(df: DataFrame, by: list[str], month: Column, cost: str, budget: float, ladder: list[tuple[float, str]]) -> DataFrame:
    """Spend of each month against a budget: spent, fraction and stage, the last of the ladder's steps that is reached."""
    spent = df.groupBy(*by, month.alias("month")).agg(F.round(F.sum(cost), 4).alias("spent"))
    fraction = F.round(F.col("spent") / budget, 4)
    stage = F.lit("normal")
    for step, name in sorted(ladder):
        stage = F.when(fraction >= step, name).otherwise(stage)
    return spent.withColumn("fraction", fraction).withColumn("stage", stage)


def token_cost(usage: DataFrame, prices: DataFrame, key: str, component: str, tokens: str, price: str) -> DataFrame:
    """Cost of each record: tokens by component times its price a million, each part to 6 places, then summed."""
    part = F.bround(F.col(tokens) * F.col(price) / 1_000_000, 6)
    return usage.join(prices, component).groupBy(key).agg(F.round(F.sum(part), 6).alias("cost"))


def trailing_streak(df: DataFrame, by: list[str], order: list[str], failed: Column, least: int = 2) -> DataFrame:
    """Length of the run of failures that ends a key's history, where it has `least` or more, without a window over the key.

    The last success is an aggregate; failures after it are counted.
    """
    place = F.struct(*order)
    rows = df.withColumn("__p", place).withColumn("__f", failed)
    last = rows.where("not __f").groupBy(*by).agg(F.max("__p").alias("__ok"))
    after = rows.where("__f").join(last, by, "left").where("__ok is null or __p > __ok")
    return after.groupBy(*by).agg(F.count("*").alias("streak")).where(F.col("streak") >= least)


def document_frequency(df: DataFrame, key: list[str], tokens: Column, least: int = 1) -> DataFrame:
    """Rows that hold each token, counted once a row."""
    return df.select(*key, F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def declines(df: DataFrame, by: list[str], year: str, value: str) -> DataFrame:
    """Years whose value fell against the year right before; a gap compares with nothing."""
    w = Window.partitionBy(*by).orderBy(year)
    fell = (F.lag(year).over(w) == F.col(year) - 1) & (F.col(value) < F.lag(value).over(w))
    return df.withColumn("__fell", fell).where("__fell").drop("__fell")


def concept_series(rows: DataFrame, by: list[str], concept: str, end: str, filed: str, value: str, preference: str, years: int = 10, gap: float = 0.02) -> DataFrame:
    """One series for each line item: for a concept and period end the latest filed row; of concepts the one with the latest
    end, then most ends, then the smallest preference; its last `years` ends. differs: another concept's value for that end
    is off by more than `gap`."""
    pick = Window.partitionBy(*by, concept, end).orderBy(F.desc(filed), F.desc(value))
    latest = rows.withColumn("__n", F.row_number().over(pick)).where("__n = 1").drop("__n")
    best = latest.groupBy(*by, concept).agg(F.max(F.struct(F.col(end).alias("e"))).alias("e"), F.count("*").alias("c"), F.min(preference).alias("p"))
    chosen = best.groupBy(*by).agg(F.max_by(concept, F.struct("e", "c", -F.col("p"))).alias("__chosen"))
    own = latest.join(chosen, by).where(F.col(concept) == F.col("__chosen")).drop("__chosen")
    ranked = own.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(end)))).where(F.col("__k") <= years).drop("__k")
    others = latest.select(*by, end, F.col(concept).alias("__c"), F.col(value).alias("__v"))
    off = ranked.join(others, [*by, end], "left").where(f"__c is null or __c <> {concept} or __c = {concept}")
    differs = F.bool_or((F.col("__c") != F.col(concept)) & (F.abs(F.col("__v") - F.col(value)) > gap * F.abs(F.col(value))))
    return off.groupBy(*by, concept, end, value).agg(F.coalesce(differs, F.lit(False)).alias("differs"))


def rollup_counts(df: DataFrame, group: str, outcome: str, outcomes: list[str]) -> DataFrame:
    """Counts of each outcome by group and for all groups together; outcomes nobody has count 0."""
    counted = [F.count_if(F.col(outcome) == o).alias(f"n_{o}") for o in outcomes]
    return df.rollup(group).agg(F.grouping(group).alias("__g"), F.count("*").alias("n"), *counted).withColumn(group, F.when(F.col("__g") == 1, "all").otherwise(F.col(group))).drop("__g")


def worst_status(df: DataFrame, by: list[str], status: str, order: list[str]) -> DataFrame:
    """The worst status of each key. order: from best to worst; unknown words are worst of all."""
    rank = F.lit(len(order))
    for i, s in reversed(list(enumerate(order))):
        rank = F.when(F.col(status) == s, i).otherwise(rank)
    return df.groupBy(*by).agg(F.max(rank).alias("__r"), F.count("*").alias("n")).withColumn("worst", F.coalesce(F.element_at(F.array(*map(F.lit, order)), F.least(F.col("__r") + 1, F.lit(len(order)))), F.lit(order[-1]))).drop("__r")


def share_of_total(df: DataFrame, by: list[str], value: str, marked: Column) -> DataFrame:
    """Total, the marked part of it and their ratio to 4 places; null where the total is zero."""
    agg = df.groupBy(*by).agg(F.round(F.sum(value), 2).alias("total"), F.round(F.sum(F.when(marked, F.col(value)).otherwise(0.0)), 2).alias("marked"))
    return agg.withColumn("coverage", F.when(F.col("total") != 0, F.bround(F.col("marked") / F.col("total"), 4)))


def top_then_more(df: DataFrame, by: list[str], message: str, order: list[str], n: int) -> DataFrame:
    """The first n messages of each key in order, and how many more there are."""
    w = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn("__k", F.row_number().over(w))
    return ranked.groupBy(*by).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("__k") <= n, F.struct("__k", message)))), lambda x: x[message]), "; ").alias("first"),
        F.greatest(F.count("*") - n, F.lit(0)).alias("more"),
    )


def map_totals(df: DataFrame, by: list[str], usage: str) -> DataFrame:
    """Maps of numbers added up key by key."""
    return df.select(*by, F.explode(usage).alias("component", "amount")).groupBy(*by, "component").agg(F.sum("amount").alias("amount"))


def monthly_outcomes(df: DataFrame, by: list[str], at: str, outcome: str) -> DataFrame:
    """month, n and outcomes (a map of each outcome to its count) of each key and calendar month; rows without a time are left out."""
    each = df.where(F.col(at).isNotNull()).groupBy(*by, F.date_format(at, "yyyy-MM").alias("month"), outcome).agg(F.count("*").alias("__n"))
    listed = F.array_sort(F.collect_list(F.when(F.col(outcome).isNotNull(), F.struct(outcome, "__n"))))
    return each.groupBy(*by, "month").agg(F.sum("__n").alias("n"), F.map_from_entries(listed).alias("outcomes"))
