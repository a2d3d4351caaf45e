"""Quarterly holdings: positions by security, marked at closes, and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import asof_join

DOLLARS_SINCE = "2023-01-03"  # tables filed before state values in thousands


def positions(rows: DataFrame, by: list[str]) -> DataFrame:
    """Shares and value in dollars of each security and class: options and principal amounts left out, managers summed."""
    scale = F.when(F.col("filed") < F.lit(DOLLARS_SINCE).cast("date"), 1000).otherwise(1)
    plain = rows.where("coalesce(putCall, '') = '' and coalesce(sshPrnamtType, 'SH') = 'SH'")
    shares, value = F.col("sshPrnamt").try_cast("long"), F.col("value").try_cast("long") * scale
    read = plain.withColumn("__s", shares).withColumn("__v", value).where("__s is not null and __v is not null")
    return read.groupBy(*by, F.upper("cusip").alias("cusip"), "titleOfClass").agg(F.min("nameOfIssuer").alias("issuer"), F.sum("__s").alias("shares"), F.sum("__v").alias("value"))


def tickers(held: DataFrame, listed: DataFrame) -> DataFrame:
    """Positions with a ticker by CUSIP, else by CINS. listed: code, id_type, ticker."""
    by_cusip = listed.where("id_type = 'CUSIP'").select(F.col("code").alias("cusip"), F.col("ticker").alias("__a"))
    by_cins = listed.where("id_type = 'CINS'").select(F.col("code").alias("cusip"), F.col("ticker").alias("__b"))
    return held.join(by_cusip, "cusip", "left").join(by_cins, "cusip", "left").withColumn("ticker", F.replace(F.coalesce("__a", "__b"), F.lit("/"), F.lit("."))).drop("__a", "__b")


def mark(held: DataFrame, closes: DataFrame, symbol: str, report_on: str, mark_on: str, value: str) -> DataFrame:
    """Positions with the closes on or before two dates and the value moved by their ratio, to whole units; null without both."""
    c = closes.select(F.col("symbol").alias(symbol), F.col("date").alias("__on"), F.col("close").alias("close_report"))
    once = asof_join(held, c, [symbol], report_on, "__on", ["close_report"], bucket=lambda d: F.trunc(d, "year"))
    twice = asof_join(once, c.withColumnRenamed("close_report", "close_mark"), [symbol], mark_on, "__on", ["close_mark"], bucket=lambda d: F.trunc(d, "year"))
    return twice.withColumn("marked", F.bround(F.col(value) * F.col("close_mark") / F.col("close_report"), 0))


def totals(marked: DataFrame, by: list[str], value: str) -> DataFrame:
    """Total, the part that could be marked, its new value, the change, and coverage to four places."""
    done = F.col("marked").isNotNull()
    agg = marked.groupBy(*by).agg(F.round(F.sum(value), 2).alias("total"), F.round(F.sum(F.when(done, F.col(value))), 2).alias("marked_before"), F.sum("marked").alias("marked_value"))
    return agg.withColumn("change", F.round(F.col("marked_value") - F.col("marked_before"), 2)).withColumn("coverage", F.when(F.col("total") != 0, F.bround(F.coalesce("marked_before", F.lit(0.0)) / F.col("total"), 4)))


_V = "struct<value: string, footnoteId: array<struct<_id: string>>>"
_LINE = f"securityTitle: {_V}, conversionOrExercisePrice: {_V}, underlyingSecurity: struct<underlyingSecurityTitle: {_V}, underlyingSecurityShares: {_V}>, postTransactionAmounts: struct<sharesOwnedFollowingTransaction: {_V}>, ownershipNature: struct<directOrIndirectOwnership: {_V}, natureOfOwnership: {_V}>"
_DEALT = f"array<struct<{_LINE}, transactionDate: {_V}, transactionCoding: struct<transactionCode: string, footnoteId: array<struct<_id: string>>>, transactionAmounts: struct<transactionShares: {_V}, transactionAcquiredDisposedCode: {_V}>>>"
_HELD = f"array<struct<{_LINE}>>"
#: An ownership document: both tables, with transactions and holdings, and its footnotes.
OWNERSHIP = f"documentType string, issuer struct<issuerCik: string, issuerTradingSymbol: string>, reportingOwner array<struct<reportingOwnerId: struct<rptOwnerName: string>, reportingOwnerRelationship: struct<isDirector: string, isOfficer: string, isTenPercentOwner: string, officerTitle: string>>>, nonDerivativeTable struct<nonDerivativeTransaction: {_DEALT}, nonDerivativeHolding: {_HELD}>, derivativeTable struct<derivativeTransaction: {_DEALT}, derivativeHolding: {_HELD}>, footnotes struct<footnote: array<struct<_id: string, _VALUE: string>>>"
PRICE = r"[$]\s?[0-9]"


def ownership_lines(forms: DataFrame, key: list[str]) -> DataFrame:
    """A row for each group of alike transactions, and for each holding, of ownership documents (columns as in OWNERSHIP).

    key, owners, roles, ticker, derivative, kind (transaction or holding), security, day, code, direction, nature, fills, shares
    (null if any fill has none), owned_after (of the last), exercise_price, underlying and footnotes: the texts of the notes that
    the rows point to, by their ids, in order and once each; notes that name a price are left out, ids without a note too.
    """
    owner = F.col("reportingOwner")
    told = lambda flag, name: F.when(F.lower(flag).isin("1", "true"), F.lit(name))
    roles = F.array_sort(F.array_distinct(F.flatten(F.transform(owner, lambda o: F.array_compact(F.array(told(o["reportingOwnerRelationship"]["isDirector"], "director"), told(o["reportingOwnerRelationship"]["isOfficer"], "officer"), told(o["reportingOwnerRelationship"]["isTenPercentOwner"], "ten percent owner")))))))
    notes = F.coalesce(F.col("footnotes.footnote"), F.array().cast("array<struct<_id:string,_VALUE:string>>"))
    texts = F.map_from_entries(F.transform(F.filter(notes, lambda n: n["_id"].isNotNull() & ~F.coalesce(n["_VALUE"].rlike(PRICE), F.lit(False))), lambda n: F.struct(n["_id"], F.trim(n["_VALUE"]))))

    def value(x: Column, *path: str) -> Column:
        for name in path:
            x = x[name]
        return x["value"]

    def ids(*parts: Column) -> Column:
        return F.flatten(F.array_compact(F.array(*(F.transform(p["footnoteId"], lambda i: i["_id"]) for p in parts))))

    def line(x: Column, derivative: bool, dealt: bool) -> Column:
        coding, amounts = (x["transactionCoding"], x["transactionAmounts"]) if dealt else (None, None)
        nothing = F.lit(None).cast("string")
        pointed = [x["securityTitle"], x["conversionOrExercisePrice"], x["postTransactionAmounts"]["sharesOwnedFollowingTransaction"], x["ownershipNature"]["directOrIndirectOwnership"], x["ownershipNature"]["natureOfOwnership"]]
        pointed += [x["transactionDate"], coding, amounts["transactionShares"], amounts["transactionAcquiredDisposedCode"]] if dealt else []
        return F.struct(
            F.lit(derivative).alias("derivative"), F.lit("transaction" if dealt else "holding").alias("kind"), value(x, "securityTitle").alias("security"), (value(x, "transactionDate") if dealt else nothing).alias("day"),
            (coding["transactionCode"] if dealt else nothing).alias("code"), (value(amounts, "transactionAcquiredDisposedCode") if dealt else nothing).alias("direction"), value(x, "ownershipNature", "directOrIndirectOwnership").alias("nature"),
            (value(amounts, "transactionShares") if dealt else nothing).try_cast("double").alias("shares"), value(x, "postTransactionAmounts", "sharesOwnedFollowingTransaction").try_cast("double").alias("after"),
            value(x, "conversionOrExercisePrice").try_cast("double").alias("exercise_price"), value(x, "underlyingSecurity", "underlyingSecurityTitle").alias("underlying"), ids(*pointed).alias("ids"),
        )

    sources = [("nonDerivativeTable.nonDerivativeTransaction", False, True), ("nonDerivativeTable.nonDerivativeHolding", False, False), ("derivativeTable.derivativeTransaction", True, True), ("derivativeTable.derivativeHolding", True, False)]
    def listed(name: str, derivative: bool, dealt: bool) -> Column:
        return F.transform(F.col(name), lambda x: line(x, derivative, dealt))

    lines = F.flatten(F.array_compact(F.array(*(listed(*source) for source in sources))))
    names = F.array_join(F.transform(owner, lambda o: o["reportingOwnerId"]["rptOwnerName"]), "; ")
    rows = forms.select(*key, names.alias("owners"), F.array_join(roles, ", ").alias("roles"), F.col("issuer.issuerTradingSymbol").alias("ticker"), texts.alias("__texts"), F.posexplode(lines).alias("__n", "__x")).select("*", "__x.*")
    group = [*key, "owners", "roles", "ticker", "derivative", "kind", "security", "day", "code", "direction", "nature"]
    alone = F.when(F.col("kind") == "holding", F.col("__n"))  # holdings are listed, not grouped
    out = rows.withColumn("__alone", alone).groupBy(*group, "__alone").agg(F.count("*").alias("fills"), F.when(F.count("shares") == F.count("*"), F.sum("shares")).alias("shares"), F.max_by("after", "__n").alias("owned_after"), F.max_by("exercise_price", "__n").alias("exercise_price"), F.max_by("underlying", "__n").alias("underlying"), F.array_sort(F.collect_list(F.struct("__n", "ids"))).alias("__ids"), F.max_by(F.map_entries("__texts"), "__n").alias("__t"))
    pointed = F.flatten(F.transform("__ids", lambda x: x["ids"]))
    known = F.map_from_entries("__t")
    return out.withColumn("footnotes", F.array_distinct(F.array_compact(F.transform(pointed, lambda i: F.element_at(known, i))))).drop("__alone", "__ids", "__t")


def year_end_closes(closes: DataFrame, yields: DataFrame, symbol: str, date: str, close: str, rate: str) -> DataFrame:
    """Each symbol's last close of a calendar year with the yield of that day, else of the last day before it that has one."""
    last = closes.groupBy(symbol, F.year(date).alias("year")).agg(F.max_by(F.struct(date, close), F.col(date)).alias("__l")).select(symbol, "year", f"__l.{date}", f"__l.{close}")
    one = lambda df: df.withColumn("__all", F.lit(0))  # noqa: E731  yields have no key: a series of its own
    rates = yields.select(F.col(date).alias("__d"), rate)
    return asof_join(one(last), one(rates), ["__all"], date, "__d", [rate], lambda c: F.date_trunc("month", c)).drop("__all")
