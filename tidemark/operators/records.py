"""Records of runs, registers and companies: dimensions, blind views, windows of acceptance, proofs, resolved sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def filers(theses: DataFrame, intake: DataFrame, submissions: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row a company: each field from its thesis, else the intake list, else its submissions; basis is the best of the
    three that knows it."""
    tiers = [("thesis", theses), ("intake", intake), ("submissions", submissions)]
    ranked = reduce(DataFrame.unionByName, [t.select(key, *fields, F.lit(i).alias("__t"), F.lit(n).alias("__n")) for i, (n, t) in enumerate(tiers)])
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("__t"))).alias(f) for f in fields]
    return ranked.groupBy(key).agg(*first, F.min_by("__n", "__t").alias("basis"))


def unique_issuers(registered: DataFrame, ticker: str, issuer: str) -> DataFrame:
    """Tickers with their one issuer; those with several have none, and say how many."""
    n = F.count_distinct(issuer)
    return registered.groupBy(ticker).agg(F.when(n == 1, F.min(issuer)).alias(issuer), n.alias("issuers"))


def definitions(tests: DataFrame, registry: DataFrame, metric: str, own: str, definition: str) -> DataFrame:
    """Tests with the definition that holds: their own, else the registry's; basis says which, null where there is none."""
    r = registry.select(metric, F.col(definition).alias("__r"))
    joined = tests.join(r, metric, "left")
    return joined.withColumn(definition, F.coalesce(own, "__r")).withColumn("basis", F.when(F.col(own).isNotNull(), "own").when(F.col("__r").isNotNull(), "registry")).drop("__r")


def metric_parts(defined: DataFrame, metric: str, parts: str) -> DataFrame:
    """Names under which a metric's values are read: itself, or metric.component for each component; each once."""
    names = F.transform(F.map_keys(parts), lambda k: F.concat(F.col(metric), F.lit("."), k))
    listed = F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, names).otherwise(F.array(metric))
    return defined.select(F.explode(listed).alias("name"), metric).distinct()


def blind(df: DataFrame, hidden: list[str], settle: dict[str, str] | None = None, kind: str | None = None) -> DataFrame:
    """A view for a reader who mustn't see some columns; settle maps the words of `kind` to what it settles as."""
    shown = df
    if settle and kind:
        shown = shown.withColumn("settle_as", F.element_at(F.create_map(*(F.lit(x) for kv in settle.items() for x in kv)), F.col(kind)))
    return shown.drop(*hidden)


def without_nested(df: DataFrame, column: str, fields: list[str]) -> DataFrame:
    return df.withColumn(column, F.col(column).dropFields(*fields))


def artefacts(outputs: DataFrame, label: str | None = None, since: Column | None = None, until: Column | None = None, day: str = "day", company: str | None = None, period: str | None = None) -> DataFrame:
    """Outputs of runs by label, window of days, company and period; what isn't given doesn't filter."""
    tests = [(F.col("label") == label) if label else None, (F.col(day) >= since) if since is not None else None, (F.col(day) <= until) if until is not None else None, (F.col("company") == company) if company else None, (F.col("period") == period) if period else None]
    return reduce(DataFrame.where, [t for t in tests if t is not None], outputs)


def latest_outputs(runs: DataFrame, outputs: DataFrame, by: list[str], order: list[str], wanted: list[str]) -> DataFrame:
    """For each key the wanted outputs of its latest run; reason says why one is missing: no run, or not in it."""
    last = runs.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy(*(F.desc(o) for o in order)))).where("__k = 1").select(*by, "run_id")
    asked = runs.select(*by).distinct().withColumn("output", F.explode(F.array(*(F.lit(w) for w in wanted))))
    met = asked.join(last, by, "left").join(outputs.select("run_id", "output", "content"), ["run_id", "output"], "left")
    return met.withColumn("reason", F.when(F.col("content").isNull(), "not in the run"))


def own_log(log: DataFrame, request: str, digest: Column) -> DataFrame:
    return log.where(F.col(request) == digest)


def skip_reasons(stages: DataFrame, rules: list[tuple[str, DataFrame, list[str], str]]) -> DataFrame:
    """Stages with skip_reason, null where they run. rules: stage, table of what it would work on, key, and the reason that
    holds where the table has no row of the key; the first that applies counts."""
    out, reason = stages, F.lit(None).cast("string")
    for i, (stage, work, key, why) in reversed(list(enumerate(rules))):
        out = out.join(work.select(*key, F.lit(True).alias(f"__w{i}")).distinct(), key, "left")
        reason = F.when((F.col("stage") == stage) & F.col(f"__w{i}").isNull(), why).otherwise(reason)
    return out.withColumn("skip_reason", reason).drop(*(f"__w{i}" for i in range(len(rules))))


def in_window(day: Column, start: Column, end: Column, done: Column, now: Column) -> Column:
    """PASS, PENDING or FAIL of something due within a window: done in it; not done while it is open; else FAIL."""
    return F.when(done & day.between(start, end), "PASS").when(~done & (now <= end), "PENDING").otherwise("FAIL")


def final_record(front: Column, period: Column) -> Column:
    """Whether a parsed front matter (map) is the final record of a period."""
    return F.coalesce((F.element_at(front, "status") == "final") & (F.element_at(front, "period") == period), F.lit(False))


def unfinished(records: DataFrame, due: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are due and have no final record: record is their latest status, null without any."""
    last = records.groupBy(*key).agg(F.max_by("status", "version").alias("record"), F.bool_or(F.col("status") == "final").alias("__f"))
    return due.select(*key).distinct().join(last, key, "left").where("__f is null or not __f").select(*key, "record")


def archive_documents(writes: DataFrame, path: str, kinds: list[str]) -> DataFrame:
    """Planned writes that are documents of the archive: by the file's name, in any folder."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return writes.where(name.isin(*kinds) | name.rlike(r"[.]md$"))


def merged_in_time(files: DataFrame, commits: DataFrame, by: list[str], deadline: str) -> DataFrame:
    """Files of a period by kind, with when they were first merged and last changed: in_time, and unchanged after."""
    met = files.join(commits, "path", "left").groupBy(*by, "kind", deadline).agg(F.min("merged_at").alias("first"), F.max("merged_at").alias("last"))
    return met.withColumn("in_time", F.coalesce(F.col("first") < F.col(deadline), F.lit(False))).withColumn("unchanged", F.coalesce(F.col("last") < F.col(deadline), F.lit(False)))


def evidence(sources: list[DataFrame], mentions: DataFrame) -> DataFrame:
    """Evidence for every reader with its priority (the place of its source): a company's own rows, and rows of others where a
    mention names them. Sources: company, tag, text; mentions: reader, unit, company. unit is null for own rows."""
    ranked = reduce(DataFrame.unionByName, [s.withColumn("priority", F.lit(i)) for i, s in enumerate(sources)])
    own = ranked.withColumn("reader", F.col("company")).withColumn("unit", F.lit(None).cast(mentions.schema["unit"].dataType))
    named = mentions.where("reader <> company").distinct()
    return own.unionByName(ranked.join(named, "company").select(*own.columns))


def proof_state(proofs: DataFrame, key: str, expected: str, digest: str, output: str) -> DataFrame:
    """State of timestamp proofs by what their tool printed: missing, error (no digest, or another one), attested with its
    least block height, or pending."""
    heights = F.transform(F.regexp_extract_all(output, F.lit(r"BlockHeaderAttestation\(([0-9]+)\)"), F.lit(1)), lambda h: h.cast("long"))
    state = F.when(F.col(output).isNull(), "missing").when(F.col(digest).isNull() | (F.lower(digest) != F.lower(expected)), "error").when(F.size(heights) > 0, "attested").when(F.col(output).contains("PendingAttestation"), "pending").otherwise("error")
    return proofs.select(key, state.alias("state"), F.when(state == "attested", F.array_min(heights)).alias("block"))


def listed_ids(table: DataFrame, key: str, facts: str) -> DataFrame:
    """Ids of facts of documents that are a list of facts or hold one under `facts` (VARIANT): key, place, id."""
    inner = F.coalesce(F.try_variant_get(facts, "$.facts", "variant"), F.col(facts))
    tvf = table.sparkSession.tvf
    rows = table.select(F.col(key).alias("__key"), inner.alias("v")).lateralJoin(tvf.variant_explode(F.col("v").outer()))
    return rows.select(F.col("__key").alias(key), F.col("pos").alias("place"), F.try_variant_get("value", "$.id", "string").alias("id")).where("id is not null")


#: How the kinds of source tags are told apart by their second part.
KINDS = {"RPT": "report", "DOS": "dossier", "IND": "industry", "PRV": "private", "PX": "price", "YLD": "yield"}


def tag_kind(tag: Column) -> Column:
    """Kind of a source tag: by its second part, else a filing."""
    part = F.split_part(tag, F.lit("-"), F.lit(2))
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv)), part), F.lit("filing"))


def resolved(tags: DataFrame, tag: str, providers: dict[str, DataFrame]) -> DataFrame:
    """Tags with what their provider knows: text for documents, value for prices and yields. providers: kind to a table of
    tag, text and value; any table that has these columns will do. missing: no provider, or not known to it."""
    known = reduce(DataFrame.unionByName, [t.select(F.col(tag), "text", "value", F.lit(k).alias("kind")) for k, t in providers.items()])
    asked = tags.select(tag).distinct().withColumn("kind", tag_kind(F.col(tag)))
    met = asked.join(known.withColumn("__there", F.lit(True)), [tag, "kind"], "left")
    return met.withColumn("missing", F.when(F.col("__there").isNull(), F.when(F.col("kind").isin(*providers), "not known").otherwise("no provider"))).drop("__there")


def accession_values(facts: DataFrame, accession: str, value: str, unit: str) -> DataFrame:
    """Facts of one filing each as written and, for money, in millions as well: the numbers its text may print."""
    both = F.when(F.col(unit) == "USD", F.array(F.col(value), F.col(value) / 1e6)).otherwise(F.array(F.col(value)))
    return facts.select(accession, F.explode(both).alias(value), unit).distinct()


def filings_for(filings: DataFrame, forms: list[str], as_of: Column, companies: list[str] | None = None, period: Column | None = None, latest: int | None = None) -> DataFrame:
    """A named assembly's filings: of some companies (or all), some forms and a period, filed by a day, with place: 1 for each
    company's newest; `latest` of each at most."""
    own = filings.where(F.col("form").isin(*forms) & (F.col("filing_date") <= as_of))
    own = own if companies is None else own.where(F.col("company").isin(*companies))
    own = own if period is None else own.where(F.col("period") == period)
    place = F.row_number().over(Window.partitionBy("company").orderBy(F.desc("filing_date"), F.desc("accession")))
    ranked = own.withColumn("place", place)
    return ranked if latest is None else ranked.where(F.col("place") <= latest)


#: Named assemblies: the forms that a reader of each takes, and how many of the newest.
ASSEMBLIES = {"annual": (["10-K", "20-F", "40-F"], 1), "interim": (["10-Q", "6-K"], 3), "ownership": (["3", "4", "5"], None), "proxies": (["DEF 14A"], 1)}


def assembled(filings: DataFrame, name: str, as_of: Column, companies: list[str] | None = None, period: Column | None = None, assemblies: dict = ASSEMBLIES) -> DataFrame:
    """The filings of an assembly by its name."""
    forms, latest = assemblies[name]
    return filings_for(filings, forms, as_of, companies, period, latest)


def gate_planned(figures: DataFrame, verdicts: DataFrame, planned: DataFrame, path: str, key: str) -> DataFrame:
    """Figures of the writes that are planned, with the verdict that counts: open where there is none, warned where an accepted
    one doesn't say how it was found."""
    met = figures.join(planned.select(path).distinct(), path).join(verdicts.select(key, "verdict", "how"), key, "left")
    state = F.when(F.col("verdict").isNull(), "open").when((F.col("verdict") == "accepted") & (F.coalesce(F.trim("how"), F.lit("")) == ""), "warned").otherwise(F.col("verdict"))
    return met.withColumn("state", state)


def readings(values: DataFrame, run: Column, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings from extracted values (metric, period, value text, source), and those that can't be used with a reason: unknown
    metric, no period of a quarter, no number, no source."""
    from ..functions.text import parse_number

    known = values.join(names.select("metric", F.lit(True).alias("__k")).distinct(), "metric", "left").withColumn("number", parse_number("value"))
    reason = F.when(F.col("__k").isNull(), "unknown metric").when(~F.coalesce(F.col("period").rlike("^FY[0-9]{4}Q[1-4]$"), F.lit(False)), "no quarter").when(F.col("number").isNull(), "no number").when(F.coalesce(F.col("source"), F.lit("")) == "", "no source")
    judged = known.withColumn("reason", reason).withColumn("run", run).drop("__k")
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")
