"""Readers of landed files. Nothing here calls a network: connectors put files down, these turn them into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import html_to_text, parse_money
from ..operators.facts import SCHEMA as FACTS
from ..operators.filings import BLOCK
from ..operators.holdings import OWNERSHIP, ownership_lines

_BLOCK = T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in BLOCK])


def submissions(spark: SparkSession, path: str) -> DataFrame:
    """cik, name, fiscal_year_end, part and block (columnar filings) of issuers' JSON files; overflow pages follow the recent
    block. Input for operators.filings.from_blocks."""
    head = T.StructType([*(T.StructField(c, T.StringType()) for c in ("cik", "name", "fiscalYearEnd")), T.StructField("filings", T.StructType([T.StructField("recent", _BLOCK)]))])
    rows = spark.read.schema(head).option("multiLine", True).json(path)
    return rows.where("filings.recent is not null").select("cik", "name", F.col("fiscalYearEnd").alias("fiscal_year_end"), F.lit(0).alias("part"), F.col("filings.recent").alias("block"))


def submission_pages(spark: SparkSession, path: str) -> DataFrame:
    """cik, part and block of overflow pages, named CIK<number>-submissions-<part>.json."""
    rows = spark.read.schema(_BLOCK).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    return rows.select(F.regexp_extract(name, "CIK0*([0-9]+)", 1).alias("cik"), F.regexp_extract(name, "-([0-9]+)[.]json$", 1).try_cast("int").alias("part"), F.struct(*(F.col(c) for c in BLOCK)).alias("block"))


def issuers_by_ticker(spark: SparkSession, path: str) -> DataFrame:
    """ticker, cik, title and n_ciks: from one object of numbered rows; share classes (BRK-A) also under their root ticker."""
    row = "map<string, struct<cik_str: bigint, ticker: string, title: string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", row)).alias("k", "r")).select(F.upper("r.ticker").alias("ticker"), F.lpad(F.col("r.cik_str").cast("string"), 10, "0").alias("cik"), "r.title")
    roots = rows.where("contains(ticker, '-')").withColumn("ticker", F.substring_index("ticker", "-", 1)).join(rows.select("ticker"), "ticker", "left_anti")
    return rows.unionByName(roots).groupBy("ticker").agg(F.min("cik").alias("cik"), F.min("title").alias("title"), F.count_distinct("cik").alias("n_ciks"))


def company_facts(spark: SparkSession, path: str) -> DataFrame:
    """cik and facts (nested maps); input for operators.facts.flatten."""
    kind = T._parse_datatype_string(f"struct<cik: string, facts: {FACTS}>")
    return spark.read.schema(kind).option("multiLine", True).json(path)


def price_history(spark: SparkSession, path: str) -> DataFrame:
    """symbol (from the file name), date and close; rows that don't parse are left out."""
    kind = "data struct<tradesTable: struct<rows: array<struct<date: string, close: string>>>>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path).select(F.regexp_extract("_metadata.file_name", "^([^.]+)", 1).alias("symbol"), F.explode("data.tradesTable.rows").alias("r"))
    return rows.select("symbol", F.to_date(F.try_to_timestamp("r.date", F.lit("MM/dd/yyyy"))).alias("date"), parse_money("r.close").alias("close")).where("date is not null and close is not null")


def treasury_yields(spark: SparkSession, path: str, tenor: str = "10 Yr") -> DataFrame:
    """date and value of one tenor, found by its header; blanks are left out."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.to_date(F.try_to_timestamp("Date", F.lit("MM/dd/yyyy"))).alias("date"), F.col(f"`{tenor}`").try_cast("double").alias("value")).where("date is not null and value is not null")


HOLDING = "nameOfIssuer string, titleOfClass string, cusip string, value string, shrsOrPrnAmt struct<sshPrnamt: string, sshPrnamtType: string>, putCall string"


def information_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of quarterly holdings tables with their file; input for operators.holdings.positions (add the filing date)."""
    rows = spark.read.schema(HOLDING).option("rowTag", "infoTable").option("ignoreNamespace", True).xml(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), "nameOfIssuer", "titleOfClass", "cusip", "value", "shrsOrPrnAmt.sshPrnamt", "shrsOrPrnAmt.sshPrnamtType", "putCall")


def ownership_trades(spark: SparkSession, path: str) -> DataFrame:
    """Insiders' transactions grouped as a reader sees them: by day, security, code, direction and nature, with the number of
    fills, the shares (null if any fill has none) and the last holding after them."""
    rows = ownership(spark, path).where("kind = 'transaction' and not derivative")
    return rows.select("file", "owners", "ticker", "security", "day", "code", "direction", "nature", "fills", "shares", "owned_after")


def ownership(spark: SparkSession, path: str) -> DataFrame:
    """Ownership documents whole: transactions and holdings of both tables with the footnotes they point to, by file."""
    forms = spark.read.schema(OWNERSHIP).option("rowTag", "ownershipDocument").xml(path)
    return ownership_lines(forms.withColumn("file", F.col("_metadata.file_name")), ["file"])


def call_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON-lines call logs; lines that aren't JSON objects are left out."""
    kind = "timestamp string, backend string, role string, part_id string, attempt int, model string, input_sha256 string, usage map<string, bigint>, cost_usd double, notional_cost_usd double, stop_reason string"
    lines = spark.read.text(path).where(F.expr("try_parse_json(value) is not null"))
    return lines.select(F.from_json("value", kind).alias("r")).where("r is not null").select("r.*").withColumn("at", F.try_to_timestamp("timestamp")).where("at is not null")


def run_directories(spark: SparkSession, root: str) -> DataFrame:
    """scope, run_date, part and files of run folders runs/<scope>/<date>-<part>, from a listing; file contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    pattern = "/runs/([^/]+)/([0-9]{4}-[0-9]{2}-[0-9]{2})-([^/]+)/(.+)$"
    found = files.where(F.col("path").rlike(pattern)).select(*(F.regexp_extract("path", pattern, i).alias(n) for i, n in enumerate(("scope", "run_date", "part", "file"), 1)), "length")
    return found.groupBy("scope", "run_date", "part").agg(F.array_sort(F.collect_list("file")).alias("files"), F.sum("length").alias("bytes"))


def delimited_documents(spark: SparkSession, path: str) -> DataFrame:
    """file, name and body of documents that stand in one text under lines "===== name ====="; text above the first is left out."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.explode(F.slice(F.split(F.concat(F.lit("\n"), "value"), "\n(?====== )"), 2, 1 << 30)).alias("d"))
    return whole.select("file", F.regexp_extract("d", "^===== (.*?) =====", 1).alias("name"), F.regexp_replace("d", "^=====[^\n]*\n?", "").alias("body"))


def html_documents(spark: SparkSession, path: str) -> DataFrame:
    """file and visible text of HTML files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), html_to_text("value").alias("text"))


def yaml_documents(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """file and data (VARIANT) of YAML files. Lenient: null where a file doesn't parse; strict: it, or a repeated key, fails
    the job. Dates become ISO text and keys text, as in JSON."""

    @F.pandas_udf("string")
    def to_json(texts):
        import json

        import yaml

        class Unique(yaml.SafeLoader):
            def construct_mapping(self, node, deep=False):
                keys = [self.construct_object(k, deep=True) for k, _ in node.value]
                if strict and len(set(map(str, keys))) < len(keys):
                    raise yaml.YAMLError(f"repeated key in {keys}")
                return super().construct_mapping(node, deep)

        def one(text):
            try:
                return json.dumps(yaml.load(text, Unique), default=lambda x: x.isoformat())
            except (yaml.YAMLError, AttributeError):
                if strict:
                    raise
                return None

        return texts.map(one)

    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.try_parse_json(to_json("value")).alias("data"))


def version_log(spark: SparkSession, path: str) -> DataFrame:
    """commit, at and path of a landed history (JSON lines of commit, at, files), a row a touched path."""
    rows = spark.read.schema("commit string, at string, files array<string>").json(path)
    return rows.select("commit", F.try_to_timestamp("at").alias("at"), F.explode("files").alias("path"))
