"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (tables) -> DataFrame under its own name. sql: the same rows, for DuckDB."""

    def register(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


class Tables:
    """Tables of a directory as attributes; timestamps without a zone become UTC timestamps."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.withColumns({c: df[c].cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})
