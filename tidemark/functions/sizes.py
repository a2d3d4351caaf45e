"""Broadcasts of a size that is looked at first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 100_000


def small(df: DataFrame, most: int = MOST) -> DataFrame:
    """df to be broadcast if it has at most `most` rows; a larger one is left to the join as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt over all cores, for work that is long for each row: a table of narrow rows is a file of a few MB, which is one task.
    The number is given, as adaptive execution would put parts of a few MB together again."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)
