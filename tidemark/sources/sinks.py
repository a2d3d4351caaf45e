"""Writers: appended logs, whole replacements, registers that are never rewritten, and routed outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import insert_only


def append_log(df: DataFrame, path: str) -> None:
    """Rows as JSON lines with keys in order of name, added to what is there."""
    df.select(*sorted(df.columns)).write.mode("append").json(path)


def replace(df: DataFrame, path: str) -> None:
    """The table at path becomes df at once: written beside it, then moved into its place, so that a failed write leaves the
    old one whole. df may be read from path itself."""
    spark = df.sparkSession
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    new, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.parquet(new)
    here, there, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old))
    fs = here.getFileSystem(hadoop)
    if fs.exists(here):
        fs.rename(here, aside)
    if not fs.rename(there, here):
        raise OSError(f"{new} can't be moved to {path}")
    fs.delete(aside, True)


def register(df: DataFrame, path: str, key: str, old: DataFrame | None = None) -> DataFrame:
    """Append the rows of df whose key a register doesn't have; returns those in conflict, which stay as they were."""
    spark = df.sparkSession
    if old is None:
        try:
            old = spark.read.parquet(path)
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = spark.createDataFrame([], df.schema)
    judged = insert_only(old, df, key)
    judged.where("action = 'insert'").drop("action").write.mode("append").parquet(path)
    return judged.where("action = 'conflict'").drop("action")


def routed(df: DataFrame, path: str, destination: str) -> None:
    """Rows in a folder for each destination; few files each, whatever the input's partitions."""
    df.repartition(F.col(destination)).write.mode("append").partitionBy(destination).parquet(path)
