"""State over time as Structured Streaming: events opened, closed by a second record or by a timer, and windowed counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.staging import scratch

CLOSED = "key long, opened_at timestamp, opened_id long, closed_at timestamp, closed_by string, related int"


def of_kinds(stream: DataFrame, *kinds: str) -> DataFrame:
    """Records of some kinds with a time. One condition on both: one on the kind alone would be moved below the watermark, and the records
    of other kinds would not move it."""
    return stream.select("key", "at", F.unix_micros("at").alias("at_us"), "id", "kind").where(F.when(F.col("at").isNotNull(), F.col("kind").isin(*kinds)))


def in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, str]]:
    """at_us, id and kind of one key's records of one batch, by time and id. A key's records may come in several frames, in any order."""
    parts = [(f["at_us"].to_numpy(), f["id"].to_numpy(), f["kind"].to_numpy(object)) for f in frames]
    at, ids, kinds = (np.concatenate(x) for x in zip(*parts)) if len(parts) > 1 else parts[0] if parts else ((), (), np.array([], object))
    order = np.lexsort([ids, at])
    return zip(np.asarray(at)[order].tolist(), np.asarray(ids)[order].tolist(), kinds[order].tolist())


def event_machine(stream: DataFrame, opens: str, closes: str, after_micros: int) -> DataFrame:
    """stream: key, at, id, kind with a watermark on at. A record of kind `opens` opens an event unless one is open; then it
    is related. A record of kind `closes` closes it, or the timer does, so many microseconds after it opened; whatever
    comes after is a matter of the next event and never reopens one. A row for each closed event.

    State is one open event a key. Within a batch records are taken in order of (at, id).
    """

    def closed(key, state, at, by):
        return (key, pd.Timestamp(state[0], unit="us", tz="UTC"), state[1], pd.Timestamp(at, unit="us", tz="UTC"), by, state[2])

    def run(keys: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        key, out = keys[0], []
        state = group.get if group.exists else None  # opened_at, opened_id, related
        for at_us, id_, kind in in_order(frames):
            if state and at_us > state[0] + after_micros:
                out.append(closed(key, state, state[0] + after_micros, "timer"))
                state = None
            if kind == closes and state:
                out.append(closed(key, state, at_us, closes))
                state = None
            elif kind == opens:
                state = (state[0], state[1], state[2] + 1) if state else (at_us, id_, 0)
        if group.hasTimedOut and state and group.getCurrentWatermarkMs() * 1000 > state[0] + after_micros:
            out.append(closed(key, state, state[0] + after_micros, "timer"))
            state = None
        if state:
            group.update(state)
            group.setTimeoutTimestamp(max(group.getCurrentWatermarkMs() + 1, (state[0] + after_micros) // 1000))
        elif group.exists:
            group.remove()
        if out:
            yield pd.DataFrame(out, columns=["key", "opened_at", "opened_id", "closed_at", "closed_by", "related"])

    timed = of_kinds(stream, opens, closes)
    return timed.groupBy("key").applyInPandasWithState(run, CLOSED, "opened_us long, opened_id long, related int", "append", GroupStateTimeout.EventTimeTimeout)


def window_counts(stream: DataFrame, at: str, width: str, by: list[str], value: str) -> DataFrame:
    """Count and total of each window and key, once the watermark has passed the window: late rows beyond it are dropped."""
    grouped = stream.groupBy(F.window(at, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), *by, "n", "total")


def drained(result: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a streaming result over all that is there now, into a table of the shared folder, and read that."""
    out, marks = scratch(spark, name), scratch(spark, f"{name}-marks")
    query = result.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of the rows of a Parquet file or of the files of a folder. A stream of one file needs a pattern for its path."""
    head, last = path.rsplit("/", 1)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files).parquet(f"{head}/[{last[0]}]{last[1:]}")
