"""The event machine by keyed state with timers: an open event as a value, what is attached to it as a list."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .machines import of_kinds

OUT = "key long, opened_at timestamp, opened_id long, closed_at timestamp, closed_by string, attached array<bigint>"
CLOSED = Row("key", "opened_at", "opened_id", "closed_at", "closed_by", "attached")
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ordered(rows: Iterator[Row], opens: str, closes: str) -> Iterator[tuple[int, int | None, bool, bool]]:
    """at_us, id, whether it opens and closes: one key's records of one batch, by time and id, a missing id last. 17 bytes are held for each."""
    at, ids, flags = array("q"), array("q"), bytearray()
    for row in rows:
        at.append(row.at_us)
        ids.append(row.id or 0)
        flags.append((row.kind == opens) + 2 * (row.kind == closes) + 4 * (row.id is None))
    for i in np.lexsort([ids, np.frombuffer(flags, np.uint8) >> 2, at]) if len(at) > 1 else range(len(at)):
        yield at[i], None if flags[i] & 4 else ids[i], bool(flags[i] & 1), bool(flags[i] & 2)


class Events(StatefulProcessor):
    """Of one key: `opens` opens an event unless one is open, `closes` closes it, or the timer does. Records that come while it is open,
    repeats and amendments, are attached to it; what comes later belongs to the next event and reopens none."""

    def __init__(self, opens: str, closes: str, after_micros: int):
        self.opens, self.closes, self.after = opens, closes, after_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.event = handle.getValueState("event", "opened_us long, opened_id long")
        self.attached = handle.getListState("attached", "id long")

    def _due(self, opened_us: int) -> int:
        return -(-(opened_us + self.after + 1) // 1000)  # the first whole millisecond behind the end

    def _row(self, key: tuple, event: tuple, at_us: int, by: str, ids: list) -> Row:
        when = lambda us: EPOCH + timedelta(microseconds=us)
        return CLOSED(key[0], when(event[0]), event[1], when(at_us), by, sorted(ids, key=lambda i: (i is None, i or 0)))

    def _held(self) -> list:
        return [i for (i,) in self.attached.get()]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """State is read once and written once a key and batch; in between it is kept here."""
        before = self.event.get()
        event, ids, had = before, [], before is not None  # had: the stored ids belong to the open event
        for at_us, id_, opens, closes in ordered(rows, self.opens, self.closes):
            expired = event is not None and at_us > event[0] + self.after
            if expired or (event is not None and closes):
                end, by = (event[0] + self.after, "timer") if expired else (at_us, self.closes)
                yield self._row(key, event, end, by, (self._held() if had else []) + ids)
                event, ids, had = None, [], False
            if opens and event is not None:
                ids.append(id_)
            elif opens:
                event = (at_us, id_)
        if before is not None and not had:
            self.handle.deleteTimer(self._due(before[0]))
            self.attached.clear()
        if event is None:
            if before is not None:
                self.event.clear()
        elif not had:
            self.event.update(event)
            self.handle.registerTimer(self._due(event[0]))
        if ids:
            self.attached.appendList([(i,) for i in ids])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        event = self.event.get()
        if event is not None and expiredTimerInfo.getExpiryTimeInMs() == self._due(event[0]):
            row = self._row(key, event, event[0] + self.after, "timer", self._held())
            self.event.clear()
            self.attached.clear()
            yield row

    def close(self) -> None:
        pass


def event_states(stream: DataFrame, opens: str, closes: str, after_micros: int) -> DataFrame:
    """stream: key, at, id, kind with a watermark on at. A row for each closed event, with the ids attached to it; state is one open
    event a key and one timer, in RocksDB (see `run_to_end`). Records are taken as rows: a key has few in a batch, and a data frame for
    each key costs more than they do."""
    timed = of_kinds(stream, opens, closes)
    return timed.groupBy("key").transformWithState(Events(opens, closes, after_micros), OUT, "append", "EventTime")


def run_to_end(result: DataFrame, spark: SparkSession, out: str, marks: str) -> DataFrame:
    """Run a keyed-state result over what is there now and read its table. Run again with the same folders it goes on from where
    it stopped: open events, what is attached to them and timers are in the checkpoint."""
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    spark.conf.set(conf, PROVIDER)
    try:
        result.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(conf, before)
    return spark.read.schema(result.schema).parquet(out)
