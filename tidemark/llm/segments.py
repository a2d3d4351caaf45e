"""Documents packed into segments: rows of about 1 MB of text that several passes share.

`pack` writes the segments once, without a shuffle, to a table bucketed by segment number. Passes then talk to each
other through small rows keyed by segment or by hash bucket: `ask` maps over segments, `settle` groups by hash bucket,
and `answer` brings the replies to their segments. The bucketing lets `answer` read the text in place, so text never
moves between executors, however many passes an operator takes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import made, scratch

SEGMENT_BYTES = 1 << 20
PACK_ROWS = 1000  # of an Arrow batch while packing: whole texts stand in it, outside the JVM's heap
LAST = np.iinfo(np.int64).max  # the order key of a null id
SCHEMA = "seg long, n_docs int, n_bytes long, keys binary, lens binary, text binary, rest binary"


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, joined, and where each row begins; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class Segment:
    """One segment, unpacked. texts: places of the carried columns that are the text itself."""

    def __init__(self, row: dict, texts: tuple[int, ...] = ()):
        self.seg, self.texts = row["seg"], texts
        self.keys = np.frombuffer(row["keys"], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(row["lens"], np.int64))]).astype(np.int64)
        self.buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=row["n_bytes"]) if row["n_bytes"] else b"", np.uint8)
        self._rest = row["rest"]

    def rest(self) -> pa.Table:
        """The carried columns."""
        table = pa.ipc.open_stream(self._rest).read_all()
        if self.texts:
            offsets, null = pa.py_buffer(self.bounds.astype(np.int32).tobytes()), table.column("__null")
            text = pc.if_else(null, pa.scalar(None, pa.string()), pa.Array.from_buffers(pa.string(), len(self.keys), [None, offsets, pa.py_buffer(self.buf.tobytes())]))
            table = table.drop_columns("__null")
            for i in self.texts:
                table = table.add_column(i, f"c{i}", text)
        return table


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n, zip_ = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=1)
    for batch in batches:
        buf, bounds = utf8(batch.column(1))
        at = 0
        while at < batch.num_rows:
            to = min(batch.num_rows, max(at + 1, int(np.searchsorted(bounds, bounds[at] + SEGMENT_BYTES, "right")) - 1))
            ids = batch.column(0).slice(at, to - at)
            keys = ids.fill_null(int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
            text = buf[bounds[at] : bounds[to]].tobytes()
            rest = pa.RecordBatch.from_arrays([c.slice(at, to - at) for c in batch.columns[2:]], schema=pa.schema(list(batch.schema)[2:]))
            yield pa.RecordBatch.from_pydict(
                {"seg": [(part << 32) + n], "n_docs": [to - at], "n_bytes": [len(text)], "keys": [keys.tobytes()], "lens": [np.diff(bounds[at : to + 1]).tobytes()], "text": [zip_.compress(text)], "rest": [_ipc(rest)]},
                schema=pa.schema([("seg", pa.int64()), ("n_docs", pa.int32()), ("n_bytes", pa.int64()), *((c, pa.binary()) for c in ("keys", "lens", "text", "rest"))]),
            )
            at, n = to, n + 1


class Packed:
    """Segments of docs. carry: columns that `rest` gives back, row by row. The text itself is stored once, carried or not."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, carry: list[str]):
        spark = docs.sparkSession
        self.carry = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
        self.names = carry
        self.texts = tuple(i for i, c in enumerate(carry) if c == text_col and docs.schema[c].dataType == T.StringType())
        text = F.col(f"`{text_col}`").cast("string")
        others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry) if i not in self.texts]
        chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("__key"), text.alias("__text"), *others, *([text.isNull().alias("__null")] if self.texts else []))
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        name, path = f"tidemark_{uuid.uuid4().hex[:12]}", scratch(spark, "segments")
        made.append(path)
        batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = spark.conf.get(batch)
        spark.conf.set(batch, str(min(PACK_ROWS, int(before)) if int(before) > 0 else PACK_ROWS))
        try:
            chosen.mapInArrow(_pieces, SCHEMA).write.bucketBy(self.buckets, "seg").format("parquet").option("compression", "uncompressed").option("path", path).saveAsTable(name)
        finally:
            spark.conf.set(batch, before)
        self.rows = spark.table(name)
        self.n_bytes = self.rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]

    def hash_buckets(self) -> int:
        """So many that what 32 MB of text sends to a bucket meets there: memory of a group doesn't grow with the input."""
        return max(self.buckets, 16, -(-self.n_bytes // (32 << 20)))

    def ask(self, fn: Callable[[Segment], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
        texts = self.texts

        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from fn(Segment(batch.slice(i, 1).to_pylist()[0], texts))

        return self.rows.mapInArrow(run, schema)

    def answer(self, replies: DataFrame, fn: Callable[[Segment, pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
        """fn gets each segment with the replies to it, none perhaps."""

        texts = self.texts

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [fn(Segment(row, texts), right) for row in left.to_pylist()]
            return pa.concat_tables(out) if out else empty

        kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        from pyspark.sql.pandas.types import to_arrow_schema

        empty = to_arrow_schema(kind).empty_table()
        return self.rows.groupBy("seg").cogroup(replies.groupBy("seg")).applyInArrow(run, kind)


def dealt(seg: int, n: int, by: np.ndarray, columns: dict[str, np.ndarray], **fixed) -> pa.RecordBatch | None:
    """A row for each hash bucket that got something: bucket = high bits of `by` scaled to n; columns as binary."""
    bucket = ((by >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    b, cuts = np.unique(bucket[order], return_index=True)
    cuts = [*cuts.tolist(), len(order)]
    data = {"bucket": pa.array(b.astype(np.int64)), "seg": pa.array(np.full(len(b), seg, np.int64))}
    for name, values in columns.items():
        sorted_ = values[order]
        data[name] = pa.array([sorted_[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())
    return pa.RecordBatch.from_pydict(data)


def settle(asked: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(fn, schema)


def gather(table: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(x, dtype) for x in table.column(name).to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def sizes(table: pa.Table, name: str, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in table.column(name).to_pylist()], np.int64)


def spread(segs: np.ndarray, columns: dict[str, np.ndarray], chosen: np.ndarray) -> dict[str, list]:
    """The chosen entries, a row for each segment: replies."""
    at = np.flatnonzero(chosen)
    at = at[np.argsort(segs[at], kind="stable")]
    seg, cuts = np.unique(segs[at], return_index=True)
    cuts = [*cuts.tolist(), len(at)]
    return {"seg": seg.tolist()} | {k: [v[at[i:j]].tobytes() for i, j in zip(cuts, cuts[1:])] for k, v in columns.items()}


REPLY = "seg long, found binary"
REPLY_ARROW = pa.schema([("seg", pa.int64()), ("found", pa.binary())])


def repeated(table: pa.Table) -> pa.Table:
    """Of one hash bucket: for each segment, those of its hashes that were sent more than once by all segments together."""
    values, segs = gather(table, "h", np.uint64), np.repeat(table.column("seg").to_numpy(), sizes(table, "h", 8))
    order = np.argsort(values, kind="stable")
    v = values[order]
    same = np.zeros(len(v) + 1, bool)
    same[1:-1] = v[1:] == v[:-1]
    many = np.zeros(len(v), bool)
    many[order] = same[:-1] | same[1:]
    got = spread(segs, {"found": values}, many)
    return pa.table(got, schema=REPLY_ARROW)
