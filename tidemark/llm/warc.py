"""WARC archives through a chunked record table.

A payload is a run of rows (record, chunk number, bytes) of at most CHUNK bytes; `chunk_table` cuts it a row at a time and
carries its digest from chunk to chunk, so that the row of the last chunk knows digest and length of the whole. Decisions
are made on those rows alone and joined to the chunks by record: whole payloads are in the input's rows only, and move
nowhere. In an archive a long payload is a response record followed by continuation records, one for each further chunk,
as the WARC format's segmentation has it; Spark's text writer lays the records down, so archives go wherever Spark can
write. A payload that occurs before (in a smaller page_id) becomes a revisit record without a body.

Archives are read as a stream of lines by Spark's text reader, so neither a file nor a record is held whole, whatever its
size. Records of one segment are digested as they pass; the segments of longer ones, which may stand anywhere in any
file, are chunk rows again, dealt by record, sorted by number, and digested one after the other.

Defined results: null payloads are empty; of equal payloads all rows with the smallest page_id are responses; a null
page_id comes after all others; line breaks in URLs are escaped; repeated rows each give a row; an empty table gives an
archive without records; other columns of pages are left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stored

CHUNK = 1 << 16
STEP = 1 << 20  # bytes of an archive that are looked at together
URN = "urn:tidemark:record:"


def chunks(rows: DataFrame, payload: str, size: int = CHUNK) -> DataFrame:
    """The other columns, n_chunks, chunk_no from 0, and chunk (binary), cut row by row. An empty payload is one empty chunk."""
    others = [f"`{c}`" for c in rows.columns if c != payload]
    numbered = rows.selectExpr(*others, payload, f"cast(greatest(1, ceil(octet_length({payload}) / {size})) as int) as n_chunks")
    numbered = numbered.selectExpr("*", "explode(sequence(0, n_chunks - 1)) as chunk_no")
    return numbered.selectExpr(*others, "n_chunks", "chunk_no", f"substring({payload}, chunk_no * {size} + 1, {size}) as chunk")


class _Running:
    """Length and digest of a record whose chunks come one after the other."""

    def __init__(self):
        self.sha, self.n = hashlib.sha1(), 0

    def add(self, piece: bytes) -> None:
        self.sha.update(piece)
        self.n += len(piece)

    def digest(self) -> str:
        return base64.b32encode(self.sha.digest()).decode()


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", size: int = CHUNK) -> DataFrame:
    """record, page_id, url, n_chunks, chunk_no, chunk of every page; on the last chunk also payload_bytes and digest."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.encode(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))

    def run(batches):
        running = _Running()
        for batch in batches:
            sizes, found = [], []
            many, number, chunk = (batch.column(i) for i in (3, 4, 5))
            for n, no, piece in zip(many.to_pylist(), number.to_pylist(), chunk):
                if no == 0:
                    running = _Running()
                running.add(piece.as_buffer())
                last = no == n - 1
                sizes.append(running.n if last else None)
                found.append(running.digest() if last else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(found, pa.string())], names=[*batch.schema.names, "payload_bytes", "digest"])

    cut = chunks(rows.withColumn("record", F.monotonically_increasing_id()).select("record", "page_id", "url", "payload"), "payload", size)
    return cut.mapInArrow(run, "record long, page_id long, url string, n_chunks int, chunk_no int, chunk binary, payload_bytes long, digest string")


def decide(last: DataFrame) -> DataFrame:
    """Of records with page_id and digest: record_type, refers_to (a page) and refers_record. Rows have no payload; a digest
    that very many records share is one row on its own side of the join, so the other is split at run time."""
    first = last.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record")).alias("f"))
    response = F.expr("page_id <=> f.page_id")
    return last.join(first, "digest").select("record", "digest", "payload_bytes", F.when(response, "response").otherwise("revisit").alias("record_type"), F.when(~response, F.col("f.page_id")).alias("refers_to"), F.when(~response, F.col("f.record")).alias("refers_record"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z", size: int = CHUNK) -> None:
    """Write a gzip WARC file for each partition: one record, or one run of segments, for each row of pages."""
    table = stored(chunk_table(pages, id_col, url_col, payload_col, size), "chunks", "zstd")
    kinds = decide(table.where("digest is not null").select("record", "page_id", "payload_bytes", "digest"))
    bodies = table.drop("payload_bytes", "digest").join(kinds, "record").where("record_type = 'response' or chunk_no = 0")
    again = "record_type = 'revisit'"
    bodies = bodies.selectExpr("record", "page_id", "url", "chunk_no", f"if({again}, 1, n_chunks) as n_chunks", f"if({again}, X'', chunk) as chunk", "payload_bytes", "digest", "record_type", "refers_to", "refers_record")
    line = lambda name, value: f"'{name}: ', {value}, '\\r\\n'"
    own = f"'<{URN}', record, '>'"
    http = "'HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', payload_bytes, '\\r\\n\\r\\n'"
    head = f"""concat('WARC/1.1\\r\\n',
        {line('WARC-Type', "if(chunk_no = 0, record_type, 'continuation')")},
        if(chunk_no = 0, concat({line('WARC-Record-ID', own)}), concat({line('WARC-Record-ID', f"'<{URN}', record, ':', chunk_no + 1, '>'")}, {line('WARC-Segment-Origin-ID', own)})),
        if(page_id is null, '', concat({line('X-Page-ID', 'page_id')})),
        if(url is null, '', concat({line('WARC-Target-URI', "replace(replace(url, '\\r', '%0D'), '\\n', '%0A')")})),
        {line('WARC-Date', f"'{date}'")}, {line('WARC-Payload-Digest', "'sha1:', digest")}, {line('X-Payload-Length', 'payload_bytes')},
        if(refers_record is null, '', concat({line('WARC-Refers-To', f"'<{URN}', refers_record, '>'")}, {line('WARC-Profile', "'http://netpreserve.org/warc/1.1/revisit/identical-payload-digest'")})),
        if(refers_to is null, '', concat({line('X-Refers-To-Page', 'refers_to')})),
        if(n_chunks > 1, concat({line('WARC-Segment-Number', 'chunk_no + 1')}), ''),
        if(n_chunks > 1 and chunk_no = n_chunks - 1, concat({line('WARC-Segment-Total-Length', 'payload_bytes')}), ''),
        {line('Content-Type', "'application/http; msgtype=response'")},
        {line('Content-Length', 'octet_length(chunk) + octet_length(http)')}, '\\r\\n', http)"""
    first = f"if(chunk_no = 0, concat({http}), '')"
    record = "cast(concat(encode(head, 'UTF-8'), chunk, X'0D0A0D') as string) as value"  # the writer's line feed is the last byte
    bodies.selectExpr("*", f"{first} as http").selectExpr("chunk", f"{head} as head").selectExpr(record).write.option("compression", "gzip").option("lineSep", "\n").text(path)


class _Stream:
    """Bytes of an archive, taken a block at a time."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.buffer = iter(blocks), bytearray()

    def _more(self) -> bool:
        block = next(self.blocks, None)
        if block is None:
            return False
        self.buffer += block
        return True

    def head(self) -> dict[str, str] | None:
        """Header lines of the next record."""
        looked = 0
        while (end := self.buffer.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(self.buffer) - 3)
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return None
        lines = self.buffer[:end].decode().split("\r\n")
        del self.buffer[: end + 4]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends inside a record")
            part = bytes(self.buffer[:n])
            del self.buffer[: len(part)]
            n -= len(part)
            yield part

    def skip(self, expected: bytes) -> None:
        if b"".join(self.take(len(expected))) != expected:
            raise ValueError("a record doesn't end where its length says")


def records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Headers and body pieces of each record; pieces not asked for are skipped."""
    stream = _Stream(blocks)
    while (head := stream.head()) is not None:
        body = stream.take(int(head["content-length"]))
        yield head, body
        for _ in body:
            pass
        stream.skip(b"\r\n\r\n")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """Lines of archives, joined again in blocks of about STEP bytes."""
    for batch in batches:
        column = batch.column(0)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP, "right")) - 1)
            part = pa.ListArray.from_arrays(pa.array([0, to - at], pa.int32()), column.slice(at, to - at))
            yield pc.binary_join(part, b"\n")[0].as_py() + b"\n"
            at = to


def _payload(head: dict[str, str], body: Iterator[bytes]) -> Iterator[bytes]:
    """A record's body without its HTTP header; continuations have none."""
    if head["warc-type"] == "continuation":
        yield from body
        return
    seen = b""
    for piece in body:
        seen += piece
        if (end := seen.find(b"\r\n\r\n")) >= 0:
            yield seen[end + 4 :]
            break
    yield from body


SEGMENTS = "origin string, segment int, page_id long, url string, record_type string, refers_to long, carried string, length long, n long, digest string, chunk binary"
_SEGMENTS = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("carried", pa.string()), ("length", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("chunk", pa.binary())])


def _rows(lists: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(lists, schema=_SEGMENTS)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each record or segment: whole records are digested here, segments keep their chunk."""
    out: dict[str, list] = {c: [] for c in _SEGMENTS.names}
    size = 0
    for head, body in records(_blocks(batches)):
        number = head.get("warc-segment-number")
        running, chunk = _Running(), [] if number else None
        for piece in _payload(head, body):
            if chunk is None:
                running.add(piece)
            else:
                chunk.append(piece)
        page, refers = head.get("x-page-id"), head.get("x-refers-to-page")
        again = head["warc-type"] == "revisit"
        row = (
            head.get("warc-segment-origin-id", head["warc-record-id"]), int(number) if number else None, int(page) if page else None, head.get("warc-target-uri"), head["warc-type"], int(refers) if refers else None,
            head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"]), None if number or again else running.n, None if number or again else running.digest(), b"".join(chunk) if number else None,
        )
        for values, x in zip(out.values(), row):
            values.append(x)
        size += len(row[-1] or b"") + 200
        if size > STEP:
            yield _rows(out)
            out, size = {c: [] for c in _SEGMENTS.names}, 0
    yield _rows(out)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from rows sorted by record and segment: a running digest over the chunks of each."""
    origin, running, head = None, _Running(), None

    def finish(row: dict) -> tuple:
        again = row["record_type"] == "revisit"
        n, digest = (running.n, running.digest()) if row["segment"] else (row["n"], row["digest"])
        if not again and (digest != row["carried"] or n != row["length"]):
            raise ValueError(f"payload of {row['origin']} isn't what its digest says")
        return row["page_id"], row["url"], row["length"] if again else n, row["carried"] if again else digest, row["record_type"], row["refers_to"]

    done: list[tuple] = []
    for batch in batches:
        plain = batch.drop_columns(["chunk"]).to_pylist()
        for row, chunk in zip(plain, batch.column("chunk")):
            if row["origin"] != origin or not row["segment"]:
                if head is not None:
                    done.append(finish(head))
                origin, head, running = row["origin"], row, _Running()
                if (row["segment"] or 1) != 1:
                    raise ValueError(f"the first segment of {origin} is missing")
                last = 0
            if row["segment"]:
                last += 1
                if row["segment"] != last:
                    raise ValueError(f"segment {last} of {origin} is missing or there twice")
                running.add(chunk.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done) if done else [[]] * 6, _RECORDS.types)], schema=_RECORDS)
        done = []
    if head is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(finish(head), _RECORDS.types)], schema=_RECORDS)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of all archives below path: a row for each record of one segment, and for each segment of a longer one."""
    lines = spark.read.option("pathGlobFilter", "*.gz").option("lineSep", "\n").schema("value string").text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(_segments, SEGMENTS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives below path: page_id, url, payload_bytes, payload_digest (computed from the body, for revisits the
    one they carry), record_type and refers_to. Chunks of long payloads are dealt by record and followed in order."""
    dealt = read_segments(spark, path).repartition("origin").sortWithinPartitions("origin", "segment")
    return dealt.mapInArrow(_assemble, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def op9_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT x, min(page_id) AS first FROM p GROUP BY x),
h AS (SELECT DISTINCT x, unnest(range(1, 41)) AS i FROM p),
v AS (SELECT x, (i - 1) // 5 AS g, sum((strpos('0123456789abcdef', substr(x, i, 1)) - 1) * (1 << (4 * (4 - (i - 1) % 5))))::BIGINT AS n FROM h GROUP BY ALL),
c AS (SELECT x, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((n >> s) & 31), 1), '' ORDER BY g, s DESC) AS payload_digest FROM v, (VALUES (0::BIGINT), (5), (10), (15)) AS t(s) GROUP BY x)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (x) JOIN c USING (x)
"""
