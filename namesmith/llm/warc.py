"""WARC archives as a chunked record table.

An archive is a table of rows ``(record, page_id, chunk, chunks, data, digest)``: the data of a record's chunks, in
order, are the bytes of its WARC/1.1 record. A record of at most ``CHUNK`` payload bytes is one row; a larger one is a
header row and payload rows of ``CHUNK`` bytes at most. The engine cuts payloads into chunks before they go to the
writer, so neither writer nor reader ever builds a whole record. Each row carries the SHA-1 of the payload up to its
end, which the reader follows with an incremental digest of its own; a difference, a gap or a wrong length raises.

Of records with equal payloads (SHA-256 and length) of at least ``LEAST`` bytes the one of the largest page_id is the
response and the others are revisits that refer to it; all smaller ones are responses.

A null payload counts as empty. A null page_id is smaller than every other. If the largest page_id of a payload occurs
more than once (repeated rows), all its rows are responses. Very long pages are more chunks. An empty table gives an
empty archive. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable, ship

CHUNK, LEAST, BATCH, SALTS = 64 << 10, 1000, 8 << 20, 16
_ROWS = "record string, page_id long, chunk int, chunks int, data binary, digest string"
_ARROW = pa.schema([("record", pa.string()), ("page_id", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("data", pa.binary()), ("digest", pa.string())])
_END = b"\r\n\r\n"
_URN = "urn:page:"


def header(kind: str, page_id, url, sha1_hex: str, length: int, refers_to=None) -> bytes:
    """The header block of a record, with the empty line that ends it."""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').translate({13: None, 10: None})}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1_hex)).decode()}",
        f"X-Payload-Length: {length}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {length if kind == 'response' else 0}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    return "\r\n".join(lines).encode() + _END


def parsed(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:] if line)}


def _writer(batches):
    """Rows of records from chunks of payloads; the chunks of a record come in order, one after the other."""
    context = TaskContext.get()
    part, number, running = context.partitionId() if context else 0, -1, None
    for batch in batches:
        out, held = [], 0
        data = batch.column("data")
        columns = [batch.column(x).to_pylist() for x in ("page_id", "url", "sha1", "size", "refers_to", "nth", "count")]
        for k, (page_id, url, sha1, size, refers, nth, count) in enumerate(zip(*columns)):
            revisit = refers is not None
            if nth == 0:
                number, running = number + 1, hashlib.sha1()
                head = header("revisit" if revisit else "response", page_id, url, sha1, size, refers)
                if count > 1:
                    out.append((f"{part}-{number}", page_id, 0, 1 + count, head, running.hexdigest()))
            piece = data[k].as_py()
            running.update(piece)
            if count == 1:
                out.append((f"{part}-{number}", page_id, 0, 1, head + piece + _END, "" if revisit else running.hexdigest()))
            else:
                out.append((f"{part}-{number}", page_id, nth + 1, 1 + count, piece + _END * (nth == count - 1), running.hexdigest()))
            held += len(piece)
            if held > BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def records(pages: DataFrame, chunk: int = CHUNK, least: int = LEAST) -> DataFrame:
    """The chunk rows of an archive of ``pages(page_id, url, html)``."""
    ship(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.cast("binary").alias("html"))
    rows = rows.select("*", F.sha1("html").alias("sha1"), F.octet_length("html").cast("long").alias("size"), F.sha2("html", 256).alias("key"))
    # Payloads that occur once need no partner; only keys go into this aggregate, summed before they are dealt. Pages of one
    # payload meet its largest page_id at SALTS places.
    groups = rows.where(F.col("size") >= least).groupBy("key", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    groups = groups.select(F.col("key").alias("group_key"), F.col("size").alias("group_size"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("group_salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    typed = rows.join(groups, (F.col("key") == F.col("group_key")) & (F.col("size") == F.col("group_size")) & (F.col("salt") == F.col("group_salt")), "left")
    typed = typed.select("page_id", "url", "html", "sha1", "size", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    # A revisit has no payload. Binary substrings count bytes, from 1.
    body = F.when(F.col("refers_to").isNull(), F.col("html")).otherwise(F.lit(b""))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / chunk)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), F.col("count") - 1), lambda k: F.substring(F.col("body"), k * chunk + 1, F.lit(chunk)))
    cut = typed.withColumn("body", body).withColumn("count", count).select("page_id", "url", "sha1", "size", "refers_to", "count", F.posexplode(pieces).alias("nth", "data"))
    return cut.mapInArrow(_writer, _ROWS)


def _page(urn: str):
    text = urn[1:-1].removeprefix(_URN)
    return int(text) if text else None


class _Reader:
    """Follows one record after the other."""

    def __init__(self):
        self.name = None

    def row(self, name: str, chunk: int, chunks: int, data: bytes, digest: str):
        """Take the next row; what the record says once it is complete."""
        if chunk == 0:
            if self.name is not None:
                raise ValueError(f"record {self.name} ends early")
            block, _, data = data.partition(_END)
            self.fields, self.name, self.next, self.left = parsed(block), name, 0, None
            self.left, self.running = int(self.fields["content-length"]), hashlib.sha1()
        if name != self.name or chunk != self.next:
            raise ValueError(f"record {name}: chunk {chunk} out of order")
        self.next += 1
        if chunk == chunks - 1:
            if data[-4:] != _END:
                raise ValueError(f"record {name} has no end")
            data = memoryview(data)[:-4]
        self.running.update(data)
        self.left -= len(data)
        if digest and self.running.hexdigest() != digest:
            raise ValueError(f"record {name}: chunk {chunk} is damaged")
        if chunk < chunks - 1:
            return None
        f, self.name = self.fields, None
        sha1 = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
        if self.left or f["warc-type"] == "response" and self.running.hexdigest() != sha1:
            raise ValueError(f"record {name}: payload differs from its header")
        return _page(f["warc-record-id"]), int(f["x-payload-length"]), sha1, f["warc-type"], _page(f["warc-refers-to"]) if "warc-refers-to" in f else None


def _read(batches):
    reader = _Reader()
    for batch in batches:
        out = []
        for name, chunk, chunks, data, digest in zip(*(batch.column(x) for x in ("record", "chunk", "chunks", "data", "digest"))):
            told = reader.row(name.as_py(), chunk.as_py(), chunks.as_py(), data.as_py(), digest.as_py())
            if told:
                out.append(told)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    if reader.name is not None:
        raise ValueError(f"record {reader.name} ends early")


def read(archive: DataFrame) -> DataFrame:
    """What each record of an archive says, its payload verified. Only records of several chunks are put in order."""
    ship(archive.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    columns = archive.select("record", "chunk", "chunks", "data", "digest")
    large = columns.where("chunks > 1").repartition("record").sortWithinPartitions("record", "chunk")
    return columns.where("chunks = 1").mapInArrow(_read, schema).union(large.mapInArrow(_read, schema))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages`` into the shared folder and read it back."""
    return read(durable(records(pages), "warc"))
