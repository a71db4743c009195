"""Write pages as WARC archives and read them back, putting segmented records together.

A payload is written once, by the page with the smallest id; pages with an equal payload refer to
it by a revisit record. HTTP blocks are chunked; a block longer than ``SEGMENT_BYTES`` is cut into a
response record and continuation records, which name the first one's id and their number, the last
one also the total length. Segments of a record may stand in different archives.

The archives are files in a shared folder, written by Spark; one row of the text writer is a record,
and the blank lines between records are its separator. A file has at most ``RECORDS_PER_FILE``
records, so its size is bounded. Reading takes whole files, finds records by their length,
brings the segments of an origin together in order of their numbers, checks the total length and
undoes the chunks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

CHUNK_BYTES = 8 << 10
SEGMENT_BYTES = 32 << 10
RECORDS_PER_FILE = 512
RESPONSE, REVISIT, CONTINUATION = "response", "revisit", "continuation"
BETWEEN = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken or ends early."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        parts.append(body[at : at + size])
        at += size + 2


def _header(kind: str, record_id: str, length: int, fields: dict[str, object]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {length}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def _target(url: str | None) -> str | None:
    """An address on one line; line ends would break the header."""
    return None if url is None else " ".join(url.split())


def response_records(
    record_id: str, page: str, url: str | None, payload: bytes, segment_bytes: int
) -> Iterator[bytes]:
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    )
    cuts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    about = {
        "WARC-Target-URI": _target(url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "X-Page": page,
    }
    first = about | ({"WARC-Segment-Number": 1} if len(cuts) > 1 else {})
    yield _header(RESPONSE, record_id, len(cuts[0]), first) + cuts[0]
    for i, part in enumerate(cuts[1:], 2):
        fields = {
            "WARC-Target-URI": _target(url),
            "WARC-Segment-Origin-ID": f"<{record_id}>",
            "WARC-Segment-Number": i,
            "WARC-Segment-Total-Length": len(block) if i == len(cuts) else None,
        }
        yield _header(CONTINUATION, f"{record_id}:{i}", len(part), fields) + part


def revisit_record(
    record_id: str, page: str, url: str | None, digest: str, length: int, refers_to: str, original: str
) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Length: {length}\r\n\r\n".encode()
    fields = {
        "WARC-Target-URI": _target(url),
        "WARC-Profile": PROFILE,
        "WARC-Refers-To": f"<{refers_to}>",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page": page,
        "X-Original-Page": original,
    }
    return _header(REVISIT, record_id, len(block), fields) + block


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Archives of the pages as gzip files below ``path``; one response or revisit per row.

    A null payload is an empty one. Rows repeated with the same id and payload give one response and
    revisits of it; a missing id comes after all others. Null addresses have no target header. An
    empty table gives a file without records. Other columns do not matter.
    """
    read = pages.select(
        F.col(key).cast("string").alias("page"),
        F.col(key).alias("id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    )
    narrow = read.select(
        "page", "id", "url", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1")
    )
    # Which page writes a payload, by digest; what each page writes, by page and digest.
    firsts = (
        narrow.groupBy("sha1")
        .agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id")).alias("first"))
        .select(F.col("sha1").alias("of"), F.col("first.id").cast("string").alias("first_page"))
    )
    per_page = narrow.groupBy("page", "sha1", "bytes").agg(
        F.count("*").alias("rows"), F.min("url").alias("url")
    )
    named = per_page.join(firsts, F.col("sha1") == F.col("of")).withColumn(
        "is_first", F.col("page").eqNullSafe(F.col("first_page"))
    )
    revisits = (
        named.withColumn("times", F.col("rows") - F.col("is_first").cast("int"))
        .filter("times > 0")
        .select(
            "page",
            "url",
            F.lit(None).cast("binary").alias("payload"),
            "sha1",
            "bytes",
            F.col("first_page"),
            F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("nth"),
        )
    )
    # A key without nulls: payloads are dealt to the join by it, and stay there for the window.
    writer = F.coalesce(F.concat(F.lit("page "), "page"), F.lit("none")).alias("writer")
    writers = named.filter("is_first").select(writer, "sha1")
    one = Window.partitionBy("writer", "sha1").orderBy("url")
    responses = (
        read.select("page", "url", "payload", writer, F.sha1("payload").alias("sha1"))
        .join(writers, ["writer", "sha1"])
        .withColumn("again", F.row_number().over(one))
        .filter("again = 1")
        .select(
            "page",
            "url",
            "payload",
            "sha1",
            F.lit(None).cast("long").alias("bytes"),
            F.lit(None).cast("string").alias("first_page"),
            F.lit(0).cast("long").alias("nth"),
        )
    )
    out = T.StructType([T.StructField("value", T.BinaryType())])

    def records(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in rows:
            waiting, size = [], 0
            for row in _rows(batch):
                page, sha1 = json.dumps(row["page"]), row["sha1"]
                if row["nth"] == 0:
                    made = response_records(
                        f"urn:payload:{sha1}", page, row["url"], row["payload"].as_buffer().to_pybytes(), segment_bytes
                    )
                else:
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    made = [
                        revisit_record(
                            f"urn:visit:{sha1}:{hashlib.sha1(page.encode()).hexdigest()}:{row['nth']}",
                            page, row["url"], digest, row["bytes"], f"urn:payload:{sha1}", json.dumps(row["first_page"]),
                        )
                    ]
                for record in made:
                    waiting.append(record)
                    size += len(record)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], schema=schema)
                        waiting, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(waiting, pa.binary())], schema=schema)

    (
        responses.unionByName(revisits)
        .mapInArrow(records, out)
        .select(F.col("value").cast("string"))
        .write.option("lineSep", BETWEEN)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "gzip")
        .text(path)
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows as dictionaries; the payload stays an Arrow scalar until it is used."""
    names = [n for n in batch.schema.names if n != "payload"]
    plain = zip(*[batch.column(n).to_pylist() for n in names])
    for values, payload in zip(plain, batch.column("payload")):
        yield dict(zip(names, values)) | {"payload": payload}


def records_in(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of an archive, found by their lengths."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin where the last one ends")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a block does not end where its length says")
        yield fields, archive[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page, record_type, payload, payload_bytes, payload_digest, refers_to, whole) per response or revisit.

    ``page`` and ``refers_to`` are ids as text. ``payload`` is null for revisits, whose size and digest
    are those of the full payload. ``whole`` is false, and the payload null, where a segment is missing or
    repeated with other content, the total length differs, or the digest does not fit.
    """
    raw = T.StructType.fromDDL(
        "origin string, number int, total long, type string, original string, digest string, block binary"
    )
    out = T.StructType(_READ.fields + raw.fields)

    def parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        for batch in rows:
            for content in batch.column("content"):
                found: list[dict] = []
                for fields, block in records_in(gzip.decompress(content.as_buffer())):
                    total = fields.get("WARC-Segment-Total-Length")
                    number = int(fields.get("WARC-Segment-Number", 0))
                    record = {
                        "origin": fields.get("WARC-Segment-Origin-ID") or fields["WARC-Record-ID"],
                        "number": number,
                        "total": int(total) if total else None if number else len(block),
                        "type": fields["WARC-Type"],
                        "page": json.loads(fields.get("X-Page", "null")),
                        "original": json.loads(fields.get("X-Original-Page", "null")),
                        "digest": fields.get("WARC-Payload-Digest", "sha1:")[5:],
                    }
                    if number:  # only segments travel
                        found.append(record | {"block": block})
                    else:
                        decoded = _decode(record, block, len(block))
                        found.append(dict(zip(_READ.names, decoded)) | {"number": 0})
                arrays = [pa.array([r.get(f.name) for r in found], f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    parsed = files.mapInArrow(parse, out)
    segments = (
        parsed.filter("number > 0")
        .select("page", *raw.names)
        .repartition("origin")
        .sortWithinPartitions("origin", "number")
        .mapInArrow(_assembled, _READ)
    )
    return parsed.filter("number = 0").select(*_READ.names).unionByName(segments)


_READ_ARROW = pa.schema(
    [
        ("page", pa.string()),
        ("record_type", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.string()),
        ("whole", pa.bool_()),
    ]
)
_READ = from_arrow_schema(_READ_ARROW)


def _decode(record: dict, block: bytes, total: int | None) -> tuple:
    page, digest = record["page"], record["digest"]
    head, _, body = block.partition(b"\r\n\r\n")
    if record["type"] == REVISIT:
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        return page, REVISIT, None, int(fields[b"Content-Length"]), digest, record["original"], True
    if len(block) == total:
        try:
            payload = unchunked(body) if b"\r\nTransfer-Encoding: chunked" in head else body
            if base32_sha1(payload) == digest:
                return page, RESPONSE, payload, len(payload), digest, None, True
        except ValueError:
            pass
    return page, RESPONSE, None, None, digest, None, False


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_READ_ARROW)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _READ_ARROW)]
    return pa.RecordBatch.from_arrays(arrays, schema=_READ_ARROW)


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[dict, pa.Scalar]]:
    names = [n for n in batch.schema.names if n != "block"]
    for values, block in zip(zip(*[batch.column(n).to_pylist() for n in names]), batch.column("block")):
        yield dict(zip(names, values)), block


def _assembled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of origin and number: one payload at a time is in memory."""
    first: dict | None = None
    origin, numbers, blocks, total = None, [], [], None

    def done() -> list[tuple]:
        if first is None:  # continuations without their first segment belong to no page
            return []
        complete = numbers == list(range(1, len(numbers) + 1))
        return [_decode(first, b"".join(blocks), total if complete else None)]

    for batch in rows:
        ready = []
        for record, block in _segments(batch):
            if record["origin"] != origin:
                ready += done()
                origin, numbers, blocks, total, first = record["origin"], [], [], None, None
            if numbers and record["number"] == numbers[-1] and block.as_py() == blocks[-1]:
                continue  # a segment that was archived twice
            numbers.append(record["number"])
            blocks.append(block.as_py())
            total = record["total"] if record["total"] is not None else total
            first = record if record["type"] == RESPONSE else first
        yield _batch_of(ready)
    yield _batch_of(done())
