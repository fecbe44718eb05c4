"""Legacy ARC archives to WARC, written and read by Spark's own sources.

An ARC file begins with a version block whose second line names the fields of the
record headers: five in version 1, ten in version 2. Each record is a header line,
whose last field is the declared length, and that many bytes. The converter turns
a record into a WARC one with a synthesised identifier, an ISO timestamp, a type
and SHA-256 digests of block and payload.

Of records with equal payloads of ``least_bytes`` bytes or more the one with the
smallest key becomes the response; the others become revisits without a payload.
The text writer puts bytes out as they are, so it writes the archives (gzip, any
store that Spark writes to, committed as other output is), and the binary reader
returns them. Reading goes by declared lengths, so payloads may hold anything.

Results for odd input: a null payload counts as empty. A null URL is stored as
``urn:no-url``; white space in URLs is percent-encoded. A record without a key is
written and read with a null key and is a response. Repeated rows with the
smallest key are all responses. An empty table gives empty archives and no rows.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.scratch import place

#: Field names of record headers, by version (fixed values).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_KEY = b"X-Archive-Key: "


def arc_file(records: list[tuple[int | None, str | None, bytes]], version: int, date: str, name: str = "pages.arc") -> bytes:
    """An ARC file of (key, url, payload) records as HTTP responses captured at ``date`` (14 digits)."""
    intro = f"{version} 0 millrace\n{ARC_FIELDS[version]}\n".encode()
    tail = "" if version == 1 else f"200 - - 0 {name} "
    parts = [f"filedesc://{name} 0.0.0.0 {date} text/plain {tail}{len(intro)}\n".encode(), intro]
    for key, url, payload in records:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (_KEY + str(key).encode() + b"\r\n" if key is not None else b"") + b"\r\n"
        target = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else "urn:no-url"
        extra = "" if version == 1 else f"200 {hashlib.sha256(payload).hexdigest()[:32]} - 0 {name} "
        parts += [b"\n", f"{target} 0.0.0.0 {date} text/html {extra}{len(http) + len(payload)}\n".encode("utf-8", "replace"), http, payload]
    return b"".join(parts) + b"\n"


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of an ARC file's records, without the version block.

    The version block's field line decides how headers are cut; a URL may hold
    spaces, as fields are taken from the right. A truncated record ends the file.
    """
    at, fields = 0, None
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        length = int(line.rsplit(" ", 1)[1])
        body = data[end + 1 : end + 1 + length]
        at = end + 1 + length
        if fields is None:
            version, names = body.split(b"\n", 2)[:2]
            fields = names.decode().split()
            if int(version.split()[0]) not in ARC_FIELDS or fields[-1] != "Archive-length":
                raise ValueError(f"unknown ARC version block: {body[:80]!r}")
            continue
        if len(body) < length:
            return
        yield dict(zip(fields, line.rsplit(" ", len(fields) - 1), strict=False)), body


def _split_http(body: bytes) -> tuple[bytes, bytes, int | None]:
    """HTTP header, payload, and the key that the header carries."""
    if not body.startswith(b"HTTP/"):
        return b"", body, None
    head, gap, payload = body.partition(b"\r\n\r\n")
    key = next((x[len(_KEY) :] for x in head.split(b"\r\n") if x.startswith(_KEY)), None)
    return head + gap, payload, int(key) if key is not None else None


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}:{digest}')}>"


def _b32(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode().rstrip("=")


def timestamp(date: str) -> str:
    """ISO form of an ARC date; what is missing is taken from the start of its period, an unreadable one is 1970."""
    try:
        when = datetime.strptime(date[:14] + "00000101000000"[len(date[:14]) :], "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    except ValueError:
        when = datetime(1970, 1, 1, tzinfo=UTC)
    return f"{when:%Y-%m-%dT%H:%M:%SZ}"


def warc_record(key: int | None, url: str, date: str, mime: str, http: bytes, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record with its two closing line ends; a revisit if ``refers_to`` is given."""
    digest = hashlib.sha256(payload).hexdigest()
    kind = "revisit" if refers_to is not None else "response" if http else "resource"
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key, digest)}", f"WARC-Date: {timestamp(date)}", f"WARC-Target-URI: {url}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: {_b32(block)}", f"X-Payload-Length: {len(payload)}"]
    lines += [f"X-Key: {key}"] if key is not None else []
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Key: {refers_to}"]
    lines += [f"Content-Type: {'application/http;msgtype=response' if http else mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def warc_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of the records in a stream of decompressed chunks."""
    held, at, done = bytearray(), 0, False

    def more(n: int) -> bool:
        nonlocal done, at
        while len(held) - at < n and not done:
            piece = next(chunks, None)
            if piece is None:
                done = True
            else:
                if at > 1 << 20:
                    del held[:at]
                    at = 0
                held.extend(piece)
        return len(held) - at >= n

    while more(4):
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            size = len(held) - at
            if not more(size + 1):
                raise ValueError("a WARC header is cut off")
        head = bytes(held[at:end]).decode("utf-8", "replace").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {head[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        length = int(fields["content-length"])
        offset = end + 4 - at
        if not more(offset + length + 4):
            raise ValueError("a WARC block is cut off")
        block = bytes(held[at + offset : at + offset + length])
        at += offset + length + 4
        yield fields, block


def decompressed(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Parts of plain or gzip data, of one or more members."""
    if data[:2] != b"\x1f\x8b":
        for lo in range(0, len(data), step):
            yield data[lo : lo + step]
        return
    view, at = memoryview(data), 0
    while at < len(view):
        z = zlib.decompressobj(31)
        while not z.eof and at < len(view):
            part = view[at : at + step]
            yield z.decompress(part)
            at += len(part)
        at -= len(z.unused_data)
        yield z.flush()


def to_arc(pages: DataFrame, date: str, per_file_bytes: int = 4 << 20, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Rows ``arc``: whole ARC files of about ``per_file_bytes``, versions 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, held, size = 1, [], 0
        for batch in batches:
            for key, url, body in zip(*[c for c in batch.columns], strict=True):
                payload = body.as_py() or b""
                held.append((key.as_py(), url.as_py(), payload))
                size += len(payload) + 400
                if size >= per_file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([arc_file(held, version, date)], pa.binary())], names=["arc"])
                    version, held, size = 3 - version, [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([arc_file(held, version, date)], pa.binary())], names=["arc"])

    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").cast("binary").alias("body"))
    return rows.mapInArrow(run, "arc binary")


def from_arc(files: DataFrame) -> DataFrame:
    """Records of ARC files (one binary column): key, url, date, mime, http, payload, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, body in arc_records(data.as_py()):
                    http, payload, key = _split_http(body)
                    rows.append((key, fields["URL"], fields["Archive-date"], fields["Content-type"], http, payload, hashlib.sha256(payload).hexdigest()))
                if rows:
                    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["key", "url", "date", "mime", "http", "payload", "digest"])

    return files.mapInArrow(run, "key long, url string, date string, mime string, http binary, payload binary, digest string")


def records_within(largest: int, per_file_bytes: int = 1 << 30, most: int = 5000) -> int:
    """How many records, of ``largest`` payload bytes at most, fit in a file: the binary reader can't take 2 GB at once."""
    return max(1, min(most, per_file_bytes // (largest + 8192)))


def write_warc(records: DataFrame, path: str, least_bytes: int = 100, records_per_file: int = 5000) -> None:
    """Write converted ARC records as gzip WARC archives below ``path``."""
    large = F.octet_length("payload") >= least_bytes
    firsts = records.where(large).groupBy("digest").agg(F.min("key").alias("first"))
    joined = records.join(firsts, "digest", "left")
    revisit = F.when(large & (F.col("key") != F.col("first")), F.col("first"))
    rows = joined.select("key", "url", "date", "mime", "http", "payload", revisit.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                # the writer's line separator is the record's last byte
                out = [warc_record(*(v.as_py() for v in row))[:-1] for row in zip(*part.columns, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    archive = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    archive.write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: key, type, url, date, record_id, payload (null in revisits), payload_bytes, payload_digest, refers_to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "type", "url", "date", "record_id", "payload", "payload_bytes", "payload_digest", "refers_to"]
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for f, block in warc_records(decompressed(data.as_py())):
                    if _b32(block) != f["warc-block-digest"]:
                        raise ValueError(f"damaged block of {f['warc-record-id']}")
                    kind = f["warc-type"]
                    payload = None if kind == "revisit" else _split_http(block)[1] if kind == "response" else block
                    digest = f["warc-payload-digest"].removeprefix("sha256:") if payload is None else hashlib.sha256(payload).hexdigest()
                    n = int(f["x-payload-length"]) if payload is None else len(payload)
                    rows.append((int(f["x-key"]) if "x-key" in f else None, kind, f["warc-target-uri"], f["warc-date"], f["warc-record-id"], payload, n, digest, int(f["x-refers-to-key"]) if "x-refers-to-key" in f else None))
                    size += len(block)
                    if size > 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "key long, type string, url string, date string, record_id string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def round_trip(pages: DataFrame, date: str = "20240101000000", least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Pages to ARC, ARC to WARC archives in the shared folder, and the archives' records."""
    spark = pages.sparkSession
    path = place(spark, "warc")
    largest = pages.agg(F.coalesce(F.max(F.octet_length(F.col(body_col).cast("string"))), F.lit(0))).first()[0]
    write_warc(from_arc(to_arc(pages, date, id_col=id_col, url_col=url_col, body_col=body_col)), path, least_bytes, records_within(largest))
    return read_warc(spark, path)
