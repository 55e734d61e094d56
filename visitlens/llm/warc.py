"""WARC archives: write pages as captures, read archives, assemble captures again.

Each page becomes a request, a response (or a revisit of an equal payload) and a metadata record;
request and metadata name the response in WARC-Concurrent-To. Spark's text writer
puts the records into gzip files, in any store it can write; how many a file takes follows from the payloads'
mean size, so that files hold about ``FILE_BYTES``, or one page that is larger. (A file is one gzip member.)
Archives are unzipped and parsed as a stream with the lengths the records state, so payloads may hold
anything, and rows go on in batches of bounded bytes; records are then joined through their concurrent-to
identifiers into one nested row per capture.

Of equal payloads of at least ``min_bytes`` bytes the smallest page_id (then the first
locator) is the response.

Defined cases: a null html is an empty payload; a null page_id comes back as null and counts as
the smallest; a null url is left out; equal rows are captures of their own; no pages give no
captures. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.common import located, on_workers
from visitlens.session import cut_lineage, shared_folder

DATE = "2024-01-01T00:00:00Z"
#: Payload bytes of a file, records of a file at most, and payload bytes of a batch of rows read.
FILE_BYTES = 64 << 20
MOST_RECORDS = 30_000
BATCH_BYTES = 16 << 20
STEP = 1 << 20
PLACE = ["_file", "_row"]
CRLF = "\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def payload_prints(pages: DataFrame) -> DataFrame:
    """page_id, locator, digest and size of the payloads of located pages, stored."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return cut_lineage(pages.select("page_id", *PLACE, F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size")))


def revisited(prints: DataFrame, min_bytes: int) -> DataFrame:
    """Locator of each located page with the locator of the page that carries its payload."""
    first = prints.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(
        F.min(F.struct("page_id", *PLACE)).alias("first")
    )
    first = first.select(F.col("digest").alias("_d"), F.col("size").alias("_n"), "first")
    met = prints.join(first, (F.col("digest") == F.col("_d")) & (F.col("size") == F.col("_n")), "left")
    own = F.struct(*PLACE)
    return met.select(
        *[F.col(c).alias(f"_at{c}") for c in PLACE],
        F.when(F.col("first").isNull(), own).otherwise(F.struct("first._file", "first._row")).alias("carrier"),
    )


def _record_id(place: tuple, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place[0]}#{place[1]}#{kind}')}>"


def _record(kind: str, record_id: str, fields: list[tuple[str, object]], block: str, mime: str) -> str:
    """A record without its last line break, which the writer adds."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *fields]
    head += [("Content-Type", mime), ("Content-Length", len(block.encode("utf-8", "surrogatepass")))]
    lines = "".join(f"{k}: {v}{CRLF}" for k, v in head if v is not None)
    return f"WARC/1.1{CRLF}{lines}{CRLF}{block}{CRLF}"


def page_records(page_id, url, html, place: tuple, carrier: tuple) -> list[str]:
    """Request, response or revisit, and metadata of one page."""
    html = html or ""
    payload = html.encode("utf-8", "surrogatepass")
    target = None if url is None else " ".join(url.split())
    response = _record_id(place, "response")
    together = [("WARC-Target-URI", target), ("WARC-Concurrent-To", response)]
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}"
    about = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    mime = "application/http; msgtype=response"
    if carrier == place:
        answer = _record("response", response, about, http + html, mime)
    else:
        about += [("WARC-Refers-To", _record_id(carrier, "response")),
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        answer = _record("revisit", response, about, http, mime)
    get = f"GET {target or '/'} HTTP/1.1{CRLF}{CRLF}"
    request = _record("request", _record_id(place, "request"), together, get, "application/http; msgtype=request")
    known = "" if page_id is None else f"page-id: {page_id}{CRLF}"
    metadata = _record("metadata", _record_id(place, "metadata"), together, known, "application/warc-fields")
    return [request, answer, metadata]


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write page_id, url and html of pages as gzip archives."""
    pages = located(on_workers(pages), "page_id", "url", "html")
    prints = payload_prints(pages)
    carriers = revisited(prints, min_bytes)
    met = pages.join(carriers, (F.col("_file") == F.col("_at_file")) & (F.col("_row") == F.col("_at_row")))
    met = met.select("page_id", "url", "html", *PLACE, "carrier")

    def records(batches):
        lines: list[str] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                page_id, url, html, file, at, carrier = (x.as_py() for x in row)
                lines += page_records(page_id, url, html, (file, at), (carrier["_file"], carrier["_row"]))
                held += len(html or "")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                    lines, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    mean = prints.agg(F.avg("size")).first()[0] or 0
    per_file = int(min(MOST_RECORDS, max(3, 3 * (FILE_BYTES // (mean + 1_000)))))
    out = met.mapInArrow(records, "value string").write.option("lineSep", CRLF).option("compression", "gzip")
    out.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", per_file).text(folder)


def split_records(pieces: Iterable[bytes]):
    """(headers, block) of each record of an unzipped archive that comes in pieces; header names in lower case.

    No more than a record and a piece are held.
    """
    pieces, held, place = iter(pieces), bytearray(), 0

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while (blank := len(held) - len(held.lstrip(b"\r\n"))) == len(held):
            place += blank
            held.clear()
            if not more():
                return
        del held[:blank]
        place += blank
        searched = 0
        while (end := held.find(b"\r\n\r\n", searched)) < 0:
            if len(held) >= 5 and not held.startswith(b"WARC/"):
                break
            searched = max(0, len(held) - 3)
            if not more():
                break
        lines = bytes(held[: max(end, 0)]).decode("utf-8", "replace").split(CRLF)
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {place}")
        headers: dict[str, str] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        stop = end + 4 + int(headers["content-length"])
        while len(held) < stop:
            if not more():
                raise ValueError("the archive ends within a record")
        yield headers, bytes(held[end + 4 : stop])
        del held[:stop]
        place += stop


def unzip(data: bytes | pa.Buffer, step: int = STEP) -> Iterator[bytes]:
    """Content of all gzip members in pieces of bounded size; plain data as it is."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield from (bytes(view[at : at + step]) for at in range(0, len(view), step))
        return
    at, member = 0, zlib.decompressobj(31)
    rest = b""
    while rest or at < len(view):
        if not rest:
            rest, at = bytes(view[at : at + step]), at + step
        if member.eof:
            member = zlib.decompressobj(31)
        piece = member.decompress(rest, step)
        rest = member.unconsumed_tail or member.unused_data
        if piece:
            yield piece
    while not member.eof and (piece := member.decompress(member.unconsumed_tail, step)):
        yield piece


RECORD = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("id", T.StringType()), ("type", T.StringType()), ("concurrent_to", T.StringType()), ("refers_to", T.StringType()),
            ("target_uri", T.StringType()), ("date", T.StringType()), ("page_id", T.LongType()), ("payload", T.BinaryType()),
            ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()),
        )
    ]
)


def _parsed(headers: dict[str, str], block: bytes) -> tuple:
    kind, payload, size, digest, page_id = headers.get("warc-type"), block, len(block), None, None
    if kind in ("response", "revisit") and block.startswith(b"HTTP/"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
    if kind == "revisit":
        named = dict(x.lower().split(": ", 1) for x in head.decode("latin-1").split(CRLF)[1:] if ": " in x)
        size, payload = int(named["content-length"]), None
        digest = headers["warc-payload-digest"].rpartition(":")[2]
    elif kind == "response":
        digest = base32_sha1(payload)
        if digest != headers["warc-payload-digest"].rpartition(":")[2]:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    elif kind == "metadata":
        fields = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split(CRLF) if ": " in x)
        page_id = int(fields["page-id"]) if "page-id" in fields else None
    return (
        headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
        headers.get("warc-target-uri"), headers.get("warc-date"), page_id, payload, size, digest,
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives of a folder."""
    fields = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.int64(), pa.string()]

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in split_records(unzip(content.as_buffer())):
                    rows.append(_parsed(headers, block))
                    held += len(block)
                    if held >= BATCH_BYTES:
                        yield as_batch(rows)
                        rows, held = [], 0
                yield as_batch(rows)

    def as_batch(rows):
        columns = zip(*rows) if rows else [[]] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields)], names=RECORD.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return on_workers(files).mapInArrow(parse, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), ``request`` and ``metadata``."""
    main = records.where(F.col("type").isin("response", "revisit"))
    main = main.select(F.col("id"), F.struct(*RECORD.names).alias("response"))
    out = main
    for kind in ("request", "metadata"):
        side = records.where(F.col("type") == kind).select(
            F.col("concurrent_to").alias(f"_{kind}"), F.struct("id", "target_uri", "date", "page_id").alias(kind)
        )
        out = out.join(side, F.col("id") == F.col(f"_{kind}"), "left").drop(f"_{kind}")
    return out


def digest(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back and give one row per page."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4()}"
    write_archives(pages, folder)
    rows = captures(read_records(spark, folder)).select(
        "id", F.col("metadata.page_id").alias("page_id"), "response.payload_bytes", "response.payload_digest",
        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("_to"),
    )
    targets = rows.where(F.col("record_type") == "response").select(F.col("id").alias("_id"), F.col("page_id").alias("refers_to"))
    out = rows.join(targets, F.col("_to") == F.col("_id"), "left")
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
n AS (SELECT *, [strpos('0123456789abcdef', substr(hex, i, 1)) - 1 for i in range(1, 41)] AS nibbles FROM p),
d AS (
  SELECT page_id, payload_bytes, html,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((nibbles[(5 * i) // 4 + 1] * 16 + nibbles[(5 * i) // 4 + 2]) >> (3 - (5 * i) % 4)) & 31)::INT, 1)
           for i in range(0, 32)], '') AS payload_digest
  FROM n),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
