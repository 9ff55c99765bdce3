"""Legacy ARC archives converted to WARC, and WARC archives read back.

ARC
    An archive begins with a version block: a ``filedesc`` record whose body
    names the version and the fields of the header lines that follow.
    Version 1 lines hold URL, IP address, date, type and length; version 2
    adds result code, checksum, location, offset and file name before the
    length.  A record is its header line, as many bytes as it declares, and a
    line end; nothing is searched for, lengths alone lead from one record to
    the next.

WARC
    Each ARC record gives a WARC record: an identifier made from its archive,
    offset and contents, the 14-digit date written as an ISO timestamp, the
    type from what the record is (``filedesc``: warcinfo; an HTTP message:
    response; else resource) and SHA-1 digests of block and payload.  Of
    responses with equal payloads of at least ``SMALLEST`` bytes the one with
    the largest page id is kept; the others become revisits that refer to it
    and hold the HTTP header only.

Archives are written by Spark's text writer (records are its lines, the
line separator is the format's own), so a lost task leaves no half archive,
and read as whole files of a bounded number of records.  Only digests and
decisions are shuffled, and the compressed archives once.

Null and empty pages have an empty payload.  White space in a URL is
percent-encoded; a null URL is ``about:blank``.  A null page id counts as the
smallest.  Of repeated rows one is the response.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _settings, release, scratch_path, stored

RECORDS = 1000          # per archive, version block included,
ARCHIVE_BYTES = 64 << 20  # or as many as reach these bytes
FEW = {"spark.sql.execution.arrow.maxBytesPerBatch": "16m"}  # some pages or archives at a time reach a worker
SMALLEST = 1000         # bytes of a payload worth a revisit
DATE = "20240101000000"
# The field names of the two ARC versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def unpacked(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _http(payload: bytes, page_id: int | None, content_type: str = "text/html; charset=utf-8") -> bytes:
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n"
            f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n")
    return head.encode() + payload


def _clean(url: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url) if url else "about:blank"


# ---- ARC ----------------------------------------------------------------------

def arc_header(version: int, url: str, date: str, content_type: str, length: int, status: int = 200,
               ip: str = "0.0.0.0", checksum: str = "-", offset: int = 0, name: str = "-") -> bytes:
    more = "" if version == 1 else f" {status} {checksum} - {offset} {name}"
    return f"{url} {ip} {date} {content_type}{more} {length}\n".encode()


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 kontor\n{FIELDS[version]}\n".encode()
    return arc_header(1, f"filedesc://{name}", DATE, "text/plain", len(body)) + body


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one archive: url, ip, date, content_type, status, offset, block."""
    at, version, fields = 0, None, FIELDS[1].split()
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at: end if end >= 0 else len(data)]
        if not line.strip():
            at += len(line) + 1  # the line end after a record
            continue
        # the type may hold blanks in old archives: other fields are taken from both ends
        words = line.decode("utf-8", "replace").rstrip("\r").split(" ")
        own = FIELDS[1].split() if version is None else fields
        after = len(own) - 4
        if len(words) < len(own):
            raise ValueError(f"ARC header line at byte {at} has {len(words)} fields, {len(own)} expected")
        values = dict(zip(own[:3], words[:3]), **dict(zip(own[-after:], words[-after:])))
        length, start = int(values["Archive-length"]), end + 1
        if end < 0 or start + length > len(data):
            raise ValueError(f"ARC record at byte {at} declares {length} bytes, more than there are")
        block = data[start: start + length]
        if version is None:
            if not words[0].startswith("filedesc:"):
                raise ValueError("an ARC archive begins with its version block")
            named = block.decode("utf-8", "replace").splitlines()
            version = int(named[0].split(" ")[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            fields = named[1].split(" ")
        yield {"url": values["URL"], "ip": values["IP-address"], "date": values["Archive-date"],
               "content_type": " ".join(words[3: len(words) - after]),
               "status": values.get("Result-code"), "offset": at, "block": block}
        at = start + length


def _one(archive: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["value"])


def _write(archives: DataFrame, path: str, end: str) -> None:
    """A packed file for each row ``value``, which ``end`` follows."""
    with _settings(archives.sparkSession, FEW):
        (archives.select(F.col("value").cast("string")).write.option("lineSep", end)
         .option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))


def write_arc(pages: DataFrame, path: str, records: int = RECORDS, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Legacy archives of ``pages`` (page_id, url, html), versions 1 and 2 in turn.

    An archive is closed at ``records`` records or once it has ``archive_bytes``
    bytes, so it is never larger than that and one page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, version, out, size = 0, 2, [], 0
        for batch in batches:
            for page_id, url, html in zip(*batch.columns):
                if not out:
                    version = 3 - version
                    out.append(arc_version_block(version, f"part-{n}.arc"))
                    n += 1
                payload = (html.as_py() or "").encode()
                block = _http(payload, page_id.as_py())
                check = hashlib.sha1(payload).hexdigest() if version == 2 else "-"
                out.append(arc_header(version, _clean(url.as_py()), DATE, "text/html", len(block), checksum=check) + block)
                size += len(out[-1])
                if len(out) >= records or size >= archive_bytes:
                    yield _one(b"\n".join(out))
                    out, size = [], 0
        if out:
            yield _one(b"\n".join(out))

    with _settings(pages.sparkSession, FEW):
        _write(pages.select("page_id", "url", "html").mapInArrow(run, "value binary"), path, "\n")
    return path


# ---- what a record becomes ------------------------------------------------------

def _split_http(block: bytes) -> tuple[bytes, bytes]:
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4:])


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _page_id(head: bytes) -> int | None:
    value = _headers(head).get("x-page-id", "")
    return int(value) if value else None


def record_id(archive: str, offset: int, block: bytes) -> str:
    name = f"{archive.rsplit('/', 1)[-1]} {offset} {hashlib.sha1(block).hexdigest()}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record_type(record: dict) -> str:
    if record["url"].startswith("filedesc:"):
        return "warcinfo"
    return "response" if record["block"].startswith(b"HTTP/") else "resource"


def iso_date(digits: str) -> str:
    d = (digits + DATE[len(digits):])[:14]  # short dates of old crawlers: the year's first moment
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(archive: str, record: dict, refers_to: str | None) -> bytes:
    """The equivalent WARC record, without the two line ends after it."""
    kind, block = record_type(record), record["block"]
    head, payload = _split_http(block) if kind == "response" else (b"", block)
    lines = [("WARC-Type", "revisit" if refers_to else kind),
             ("WARC-Record-ID", record_id(archive, record["offset"], block)),
             ("WARC-Date", iso_date(record["date"]))]
    if kind == "warcinfo":
        lines += [("WARC-Filename", archive.rsplit("/", 1)[-1]), ("Content-Type", "application/warc-fields")]
    else:
        lines += [("WARC-Target-URI", record["url"]), ("WARC-IP-Address", record["ip"]),
                  ("WARC-Payload-Digest", _sha1(payload)),
                  ("Content-Type", "application/http;msgtype=response" if kind == "response"
                   else record["content_type"])]
    if refers_to:
        lines += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
        block = head
    lines += [("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, led by the declared lengths."""
    at = 0
    while at < len(data):
        if data.startswith(b"\r\n", at):
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        headers = _headers(data[at:end])
        length, start = int(headers["content-length"]), end + 4
        if start + length > len(data):
            raise ValueError(f"WARC record at byte {at} declares {length} bytes, more than there are")
        block = data[start: start + length]
        if "warc-block-digest" in headers and headers["warc-block-digest"] != _sha1(block):
            raise ValueError(f"WARC record at byte {at}: the block's digest differs")
        yield headers, block
        at = start + length


# ---- the jobs ----------------------------------------------------------------

def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def revisits(archives: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """(archive, offsets, ids): records that repeat another's payload, and the record they refer to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                archive, rows = name.as_py(), []
                for r in parse_arc(unpacked(content.as_py())):
                    if record_type(r) == "response":
                        head, payload = _split_http(r["block"])
                        if len(payload) >= smallest:
                            rows.append((archive, r["offset"], hashlib.sha1(payload).digest(), len(payload),
                                         _page_id(head), record_id(archive, r["offset"], r["block"])))
                cols = list(zip(*rows)) or [()] * 6
                kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 names=["archive", "offset", "digest", "length", "page_id", "id"])

    seen = stored(archives.mapInArrow(run, "archive string, offset long, digest binary, length long, "
                                           "page_id long, id string"), "payloads")
    kept = (seen.groupBy("digest", "length")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "id")).alias("kept")).filter("n > 1")
            .select("digest", "length", F.col("kept.id").alias("refers_to")))
    out = (seen.join(kept, ["digest", "length"]).filter("id <> refers_to").groupBy("archive")
           .agg(F.collect_list("offset").alias("offsets"), F.collect_list("refers_to").alias("ids")))
    out.stored_at = seen.stored_at  # to be released once the rows are read
    return out


def convert(spark: SparkSession, arc_path: str, warc_path: str, smallest: int = SMALLEST) -> str:
    """ARC archives under ``arc_path`` as WARC archives under ``warc_path``, one for one.

    A worker holds an archive at a time, unpacked; one of more than 2 GB packed is refused.
    """
    archives = _archives(spark, arc_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content, offsets, ids in zip(*batch.columns):
                refers = dict(zip(offsets.as_py() or [], ids.as_py() or []))
                out = [warc_record(archive.as_py(), r, refers.get(r["offset"]))
                       for r in parse_arc(unpacked(content.as_py()))]
                if out:
                    yield _one(b"\r\n\r\n".join(out))

    with _settings(spark, FEW):
        again = revisits(archives, smallest)
        _write(archives.join(again, "archive", "left").select("archive", "content", "offsets", "ids")
               .mapInArrow(run, "value binary"), warc_path, "\r\n\r\n")
    release(again)
    return warc_path


READ = ("record_id string, record_type string, target_uri string, date string, page_id long, payload_bytes long, "
        "payload_digest string, refers_to_id string")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit; every block is checked against its digest,
    every response's payload against the payload digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for h, block in parse_warc(unpacked(content.as_py())):
                    kind = h["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    head, payload = _split_http(block)
                    if kind == "response" and h["warc-payload-digest"] != _sha1(payload):
                        raise ValueError(f"{h['warc-record-id']}: the payload's digest differs")
                    declared = int(_headers(head).get("content-length", len(payload)))
                    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    rows.append((h["warc-record-id"], kind, h["warc-target-uri"], h["warc-date"], _page_id(head),
                                 declared, digest, h.get("warc-refers-to")))
                cols = list(zip(*rows)) or [()] * 8
                kinds = [pa.int64() if n in ("page_id", "payload_bytes") else pa.string() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return _archives(spark, path).mapInArrow(run, READ)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written as ARC, converted to WARC, and read back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    convert(spark, write_arc(pages, arc), warc)
    with _settings(spark, FEW):
        rows = stored(read_warc(spark, warc), "warc_rows")
    result = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    responses, again = (rows.filter(F.col("record_type") == kind) for kind in ("response", "revisit"))
    named = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    # only revisits are joined: all responses would share one key, null
    return (responses.withColumn("refers_to", F.lit(None).cast("long")).select(*result)
            .unionByName(again.join(named, "refers_to_id", "left").select(*result)))
