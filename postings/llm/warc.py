"""Legacy ARC archives converted to WARC.

ARC files come in two header versions, named by the number in their first record: version 1 lines hold URL,
address, date, type and length; version 2 lines hold also result code, checksum, location, offset and file name.
The converter takes the declared length of each record, not its content, to find the next one, and gives each a WARC
identifier (from file and offset, so reruns agree), an ISO date, a record type and SHA-1 digests. Of records
with equal payloads one is kept as ``response``; the others become ``revisit`` records that refer to it.

Archives are written by Spark's text writer, one record per value and the record's end as line
separator, so tasks commit like any other write, and read whole by ``binaryFile``: keep ``records_per_file``
such that a file fits in a task. Payloads are UTF-8 here. Null payloads are empty, null URLs become
``about:blank``, white space in URLs is percent-encoded. Rows with equal ids are told apart by record identifier.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm.common import stored

#: Records per archive file.
PER_FILE = 5_000
CRLF = "\r\n"
# Fixed values of the formats.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"


# ---- ARC -----------------------------------------------------------------------------------


def arc_record(row_id: Column, url: Column, payload: Column, version: int, date: str = "20240131000000") -> Column:
    """One ARC record with an HTTP response that carries the row's id."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit(f"{PAGE_HEADER}: "), row_id.cast("string"), F.lit(CRLF)), F.lit("")),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    size = (F.octet_length(head) + F.octet_length(body)).cast("string")
    address = F.regexp_replace(F.coalesce(F.nullif(url, F.lit("")), F.lit("about:blank")), r"\s", "%20")
    middle = "text/html" if version == 1 else "text/html 200 - - 0 archive.arc"
    return F.concat(F.concat_ws(" ", address, F.lit(f"0.0.0.0 {date} {middle}"), size), F.lit("\n"), head, body)


def _file_head(version: int) -> str:
    text = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n"
    middle = "text/plain" if version == 1 else "text/plain 200 - - 0 archive.arc"
    return f"filedesc://archive.arc 0.0.0.0 20240131000000 {middle} {len(text)}\n{text}"


def write_arc(pages: DataFrame, root: str, version: int, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", per_file: int = PER_FILE) -> None:
    """Archive files of one header version; each starts with its own file record."""
    head = _file_head(version)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if not left:  # the writer starts a file here
                    yield pa.RecordBatch.from_arrays([pa.array([head], batch.schema.field(0).type)], schema=batch.schema)
                    left = per_file
                part = batch.slice(at, min(left, batch.num_rows - at))
                yield part
                at += part.num_rows
                left -= part.num_rows

    records = pages.select(arc_record(F.col(id_col), F.col(url_col), F.col(html_col), version).alias("value"))
    split = records.mapInArrow(lead, "value string")
    # The writer's own count includes the file record.
    split.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", per_file + 1).text(root)


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, content) of each record after the file record."""
    names: tuple[str, ...] | None = None
    at = 0
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):  # record separators
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"header line without end at {at}")
        parts = data[at:end].decode("utf-8", "surrogateescape").strip().split(" ")
        size = int(parts[-1])
        content = data[end + 1:end + 1 + size]
        if len(content) < size:
            raise ValueError(f"record at {at} is cut short")
        if parts[0].startswith("filedesc:"):
            version = int(content.split(None, 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"version {version} is not known")
            names = ARC_FIELDS[version]
        else:
            if names is None:
                raise ValueError("no file record")
            yield at, _fields(parts, names, at), content
        at = end + 1 + size


def _fields(parts: list[str], names: tuple[str, ...], at: int) -> dict[str, str]:
    """Header fields by name. URLs and content types of old archives hold blanks: the date, which has 14 digits and an address
    before it, tells where the URL ends; the fields behind the content type are counted from the end."""
    tail = len(names) - 4
    dates = [k for k in range(2, len(parts) - tail) if re.fullmatch(r"\d{14}", parts[k])]
    if not dates:
        raise ValueError(f"no header fields {' '.join(names)} at {at}")
    date = next((k for k in dates if re.fullmatch(r"[\d.]+|[0-9A-Fa-f:]*:[0-9A-Fa-f:.]*", parts[k - 1])), dates[0])
    end = len(parts) - tail
    return dict(zip(names, [" ".join(parts[:date - 1]), parts[date - 1], parts[date], " ".join(parts[date + 1:end]), *parts[end:]]))


def split_http(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower case), raw head, body of a stored HTTP message; no head if there is none."""
    if not content.startswith(b"HTTP/"):
        return {}, b"", content
    end = content.find(b"\r\n\r\n")
    cut = len(content) if end < 0 else end + 4
    lines = content[:cut].decode("utf-8", "replace").split(CRLF)[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}
    return fields, content[:cut], content[cut:]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def iso_date(stamp: str) -> str:
    """14-digit (or shorter) ARC date as a WARC date."""
    d = (stamp + "19700101000000"[len(stamp):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_RECORD = "record_id string, page string, url string, date string, payload_digest string, payload_bytes bigint"


def _gunzip(data: bytes) -> bytes:
    import zlib

    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        one = zlib.decompressobj(31)
        out.append(one.decompress(data))
        data = one.unused_data
    return b"".join(out)


def _chunks(rows: Iterator[tuple], names: list[str], types: list, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of rows, ended by size so that long payloads do not gather."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes))) + 64
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def read_arc(spark: SparkSession, roots: list[str], with_content: bool = True) -> DataFrame:
    """Records of all archives: identifier, page id text, URL, ISO date, digest and size of the payload, and as bytes, of
    whatever kind, the HTTP head and the whole message."""
    names = ["record_id", "page", "url", "date", "payload_digest", "payload_bytes"] + ["head", "message"] * with_content
    types = [pa.string()] * 5 + [pa.int64()] + [pa.binary()] * 2 * with_content

    def rows(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                name = path.as_py().rsplit("/", 2)[-2:]
                for at, head, message in parse_arc(_gunzip(content.as_py())):
                    fields, http, body = split_http(message)
                    record = uuid.uuid5(uuid.NAMESPACE_URL, f"{'/'.join(name)}#{at}")
                    # A blank or a byte that is no UTF-8 cannot stand in a header line of the new format.
                    url = re.sub(r"\s", "%20", head["URL"].encode("utf-8", "surrogateescape").decode("utf-8", "replace"))
                    row = (f"<urn:uuid:{record}>", fields.get(PAGE_HEADER.lower()), url, iso_date(head["Archive-date"]), digest(body), len(body))
                    yield (*row, http, message) if with_content else row

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(roots).select("path", "content")
    return files.mapInArrow(lambda b: _chunks(rows(b), names, types), _RECORD + ", head binary, message binary" * with_content)


# ---- WARC ----------------------------------------------------------------------------------


def warc_record(kind: Column, r: dict[str, Column], refers: Column, refers_url: Column, refers_date: Column) -> Column:
    """One WARC 1.1 record. Revisits keep the HTTP head and drop the payload."""
    block = F.when(kind == "revisit", r["head"]).otherwise(r["message"])
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
    only = lambda value: F.when(kind == "revisit", value)
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", r["record_id"]), line("WARC-Date", r["date"]),
        line("WARC-Target-URI", r["url"]), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), r["payload_digest"])),
        line("WARC-Refers-To", only(refers)), line("WARC-Refers-To-Target-URI", only(refers_url)), line("WARC-Refers-To-Date", only(refers_date)),
        line("WARC-Profile", only(F.lit(REVISIT_PROFILE))), F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block.cast("string"))  # the bytes as they are


def convert(spark: SparkSession, arc_roots: list[str], warc_root: str, least_bytes: int = 0, per_file: int = PER_FILE) -> None:
    """ARC files to WARC files. Of equal payloads of ``least_bytes`` or more, the record with the largest
    numeric page id (then record id) is the response.

    Copies are counted on digests alone; payloads are shuffled once, by record.
    """
    known = stored(read_arc(spark, arc_roots, with_content=False), "arc-records")
    order = F.struct(F.expr("try_cast(page AS BIGINT)").alias("n"), "record_id", "url", "date")
    shared = known.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.max(order).alias("best"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    links = known.join(shared, ["payload_digest", "payload_bytes"]).filter(F.col("record_id") != F.col("best.record_id")).select(
        F.col("record_id"), F.col("best.record_id").alias("to"), F.col("best.url").alias("to_url"), F.col("best.date").alias("to_date"))
    rows = read_arc(spark, arc_roots).join(links, "record_id", "left")
    kind = F.when(F.col("to").isNull(), "response").otherwise("revisit")
    record = warc_record(kind, {c: F.col(c) for c in rows.columns}, F.col("to"), F.col("to_url"), F.col("to_date"))
    rows.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(warc_root)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record."""
    at = 0
    while at < len(data):
        if data[at:at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        lines = data[at:end].decode("utf-8", "replace").split(CRLF)[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at {at} is cut short")
        yield fields, block
        at = end + 4 + size


def read_warc(spark: SparkSession, root: str, with_payload: bool = False) -> DataFrame:
    """Records of all files; size and digest of a response are those of the payload read, of a revisit null and as declared."""
    names = ["record_id", "record_type", "page", "url", "refers", "payload_digest", "payload_bytes"] + ["payload"] * with_payload
    types = [pa.string()] * 6 + [pa.int64()] + [pa.binary()] * with_payload

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                for fields, block in parse_warc(_gunzip(content.as_py())):
                    http, _, body = split_http(block)
                    kept = fields["warc-type"] == "response"
                    declared = re.sub("^sha1:", "", fields.get("warc-payload-digest", ""))
                    row = (fields["warc-record-id"], fields["warc-type"], http.get(PAGE_HEADER.lower()), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
                           digest(body) if kept else declared, len(body) if kept else None)
                    yield (*row, body) if with_payload else row

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(root).select("content")
    schema = "record_id string, record_type string, page string, url string, refers string, payload_digest string, payload_bytes bigint"
    return files.mapInArrow(lambda b: _chunks(rows(b), names, types), schema + ", payload binary" * with_payload)


def page_report(records: DataFrame) -> DataFrame:
    """Per record of ``read_warc``: page id, size and digest of the full payload, type, page referred to."""
    number = lambda c: F.expr(f"try_cast({c} AS BIGINT)")
    same = [number("page").alias("page_id"), "payload_digest", "record_type"]
    kept = records.filter("record_type = 'response'")
    to = kept.select(F.col("record_id").alias("refers"), F.col("page").alias("to_page"), F.col("payload_bytes").alias("full"))
    again = records.filter("record_type = 'revisit'").drop("payload_bytes").join(to, "refers", "left")
    return kept.select(*same, "payload_bytes", F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        again.select(*same, F.col("full").alias("payload_bytes"), number("to_page").alias("refers_to")))
