"""Web archives: legacy ARC files converted to WARC, and back to rows.

``write_arc`` lays pages down as ARC files of either version; ``convert_arc``
reads any ARC files, takes the field names of their version block as the
layout of the header lines, and the declared length of each record as its
extent, and writes WARC records with what ARC lacks: record identifiers (a
name-based UUID, so a repeated task writes the same), ISO timestamps, record
types, block and payload digests.  Of records with equal payloads one becomes
a response and the others revisits that refer to it.  ``read_warc`` reads the
records back by their declared lengths and checks their digests.

Files are written by Spark's text writer into the shared folder (a record
per row, the record's last line feed being the writer's) and read by its
binary-file reader, so any file system that Spark knows will do.  A file has
``RECORDS`` records at most, and a task holds one file at a time.  Files are
compressed as a whole, not record by record.

Payloads are not shuffled: revisits are decided on digests, collected per
file (bounded by its records) and joined to the files by path.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import keep_table, read_table, slices
from tablewright.session import new_work_dir

RECORDS = 1000
DATE, ADDRESS = "19700101000000", "0.0.0.0"
# The header fields of both ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Fixed value: the profile of a revisit with the same payload.
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _write(df: DataFrame, label: str) -> str:
    path = new_work_dir(df.sparkSession, label)
    df.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS + 1).text(path)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _unpacked(content: bytes) -> bytes:
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest:  # one member or many
        d = zlib.decompressobj(31)
        out.append(d.decompress(rest))
        out.append(d.flush())
        rest = d.unused_data
    return b"".join(out)


def _field(text: str | None) -> str:
    """A value that can stand in a line of fields."""
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~") if text else "-"


def _version_block(version: int, name: str) -> str:
    body = f"{version} 0 tablewright\n{ARC_FIELDS[version]}\n"
    tail = {1: "", 2: "200 - - 0 " + name + " "}[version]
    return f"filedesc://{name} {ADDRESS} {DATE} text/plain {tail}{len(body.encode())}\n{body}"


def write_arc(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """ARC files, of either version in turn, in a new shared folder; its path.

    A record holds an HTTP response whose body is the html in UTF-8 (null:
    empty); the id travels as a header of it.
    """
    src = df.select(F.col(id_col).cast("long"), F.coalesce(F.col(html_col).cast("string"), F.lit("")),
                    F.col(url_col).cast("string")).toDF("id", "html", "url")

    def run(batches):
        from pyspark import TaskContext

        part, done, offset = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for piece in slices(batch, 1):
                out = []
                for page, html, url in zip(*(c.to_pylist() for c in piece.columns)):
                    number, nth = divmod(done, RECORDS)
                    version, name = 1 + (part + number) % 2, f"pages-{part:05d}-{number:05d}.arc"
                    if not nth:
                        out.append(_version_block(version, name))
                        offset = len(out[-1].encode()) + 1
                    payload = html.encode("utf-8", "surrogatepass")
                    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                            f"X-Page-Id: {'-' if page is None else page}\r\nContent-Length: {len(payload)}\r\n\r\n")
                    size = len(head) + len(payload)
                    fields = [_field(url), ADDRESS, DATE, "text/html"]
                    if version == 2:
                        fields += ["200", "-", "-", str(offset), name]
                    line = " ".join([*fields, str(size)]) + "\n"
                    out.append(line + head + html)
                    offset += len(line) + size + 1
                    done += 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return _write(src.mapInArrow(run, "value string"), "arc")


def arc_records(data: bytes):
    """(url, address, date, type, body) of an ARC file's records."""
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        size = int(line[-1])
        body = data[end + 1 : end + 1 + size]
        if len(body) < size:
            raise ValueError(f"ARC record of {size} bytes ends after {len(body)}")
        at = end + 1 + size
        if fields is None:
            if not line[0].startswith("filedesc:"):
                raise ValueError("no ARC version block")
            version, names = body.split(b"\n")[:2]
            if int(version.split()[0]) not in ARC_FIELDS:
                raise ValueError(f"ARC version {version!r}")
            fields = names.decode().split()
            continue
        # a URL may hold spaces in old files: what is left of the other fields
        spare = len(line) - len(fields)
        row = dict(zip(fields, [" ".join(line[: spare + 1]), *line[spare + 1 :]]))
        yield row["URL"], row["IP-address"], row["Archive-date"], row["Content-type"], body


def _split_http(body: bytes) -> tuple[bytes, bytes]:
    """Headers with their blank line, payload."""
    cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") else 0
    return body[:cut], body[cut:]


def _page_id(head: bytes) -> int | None:
    m = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(m[1]) if m else None


def _record_id(url: str, date: str, page: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {page} {digest}')}"


def _iso(date: str) -> str:
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record(kind: str, record_id: str, date: str, block: bytes, more: list[tuple[str, str]], content: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *more,
            ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Type", content),
            ("Content-Length", str(len(block)))]
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r"


def convert_arc(spark: SparkSession, arc_path: str, *, min_bytes: int = 0) -> str:
    """WARC files from the ARC files under ``arc_path``; their folder.

    Of records with equal payloads of at least ``min_bytes`` bytes the one
    with the largest page id is the response (of repeated ids, the last
    read); without an id a record ranks lowest.
    """
    def facts(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column(0)[i].as_py()
                rows = []
                for n, (url, _, date, _, body) in enumerate(arc_records(_unpacked(batch.column(1)[i].as_py()))):
                    head, payload = _split_http(body)
                    page, digest = _page_id(head), sha1_base32(payload)
                    rows.append((path, n, page, digest, len(payload), _record_id(url, date, page, digest)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate(
                        (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()))],
                    names=["path", "n", "page", "digest", "size", "record_id"])

    records = keep_table(_files(spark, arc_path).mapInArrow(
        facts, "path string, n int, page long, digest string, size long, record_id string"), "arc-records")
    equal = records.where(F.col("size") >= min_bytes)
    best = equal.groupBy("digest", "size").agg(
        F.count("*").alias("copies"),
        F.max(F.struct(F.col("page").isNotNull().alias("has"), "page", "path", "n", "record_id")).alias("best"),
    ).where("copies > 1").drop("copies")
    revisits = equal.join(best, ["digest", "size"]).where("path != best.path OR n != best.n")
    plan = revisits.groupBy("path").agg(F.collect_list(F.struct(
        "n", F.col("best.page").alias("page"), F.col("best.record_id").alias("record_id"))).alias("plan"))
    files = _files(spark, arc_path).join(plan, "path", "left")

    def convert(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                refers = {p["n"]: p for p in batch.column(2)[i].as_py() or []}
                name = batch.column(0)[i].as_py().rsplit("/", 1)[-1]
                info = f"software: tablewright\r\nformat: WARC File Format 1.0\r\nfrom: {name}\r\n".encode()
                out = [_record("warcinfo", _record_id(name, DATE, None, ""), _iso(DATE), info, [],
                               "application/warc-fields")]
                for n, (url, address, date, _, body) in enumerate(arc_records(_unpacked(batch.column(1)[i].as_py()))):
                    head, payload = _split_http(body)
                    page, digest = _page_id(head), sha1_base32(payload)
                    target = refers.get(n)
                    more = [("WARC-Target-URI", url), ("WARC-IP-Address", address),
                            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))),
                            ("X-Page-Id", "-" if page is None else str(page))]
                    if target:
                        more += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<{target['record_id']}>"),
                                 ("X-Refers-To-Page-Id", "-" if target["page"] is None else str(target["page"]))]
                    out.append(_record("revisit" if target else "response", _record_id(url, date, page, digest),
                                       _iso(date), head if target else body, more,
                                       "application/http; msgtype=response"))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])

    # the writer starts a file after RECORDS + 1 rows: a WARC file is no larger than an ARC file
    return _write(files.select("path", "content", "plan").mapInArrow(convert, "value string"), "warc")


def warc_records(data: bytes):
    """(headers, block) of a WARC file's records."""
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        at = end + 4 + size
        if at > len(data):
            raise ValueError("a WARC record ends early")
        yield head, data[end + 4 : at]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``record_id`` of responses and revisits."""
    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for head, block in warc_records(_unpacked(batch.column(0)[i].as_py())):
                    if head["WARC-Type"] not in ("response", "revisit"):
                        continue
                    if head["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
                        raise ValueError(f"{head['WARC-Record-ID']}: the block does not match its digest")
                    number = lambda k: int(head[k]) if head.get(k, "-") != "-" else None
                    digest, size = head["WARC-Payload-Digest"].split(":")[1], number("X-Payload-Length")
                    if head["WARC-Type"] == "response":
                        payload = _split_http(block)[1]
                        if sha1_base32(payload) != digest or len(payload) != size:
                            raise ValueError(f"{head['WARC-Record-ID']}: the payload does not match its digest")
                    rows.append((number("X-Page-Id"), unquote(head["WARC-Target-URI"]), size, digest,
                                 head["WARC-Type"], number("X-Refers-To-Page-Id"), head["WARC-Record-ID"]))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)],
                                                 names=list(names))

    return _files(spark, path).select("content").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, record_id string")


def archive_pages(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, those to WARC files, and these back to rows (``read_warc``).

    A null html counts as empty and a null url as "-"; repeated rows make a
    record each; a null id stays null; other columns are ignored; an empty
    table gives no rows.
    """
    spark = df.sparkSession
    return read_warc(spark, convert_arc(spark, write_arc(df, id_col=id_col, url_col=url_col, html_col=html_col),
                                        min_bytes=min_bytes))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record in the WARC files converted from ARC files."""
    return archive_pages(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Five hexadecimal digits are four letters of base 32.
OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1)),
      '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM d WINDOW w AS (PARTITION BY payload_digest, payload_bytes)
"""
