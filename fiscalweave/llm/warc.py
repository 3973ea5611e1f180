"""WARC archives: one gzip member per record, and a reader that splits archives at any byte."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalweave.llm.store import Scratch
from fiscalweave.sources.sinks import shared_dir

#: Bytes of an archive that one task reads, bytes of an archive before the next one is begun, bytes
#: of payload in one Arrow batch.
SPLIT, ARCHIVE, BATCH = 32 << 20, 1 << 30, 8 << 20
#: A payload with more than this share of the rows is looked up by broadcast; at most 1/share are.
HOT_SHARE = 0.002
#: Bytes that the headers of a record may take.
HEADERS = 1 << 16
MAGIC = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str):
    """(file system, path) of a place that tasks on all executors see: a path or URI of a shared
    mount, HDFS or an object store."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith(("s3a:", "s3n:")):
        uri = "s3" + uri[3:]
    return (pafs.LocalFileSystem(), uri) if "://" not in uri else pafs.FileSystem.from_uri(uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- one record ----------------------------------------------------------------------------------


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None,
           date: str) -> bytes:
    """The gzip member of one record. A revisit keeps the HTTP headers and leaves out the body."""
    name = f"urn:page:{page}"
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    heads = [("WARC-Type", "response" if refers_to is None else "revisit"),
             ("WARC-Record-ID", f"<{name}>"),
             ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,-./:;=?@[]_~") if url else name),
             ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
             ("Content-Type", "application/http;msgtype=response"),
             ("Content-Length", str(len(block)))]
    if refers_to is not None:
        heads[2:2] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(text.encode() + block + b"\r\n\r\n") + press.flush()


class Ranges:
    """Random reads of a file through one window of bytes."""

    def __init__(self, file, size: int, window: int = 1 << 20):
        self.file, self.size, self.window = file, size, window
        self.at, self.data = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to n bytes from ``at``; fewer where the window or the file ends, none past it."""
        if not self.at <= at < self.at + len(self.data):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(min(self.window, max(0, self.size - at)))
        lo = at - self.at
        return self.data[lo:lo + n]

    def find(self, what: bytes, lo: int, hi: int) -> int:
        """Where ``what`` begins first in [lo, hi), or -1."""
        while lo < hi:
            here = self.read(lo, self.window)
            if len(here) < len(what) and lo + len(here) < self.size:
                self.data = b""  # the window ends inside a possible match: begin the next one here
                here = self.read(lo, self.window)
            at = here.find(what)
            if at >= 0:
                return lo + at if lo + at < hi else -1
            if len(here) < len(what):
                return -1
            lo += len(here) - len(what) + 1
        return -1


def _fields(head: bytes) -> dict[str, str] | None:
    """The named fields of a record's header, or None where it is not one."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    known = fields.get("warc-type") and fields.get("content-length", "").isdigit()
    return fields if known else None


def member(source: Ranges, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """(fields, block, end) of the record whose gzip member begins at ``at``; None where the bytes
    there are no member with a record's header. A record that breaks off after it is an error."""
    inflate, out, pos, fields, body = zlib.decompressobj(31), bytearray(), at, None, 0
    while not inflate.eof:
        piece = source.read(pos, 1 << 16)
        try:
            out += inflate.decompress(piece)
        except zlib.error as error:
            if fields is None:
                return None
            raise ValueError(f"broken record at byte {at}: {error}") from error
        pos += len(piece)
        if fields is None:
            if not b"WARC/".startswith(bytes(out[:5])):
                return None
            cut = out.find(b"\r\n\r\n")
            if cut >= 0:
                fields, body = _fields(bytes(out[:cut])), cut + 4
            if fields is None and (cut >= 0 or len(out) > HEADERS or inflate.eof):
                return None
        if not piece and not inflate.eof:
            if fields is None:
                return None
            raise ValueError(f"record at byte {at} breaks off")
    length = int(fields["content-length"])
    if len(out) < body + length:
        raise ValueError(f"record at byte {at} is shorter than it says")
    return fields, bytes(out[body:body + length]), pos - len(inflate.unused_data)


def records(source: Ranges, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, block) of the records that begin in [start, end).

    The range is searched for gzip magic; a candidate counts when a record's header can be decoded
    from it. From then on each record begins where the last one ended, read past ``end`` if need
    be, so only the first one of a range is found by search.
    """
    pos = start
    while (at := source.find(MAGIC, pos, end)) >= 0:
        found = member(source, at)
        if found is None:
            pos = at + 1
            continue
        fields, block, pos = found
        yield at, fields, block


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """(payload, its full length): the body of an HTTP message, else the whole block."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    said = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
    if fields["warc-type"] == "revisit":
        return b"", int(said.group(1)) if said else 0
    return body, len(body)


# -- tables --------------------------------------------------------------------------------------


def with_originals(pages: DataFrame, scratch: Scratch, payload: Column, least: int = 0,
                   id_col: str = "page_id") -> DataFrame:
    """(page, url, payload, refers_to): the smallest page with the same payload, null for that one.

    Payloads are compared by length and SHA-256. They are counted after a map-side combine; those
    with many copies are looked up in a broadcast table of at most 1/``HOT_SHARE`` rows, the
    others by a join in which no key is hot. Payloads below ``least`` bytes refer to nothing.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col("url").cast("string"),
                        payload.alias("payload")).withColumn(
        "mark", F.concat(F.unhex(F.sha2("payload", 256)),
                         F.unhex(F.lpad(F.hex(F.octet_length("payload")), 16, "0"))))
    counted = scratch.write(
        rows.filter(F.octet_length("payload") >= least).groupBy("mark")
        .agg(F.count("*").alias("n"), F.min("page").alias("first")).filter("n > 1"), "copies")
    bar = max(2, int(pages.count() * HOT_SHARE))
    hot = F.broadcast(counted.filter(F.col("n") > bar).select("mark", F.col("first").alias("hot")))
    cold = counted.filter(F.col("n") <= bar).select(F.col("mark").alias("key"), "first")
    # Rows of hot payloads take a key of their own, which spreads them and matches nothing.
    spread = F.concat(F.encode(F.lit("row:"), "UTF-8"), F.unhex(F.hex(F.xxhash64(
        F.monotonically_increasing_id()))))
    marked = rows.join(hot, "mark", "left").withColumn(
        "key", F.when(F.col("hot").isNull(), F.col("mark")).otherwise(spread))
    original = F.coalesce("hot", "first")
    return marked.join(cold, "key", "left").select(
        "page", "url", "payload",
        F.when(~F.col("page").eqNullSafe(original), original).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, scratch: Scratch,
                   date: str = "1970-01-01T00:00:00Z", size: int = ARCHIVE) -> DataFrame:
    """Write (page, url, payload, refers_to) as archives; returns (file, bytes, records).

    A task writes its rows to files with names of its own and returns their names, so the files
    of an attempt that is lost or runs twice are not listed. A new file begins after ``size``
    bytes. A row is compressed and written before the next one is looked at.
    """
    def write(batches):
        files, out, at, count, path = [], None, 0, 0, ""
        store, root = opened(folder)

        def close():
            if out is not None:
                out.close()
                files.append((path, at, count))

        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "payload", "refers_to")]
            for page, url, payload, first in zip(*columns, strict=True):
                if out is None or at >= size:
                    close()
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    at, count, path = 0, 0, f"{folder}/{name}"
                data = record(page.as_py(), url.as_py(), payload.as_py(), first.as_py(), date)
                out.write(data)
                at += len(data)
                count += 1
        close()
        yield pa.record_batch([pa.array([f[0] for f in files], pa.string()),
                               pa.array([f[1] for f in files], pa.int64()),
                               pa.array([f[2] for f in files], pa.int64())],
                              ["file", "bytes", "records"])

    return scratch.write(rows.mapInArrow(write, "file string, bytes long, records long"),
                         "archives")


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of the archives that lie in a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz")
            .option("recursiveFileLookup", "true").load(folder)
            .select(F.col("path").alias("file"), F.col("length").alias("bytes")))


READ = ("file string, offset long, record_type string, record_id string, uri string, "
        "refers_to string, payload_bytes long, payload_digest string, payload binary")


def read_archives(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """The records of archives (file, bytes), each archive read by as many tasks as it has ranges
    of ``split`` bytes.

    A task owns the records that begin inside its range, see ``records``. Returns file, offset,
    record_type, record_id, uri, refers_to, payload_bytes, payload_digest, payload. The digest is
    the upper-case base32 SHA-1 of the payload as read; a record whose own digest says otherwise is
    an error. Of a revisit, which has no payload, length and digest are those of its headers.
    Records of other types, as warcinfo, come with their whole block as payload. Bytes between
    members that are no record are passed over; no archive, or an empty one, gives no rows. Memory
    is bounded by one record and a batch of ``BATCH`` bytes.
    """
    ranges = (files.filter("bytes > 0")
              .withColumn("start", F.explode(F.expr(f"sequence(0L, bytes - 1, {int(split)}L)")))
              .select("file", "bytes", "start"))
    tasks = files.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    ranges = ranges.repartition(min(int(tasks), 100_000), F.xxhash64("file", "start"))
    return ranges.mapInArrow(_reader(split), READ)


def _reader(split: int) -> Callable:
    types = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
                       ("record_id", pa.string()), ("uri", pa.string()),
                       ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("payload", pa.binary())])

    def rows_of(file: str, size: int, start: int):
        store, path = opened(file)
        with store.open_input_file(path) as handle:
            for at, fields, block in records(Ranges(handle, size), start, min(start + split, size)):
                payload, length = payload_of(fields, block)
                said = fields.get("warc-payload-digest", "").partition(":")[2] or None
                if fields["warc-type"] != "revisit":
                    digest = sha1_base32(payload)
                    if said is not None and said != digest:
                        raise ValueError(f"{file}, byte {at}: the payload is not what was archived")
                    said = digest
                yield (file, at, fields["warc-type"], fields.get("warc-record-id", "").strip("<>"),
                       fields.get("warc-target-uri"),
                       fields.get("warc-refers-to", "").strip("<>") or None, length, said, payload)

    def read(batches):
        held, weight = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                for found in rows_of(row["file"], row["bytes"], row["start"]):
                    held.append(found)
                    weight += len(found[-1]) + 200
                    if weight >= BATCH:
                        yield _batch(held, types)
                        held, weight = [], 0
        if held:
            yield _batch(held, types)

    return read


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.types,
                                                           strict=True)], schema=types)


def archived(pages: DataFrame, folder: str | None = None, least: int = 0,
             id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             split: int = SPLIT) -> DataFrame:
    """Write pages as archives and read them back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to, uri, payload).

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest identifier
    is a response and the others are revisits that refer to it; smaller payloads are all
    responses. Digest and length are those of the full payload, the UTF-8 bytes of the page; null
    is the empty page. Rows that repeat the smallest identifier and its payload are all responses,
    and pages without identifier never win over others and stay responses among themselves. A
    revisit's payload is null. An empty table gives no rows. Other columns are not looked at.
    Archives go to ``folder`` (default: the shared folder).
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = (folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}").rstrip("/")
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    files = write_archives(with_originals(slim, scratch, payload, least), folder, scratch)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read_archives(files, split).select(
        number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", number(F.col("refers_to")).alias("refers_to"), "uri",
        F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"))

