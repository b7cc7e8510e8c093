"""WARC archives: pages are written as one gzip member per record and read back in sequence."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, run_dir
from .common import small_batches

#: Payloads of at least this many bytes are written once; equal ones refer to that record.
LEAST_REVISIT = 1000
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
#: Archives are read in pieces of this many bytes.
PIECE = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A member whose header is longer than this is no record.
MOST_HEADER = 1 << 20
#: How a gzip member begins.
MEMBER = b"\x1f\x8b\x08"

READ = "record_type string, record_id string, refers_to string, target_uri string, payload_bytes bigint, payload_digest string, payload binary, error string"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _hex(digest: str | None) -> str | None:
    """Lower-case hex of a digest field."""
    name, _, value = (digest or "").partition(":")
    if name.lower() != "sha1" or not value:
        return None
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def record_id(key: str | None) -> str:
    return "<urn:page-without-id>" if key is None else f"<urn:page:{quote(key, safe='')}>"


def page_key(identifier: str | None) -> str | None:
    """The key inside a record's id."""
    found = re.fullmatch(r"<urn:page:(.*)>", identifier or "")
    return unquote(found[1]) if found else None


def record(kind: str, key: str | None, url: str | None, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record as a gzip member. A revisit holds the header of the reply, and with it the payload's length, but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(key)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block))),
    ]
    return _member(fields, block)


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join([squeeze.compress(head.encode()), squeeze.compress(block), squeeze.compress(b"\r\n\r\n"), squeeze.flush()])


def _opening() -> bytes:
    block = b"software: tallyframe\r\nformat: WARC File Format 1.1\r\n"
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))], block)


class _Framed:
    """One record as its bytes arrive: header, block of the stated length, end mark. The payload is hashed as it comes."""

    def __init__(self, keep: bool):
        self.keep, self.fields, self.head, self.left, self.error = keep, None, b"", 0, None
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.size, self.kept, self.tail, self.http = 0, [], b"", b""
        self.in_payload = False

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.head += data
            at = self.head.find(b"\r\n\r\n")
            if at < 0:
                if len(self.head) > MOST_HEADER:
                    raise ValueError("a record's header does not end")
                return
            first, *lines = self.head[:at].decode("utf-8", "replace").split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError("a member does not begin with a WARC version")
            self.fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
            length = self.fields.get("content-length", "")
            if not length.isdigit():
                raise ValueError("a record has no length")
            self.left, data, self.head = int(length), self.head[at + 4 :], b""
            self.in_payload = not self.fields.get("content-type", "").startswith("application/http")
        part, rest = data[: self.left], data[self.left :]
        self.left -= len(part)
        self.block.update(part)
        if not self.in_payload:
            self.http += part
            at = self.http.find(b"\r\n\r\n")
            part = b""
            if at >= 0:
                self.in_payload, part, self.http = True, self.http[at + 4 :], self.http[:at]
            elif len(self.http) > MOST_HEADER:
                raise ValueError("an HTTP header does not end")
        self.payload.update(part)
        self.size += len(part)
        if self.keep and part:
            self.kept.append(part)
        self.tail = (self.tail + rest)[:5]  # more than an end mark is wrong, whatever it is

    def row(self, whole: bool) -> tuple:
        fields = self.fields or {}
        kind = fields.get("warc-type")
        size, digest, error = self.size, self.payload.hexdigest(), None
        block, payload = _hex(fields.get("warc-block-digest")), _hex(fields.get("warc-payload-digest"))
        if not whole or self.left or self.fields is None:
            error = "truncated"
        elif self.tail != b"\r\n\r\n":
            error = "framing"
        elif block not in (None, self.block.hexdigest()) or (kind != "revisit" and payload not in (None, digest)):
            error = "digest"
        if kind == "revisit":
            length = re.search(rb"(?im)^content-length: *(\d+)", self.http)
            size, digest = int(length[1]) if length else None, payload
        return (
            kind, fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), size, digest,
            b"".join(self.kept) if self.keep and kind != "revisit" else None, error,
        )


def _unpacked(member, data: bytes) -> Iterator[bytes]:
    """What a member holds of ``data``, at most PIECE bytes at once however much it swells."""
    while True:
        out = member.decompress(data, PIECE)
        yield out
        data = member.unconsumed_tail
        if member.eof or not data and len(out) < PIECE:
            return


def read(pieces: Iterable[bytes], keep: bool = False) -> Iterator[tuple]:
    """Records of an archive that arrives in pieces, as tuples of ``READ``: one gzip member each.

    A record that breaks off, whose frame is wrong or whose digests differ carries an error. What is no gzip member or no
    record gives one error, and reading goes on at the next member that begins a record. ``keep``: payloads are
    returned, else only hashed.
    """
    member = framed = None
    held, again, lost = b"", b"", False
    for piece in pieces:
        data, held = held + piece, b""
        # Where to look for the next member if this one is damaged: in what came behind its beginning, PIECE bytes at least.
        again = (again + data)[-2 * PIECE :] if member else b""
        while data:
            if member is None:
                if lost:
                    at = data.find(MEMBER)
                    if at < 0:
                        held = data[-len(MEMBER) + 1 :]
                        break
                    data = data[at:]
                member, framed, again = zlib.decompressobj(31), _Framed(keep), data[1:]
            try:
                for out in _unpacked(member, data):
                    framed.feed(out)
            except (zlib.error, ValueError) as wrong:
                if not lost:
                    yield (None, None, None, None, None, None, None, str(wrong))
                data, member, lost = again, None, True
                continue
            lost = lost and framed.fields is None
            data = b""
            if member.eof:
                if not lost:
                    yield framed.row(True)
                data, member = member.unused_data, None
    if member is not None and not lost:
        yield framed.row(False)


def typed(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(key, url, payload, kind, refers_to): how each page is to be written.

    Of equal payloads of ``least`` bytes or more, those of the largest key are responses and the others
    revisits of it; a page without a key is never the largest. All other pages are responses. A null page has
    an empty payload.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = small_batches(pages).select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    large = F.when(F.length("payload") >= least, F.sha1("payload"))
    equal = rows.select("key", large.alias("digest")).where("digest is not null").groupBy("digest")
    # Few payloads are repeated as a rule: their written size lets Spark choose how to join.
    first = cut_lineage(equal.agg(F.max("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("digest", "first"))
    joined = rows.withColumn("digest", large).join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key"))
    return joined.select(
        F.col("key").cast("string").alias("key"), "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first").cast("string")).alias("refers_to"),
    )


def write(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (key, url, payload, kind, refers_to) to archives below ``folder``; the list (archive, n_records, n_bytes).

    Tasks open the folder through pyarrow, so its address must be one that pyarrow and all executors reach.
    Every attempt of a task writes files of its own names; those of the attempt that counted are in the list,
    which is written by Spark, and no others are read. Every row is a record, repeated rows too; null keys and urls leave
    their fields out, a null payload is not allowed (:func:`typed` makes it empty). No rows give no archives.
    """

    def archives(batches):
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, out, n, size = None, None, 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": f"{folder.rstrip('/')}/{name}", "n_records": n, "n_bytes": size}])

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    size += out.write(_opening())
                size += out.write(record(row["kind"], row["key"], row["url"], row["payload"], row["refers_to"]))
                n += 1
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return cut_lineage(records.mapInArrow(archives, "archive string, n_records bigint, n_bytes bigint"))


def read_archives(archives: DataFrame, keep: bool = False) -> DataFrame:
    """The records of the archives whose addresses are in the column ``archive``, as ``READ``, warcinfo left out.

    Each archive is read in sequence by one task, in pieces of ``PIECE`` bytes; payloads are only held if
    ``keep`` is set. An address that is listed twice is read twice; other columns are not read. An empty table gives no rows.
    """
    spark = archives.sparkSession
    lanes = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lanes = max(1, min(archives.count(), lanes))

    def records(batches):
        names = [f.split()[0] for f in READ.split(", ")]
        kinds = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string() for n in names]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for address in batch.column(0).to_pylist():
                files, path = pyarrow.fs.FileSystem.from_uri(address)
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for row in read(iter(lambda stream=stream: stream.read(PIECE), b""), keep):
                        if row[0] == "warcinfo":
                            continue
                        rows.append(row)
                        held += len(row[6] or b"")
                        if len(rows) >= 10_000 or held >= 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select("archive").repartition(lanes).mapInArrow(records, READ)


def roundtrip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Pages written to archives and read back: (key, payload_bytes, payload_digest, record_type, refers_to, error).

    One row per page, repeated pages and null keys included; null pages have empty payloads, and ties of equal payloads are
    settled as in :func:`typed`. Other columns are not read; an empty table gives no rows.
    """
    spark: SparkSession = pages.sparkSession
    found = read_archives(write(typed(pages, key, url, html), folder or run_dir(spark, "archives")))
    kind = dict(pages.dtypes)[key]

    plain = lambda c: F.expr(f"url_decode(regexp_extract({c}, '^<urn:page:(.*)>$', 1))")
    of = lambda c: F.when(F.col(c).startswith("<urn:page:"), plain(c)).cast(kind)
    return found.select(of("record_id").alias(key), "payload_bytes", "payload_digest", "record_type", of("refers_to").alias("refers_to"), "error")
