"""WARC archives: written as one gzip member per record, read back in byte ranges.

Writing goes through Spark's text writer, whose committer keeps failed attempts out of the
folder. A task hands it whole gzip members: a member ends with the four bytes of its length, the
last of which is zero below 16 MiB, and that zero byte is given as the line separator. Longer
records end with an empty member, which is legal and ends with zeros as well.

Reading is splittable. A task takes a byte range, looks for the gzip magic from its start on,
and accepts a candidate only if the member's header decodes and its first bytes inflate to a WARC
version line. It owns the records that start inside its range and reads on past the end to finish
the last one. Bytes of an accepted record are not searched, so magic numbers inside compressed
data cost a look at most in the range that starts there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .runs import partitions

MIN_REVISIT_BYTES = 0  # fixed by the contract: equal payloads from this size on are revisits
RANGE_BYTES = 32 << 20
READ_BYTES = 1 << 20
PIECE_BYTES = 1 << 16
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"  # pages carry no date; a fixed one keeps archives reproducible
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def with_revisits(pages: DataFrame, id_col: str, html_col: str, url_col: str,
                  min_bytes: int) -> DataFrame:
    """(page, url, payload, refers_to): refers_to is set where a smaller page has the same payload.

    The smallest page of a payload is found per (digest, salt) and then per digest, so a payload
    that a third of all pages share is never one task's work; there are as many salts as shuffle
    partitions.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    salt = F.pmod(F.xxhash64("page"), F.lit(partitions(pages))).cast("int")
    rows = rows.withColumns({"digest": F.when(F.octet_length("payload") >= min_bytes,
                                              F.sha1("payload")), "salt": salt})
    salted = (rows.where("digest is not null").groupBy("digest", "salt")
              .agg(F.min("page").alias("low"), F.count("*").alias("n")))
    first = (salted.groupBy("digest").agg(F.min("low").alias("first"), F.sum("n").alias("n"),
                                          F.collect_set("salt").alias("salts"))
             .where("n > 1").select("digest", "first", F.explode("salts").alias("salt")))
    return rows.join(first, ["digest", "salt"], "left").select(
        "page", "url", "payload", F.when(F.col("page") != F.col("first"), F.col("first"))
        .alias("refers_to"))


def _uri(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http if refers_to is not None else http + payload
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_uri(page)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if url is not None:  # blanks, line breaks and other letters are percent-encoded
        head.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~|')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """`data` as a gzip member whose last byte is zero."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = z.compress(data) + z.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html",
                   url_col: str = "url", min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row below `path`, one archive per task.

    A null payload is written as an empty one, a null url without a target, a null id as `none`.
    Rows that repeat the smallest page of their payload are responses as well; a payload whose
    pages all lack an id has no revisits. Other columns are not written.
    """
    def run(batches):
        for b in batches:
            rows = zip(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays(
                [pa.array([member(record(*r))[:-1] for r in rows], pa.binary())], ["value"])

    rows = with_revisits(pages, id_col, html_col, url_col, min_bytes)
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\0").text(path))


class Stream:
    """Bytes of a file from `start` on, read as needed and forgotten when passed."""

    def __init__(self, file, start: int, size: int):
        self.file, self.base, self.size, self.held = file, start, size, bytearray()
        file.seek(start)

    def fill(self) -> bool:
        more = self.file.read(min(READ_BYTES, self.size - self.base - len(self.held)))
        self.held += more
        return bool(more)

    def drop(self, upto: int) -> None:
        """Forget what lies before position `upto` of the file, once that is worth the copy."""
        if upto - self.base >= READ_BYTES or upto - self.base == len(self.held):
            del self.held[:upto - self.base]
            self.base = upto


class Damaged(Exception):
    """A member that begins as a record, but cannot be read to its end."""


def begins(s: Stream, at: int) -> bool:
    """Whether a member at `at` inflates to the first line of a record."""
    z, out, pos = zlib.decompressobj(31), b"", at - s.base
    while len(out) < len(VERSION) and not z.eof:
        if pos >= len(s.held) and not s.fill():
            return False
        piece = s.held[pos:pos + PIECE_BYTES]
        pos += len(piece)
        try:
            out += z.decompress(piece, len(VERSION) - len(out))
        except zlib.error:
            return False
    return re.match(rb"WARC/1\.[01]\r\n", out) is not None


def inflate(s: Stream, at: int) -> tuple[bytes, int] | None:
    """The record in the member at `at` and where the member ends; None if there is none."""
    if not begins(s, at):
        return None
    z, out, pos = zlib.decompressobj(31), [], at - s.base
    while not z.eof:
        if pos >= len(s.held) and not s.fill():
            raise Damaged("the file ends within the record")
        piece = s.held[pos:pos + PIECE_BYTES]
        try:
            out.append(z.decompress(piece))
        except zlib.error as error:
            raise Damaged(str(error)) from None
        pos += len(piece)
    return b"".join(out), s.base + pos - len(z.unused_data)


def records(file, start: int, stop: int, size: int):
    """(offset, record, None) of the WARC records that start in [start, stop), and (offset, None,
    error) of those that cannot be read to their end."""
    s = Stream(file, start, size)
    at = start
    while at < stop:
        found = s.held.find(MAGIC, at - s.base)
        if found < 0:
            at = max(at, s.base + len(s.held) - len(MAGIC) + 1)
            s.drop(min(at, s.base + len(s.held)))
            if not s.fill():
                return
            continue
        at = s.base + found
        if at >= stop:
            return
        s.drop(at)
        try:
            got = inflate(s, at)
        except Damaged as error:
            yield at, None, str(error)
            got = None
        if got is None:
            at += 1
        else:
            yield at, got[0], None
            at = got[1]
            s.drop(at)


def parsed(data: bytes) -> tuple:
    """(record_type, page_id, url, payload, payload_bytes, payload_digest, refers_to) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    fields = {k.decode().lower(): v.decode() for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)", http)
    number = lambda uri: int(uri[10:-1]) if uri and uri != _uri(None) else None
    kind = fields["warc-type"]
    if kind == "response":
        digest, n = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        if fields["warc-payload-digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    else:
        digest, n, payload = fields["warc-payload-digest"][5:], int(length[1]), None
    return (kind, number(fields["warc-record-id"]), fields.get("warc-target-uri"), payload, n,
            digest, number(fields.get("warc-refers-to")))


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records below `path`, one row each, with the file and offset they start at.

    Only response and revisit records are rows; others in an archive are passed over. A record that
    cannot be read to its end, or whose payload differs from its digest, is a row of type `damaged` with
    the error, and reading goes on behind it; in all other rows `error` is null. Files are
    listed by Spark and opened by their URI, so any store that Arrow's file systems know will do.
    A payload that itself holds a whole gzipped WARC file uncompressed could be taken for records
    by a range that starts inside it; UTF-8 text cannot, since the magic is no UTF-8.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))
    ranges = files.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1,
                                             F.lit(range_bytes).cast("long"))).alias("start"))
    dealt = ranges.repartition(partitions(files), "path", "start")

    def run(batches):
        from pyarrow import fs
        for b in batches:
            for uri, size, start in zip(*(c.to_pylist() for c in b.columns)):
                store, name = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for at, data, error in records(file, start, min(start + range_bytes, size), size):
                        if error is None:
                            if not re.search(rb"(?im)^WARC-Type: (response|revisit)\r$",
                                             data.partition(b"\r\n\r\n")[0]):
                                continue
                            held += len(data)
                            try:
                                row = parsed(data)
                            except (ValueError, KeyError, TypeError) as wrong:
                                error = f"{type(wrong).__name__}: {wrong}"
                        if error is not None:
                            row = ("damaged", *[None] * 6)
                        rows.append((*row, uri, at, error))
                        if held > 16 << 20:
                            yield pa.RecordBatch.from_pylist(
                                [dict(zip(SCHEMA.names, r)) for r in rows], SCHEMA)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r)) for r in rows], SCHEMA)

    return dealt.mapInArrow(
        run, "record_type string, page_id long, url string, payload binary, payload_bytes long, "
             "payload_digest string, refers_to long, file string, offset long, error string")


SCHEMA = pa.schema([("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                    ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                    ("file", pa.string()), ("offset", pa.int64()), ("error", pa.string())])


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write `pages` as archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return read_archives(pages.sparkSession, path)
