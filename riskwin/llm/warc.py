"""WARC archives: written from tables, read back in splits.

Every record is a gzip member of its own. Reading is splittable: a task gets a
byte range of a file, looks for the gzip magic in it, takes a candidate for a
record only if the whole member decodes (its checksum holds), starts with a
WARC version line and ends where another member or the file's end is, and owns
the records that start inside its range; the last one may end beyond it.

Of records with the same payload, the one with the smallest page id carries it
(``response``); the others refer to it (``revisit``).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.files import open_store
from riskwin.session import checkpoint_root, scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
#: Date of all records, so that the same table gives the same archives.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
#: Payload bytes of an archive, about, and bytes of a split.
ARCHIVE_BYTES = 32 << 20
SPLIT_BYTES = 2 << 20
#: Payloads under this many bytes are always written.
MIN_REVISIT_BYTES = 0
#: Bytes read at a time, and decoded of a candidate before the rest of it.
READ, PEEK = 1 << 20, 512

RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  revisit: bool, level: int = LEVEL) -> bytes:
    """One record as a gzip member. A revisit has the response's header lines
    (with the payload's length) but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_name(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def decode_record(data: bytes) -> tuple:
    """The row of a record, in the order of ``RECORDS``. Raises ValueError for a
    response whose payload hasn't its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line[16:]) for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload isn't the one that was written")
    url = fields.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return (_page(fields["WARC-Record-ID"]), url, kind, _page(fields.get("WARC-Refers-To")), length, digest,
            payload if kind == "response" else None)


class _Window:
    """Bytes of a file from a place on, read as they are needed."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.base, self.data = file, size, start, b""

    def grow(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.data += self.file.read_at(min(READ, self.size - at), at)
        return True

    def at(self, place: int, n: int) -> bytes:
        while self.base + len(self.data) < min(place + n, self.size):
            self.grow()
        return self.data[place - self.base:place - self.base + n]

    def forget(self, place: int) -> None:
        self.data, self.base = self.data[place - self.base:], place

    def member(self, place: int) -> tuple[bytes, int] | None:
        """The member that starts here and the place after it, if there is one
        that is a record."""
        packed = zlib.decompressobj(31)
        parts, at, known = [], place, False
        try:
            while not packed.eof:
                piece = self.at(at, 1 << 16)
                if not piece:
                    return None
                parts.append(packed.decompress(piece) if known else packed.decompress(piece[:PEEK]))
                at += len(piece) if known else len(piece[:PEEK])
                if not known and sum(map(len, parts)) >= len(VERSION):
                    if not b"".join(parts).startswith(VERSION):
                        return None
                    known = True
        except zlib.error:
            return None
        return (b"".join(parts), at - len(packed.unused_data)) if known else None

    def next_magic(self, place: int, stop: int) -> int | None:
        """Place of the first magic from here on that starts before ``stop``."""
        while place < stop:
            got = self.at(place, READ)
            found = got.find(MAGIC)
            if found >= 0:
                return place + found if place + found < stop else None
            if place + len(got) >= self.size:
                return None
            place += max(1, len(got) - len(MAGIC) + 1)
        return None


def read_split(file, size: int, start: int, stop: int) -> Iterator[tuple]:
    """Rows of the records that start in start..stop - 1. Where no record starts
    at the file's beginning or at the end of one of these, the bytes up to the
    next record are damaged: a ``Damage`` (from, to) in the place of a row. So
    every damaged range is found by one split, whichever it lies in."""
    window = _Window(file, size, start)
    due = 0 if start == 0 and size else None
    place: int | None = start
    while place is not None and place < stop:
        place = window.next_magic(place, stop)
        if place is None:
            break
        window.forget(place)
        record = window.member(place)
        if record is None:
            place += 1
            continue
        if due is not None and due != place:
            yield Damage(due, place)
        yield decode_record(record[0])
        due = place = record[1]
    if due is not None and due < size:
        # the next record lies in another split; it starts here or bytes are lost
        place = due
        while (place := window.next_magic(place, size)) is not None and window.member(place) is None:
            place += 1
        if place != due:
            yield Damage(due, size if place is None else place)


class Damage(NamedTuple):
    """Bytes of an archive, from a place to another, that hold no record."""

    begin: int
    end: int


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, first) where ``first`` is the smallest id
    with the same payload, null for a response.

    A null html is an empty payload. Rows that repeat the smallest id of their
    payload are all responses; rows with a null id are responses too."""
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    repeated = (
        rows.filter(F.length("payload") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("page_id").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    return rows.join(repeated, "digest", "left").withColumn("first", F.when(F.col("page_id") != F.col("first"), F.col("first")))


def _writer(folder: str, archive_bytes: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        out, name, size, payload_bytes, n = None, "", 0, 0, 0

        def listed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([n])], ["file", "bytes", "records"])

        for b in batches:
            for page_id, url, payload, first in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    # a name of its own for each attempt: only listed files count
                    name, size, payload_bytes, n = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                record = encode_record(page_id, url, payload, base32_sha1(payload), first, first is not None)
                out.write(record)
                size, payload_bytes, n = size + len(record), payload_bytes + len(payload), n + 1
                if payload_bytes >= archive_bytes:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    return task


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all rows; returns the list of archives: file, bytes, records. An
    empty table gives none. Null urls are left out of their records."""
    checkpoint_root(pages.sparkSession)
    small_batches(pages.sparkSession)
    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    rows = with_revisits(pages, id_col, url_col, html_col, min_bytes).select("page_id", "url", "payload", "first")
    return rows.mapInArrow(_writer(folder, archive_bytes), "file string, bytes long, records long").checkpoint()


def _splits(archives: DataFrame, split_bytes: int) -> DataFrame:
    splits = archives.filter("bytes > 0").select(
        "file", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"))
    return splits.repartition(max(1, min(splits.count(), 10_000)), "file", "start")


def _found(folder: str, split_bytes: int) -> Callable:
    """Reader of the splits of a batch: (file, record or damage)."""
    def found(b: pa.RecordBatch) -> Iterator[tuple[str, tuple]]:
        store, base = open_store(folder)
        for name, size, start in zip(*(b.column(i).to_pylist() for i in range(3))):
            with store.open_input_file(f"{base}/{name}") as file:
                there = file.size()
                if there < size and start == 0:
                    yield name, Damage(there, size)
                for row in read_split(file, there, start, min(there, start + split_bytes)):
                    yield name, row

    return found


def read_archives(archives: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, damaged: str = "raise") -> DataFrame:
    """All records of the listed archives (``RECORDS``), each read once, by the
    task whose range it starts in. Bytes that hold no record are an error, or with
    ``damaged="skip"`` left out; ``damaged_ranges`` lists them."""
    if damaged not in ("raise", "skip"):
        raise ValueError("damaged must be 'raise' or 'skip'")
    found = _found(folder, split_bytes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            rows, held = [], 0
            for name, row in found(b):
                if isinstance(row, Damage):
                    if damaged == "raise":
                        raise ValueError(f"{name}: no record in bytes {row.begin} to {row.end}")
                    continue
                rows.append(row)
                held += row[4]
                if held >= 4 * READ:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return _splits(archives, split_bytes).mapInArrow(task, RECORDS)


def damaged_ranges(archives: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, begin, end) of the bytes of the archives that hold no record: cut
    off, or damaged by a changed byte. Everything else can be read."""
    found = _found(folder, split_bytes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            gaps = [(name, *row) for name, row in found(b) if isinstance(row, Damage)]
            if gaps:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*gaps)], ["file", "begin", "end"])

    return _splits(archives, split_bytes).mapInArrow(task, "file string, begin long, end long")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as records and read back."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  -- five hex digits are four base-32 digits
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(d, (i // 4) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (d)"""
