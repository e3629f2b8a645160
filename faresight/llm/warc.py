"""WARC archives through a chunked record table.

A record that is read back is a sequence of rows (record id, chunk number) of at
most ``chunk_bytes`` bytes, each with the payload's length and SHA-1 up to and
including that chunk (the last one's are those of the payload).  On the way in a
payload is one value: it passes the join with the revisits whole (a shuffle, if
these are too many to broadcast) and an Arrow batch, and is divided into chunks
only inside the task that writes it, so memory there grows with the largest page.

Writing takes three steps.  One pass gives every payload's digest; equal
payloads of at least ``min_bytes`` share the smallest page_id as their response
(a minimum per digest, pre-aggregated, so a payload with very many copies is no
hot group); each task then streams its records, chunk by chunk, into one
``.warc.gz`` file (a gzip member for each record) in the shared folder and
returns an index row for each record.  The index is a written table: files of
failed or repeated task attempts have names of their own that no index row
mentions, so a lost executor costs its own files only.

Reading goes by the index: each task opens its files, inflates record by record
in bounded pieces, parses the headers and yields the chunk rows again, with
digests made anew; a payload that differs from its recorded digest is an error.

Cases: a null payload is an empty one; records that repeat a page_id are each
written; equal payloads under one page_id are all responses (a record does not
revisit itself); a record with a null page_id takes part in no duplicate group;
an empty table writes nothing and gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresight.llm.tables import materialise
from faresight.session import scratch_path

PAGE = "urn:page:"
INDEX = "page_id long, file string, place long, length long"
CHUNKS = ("page_id long, chunk long, last boolean, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, data binary")


@dataclass(frozen=True)
class WarcPlan:
    """Sizes of chunks and of the smallest payload that is stored once only."""

    chunk_bytes: int = 64 * 1024
    min_bytes: int = 0
    level: int = 6  # of compression


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def chunk_rows(page_id, payload: memoryview, plan: WarcPlan) -> Iterator[tuple]:
    """(page_id, chunk, last, bytes so far, digest so far, data) of one payload; at least one row."""
    running, done, number = hashlib.sha1(), 0, 0
    while True:
        data = payload[done:done + plan.chunk_bytes]
        done += len(data)
        running.update(data)
        last = done >= len(payload)
        yield page_id, number, last, done, sha1_base32(running.digest()), data
        if last:
            return
        number += 1


def _payload(value: pa.Scalar) -> memoryview:
    return memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")


def payload_digests(pages: DataFrame, plan: WarcPlan) -> DataFrame:
    """``page_id, payload_bytes, sha1`` (hexadecimal) of every row (``pages``: page_id, payload)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = [row for p in batch.column("payload") for row in chunk_rows(None, _payload(p), plan) if row[2]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([r[3] for r in last], pa.int64()),
                 pa.array([base64.b32decode(r[4]).hex() for r in last], pa.string())], ["page_id", "payload_bytes", "sha1"])

    return pages.mapInArrow(rows, "page_id long, payload_bytes long, sha1 string")


def response_of(digests: DataFrame, plan: WarcPlan) -> DataFrame:
    """Revisits: ``page_id, sha1, refers_to`` (distinct)."""
    some = digests.filter((F.col("payload_bytes") >= plan.min_bytes) & F.col("page_id").isNotNull())
    first = some.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last"))
    several = first.filter("refers_to < _last").select("sha1", "refers_to")
    return some.join(several, "sha1").filter("page_id > refers_to").select(
        "page_id", "sha1", "refers_to").distinct()


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI that Spark uses, and the path in it."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def record_head(page_id, url: str | None, size: int, digest: str, refers_to) -> bytes:
    """WARC and HTTP headers of a record; a revisit has no payload after them."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    uri = "".join(c for c in (url or "") if c.isprintable())
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{PAGE}{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (size if refers_to is None else 0)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + http


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, plan: WarcPlan = WarcPlan(),
                   page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Write a record for each row into ``folder``; returns the index (a written table)."""
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                         F.col(payload).cast("binary").alias("payload"))
    digests = materialise(spark, payload_digests(pages.select("page_id", "payload"), plan), "digests")
    revisits = response_of(digests, plan).select(F.col("page_id").alias("_p"), F.col("sha1").alias("_d"), "refers_to")
    told = materialise(spark, revisits, "revisits")
    # The digest tells apart several records of one page_id.
    planned = pages.withColumn("_sha", F.sha1(F.coalesce("payload", F.lit("").cast("binary"))))
    planned = planned.join(told, (planned["page_id"] == told["_p"]) & (planned["_sha"] == told["_d"]), "left")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = stream = name = None
        place = 0
        try:
            for batch in batches:
                index = []
                for pid, uri, body, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                    if out is None:
                        store, path = open_store(folder)
                        store.create_dir(path, recursive=True)
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        out = stream = store.open_output_stream(f"{path.rstrip('/')}/{name}", compression=None)
                    begin = place
                    for piece in _record_pieces(pid.as_py(), uri.as_py(), _payload(body), first.as_py(), plan):
                        out.write(piece)
                        place += len(piece)
                    index.append((pid.as_py(), name, begin, place - begin))
                if index:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in index], t) for i, t in
                         enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                        ["page_id", "file", "place", "length"])
        finally:
            if stream is not None:
                stream.close()

    index = planned.select("page_id", "url", "payload", "refers_to").mapInArrow(rows, INDEX)
    return materialise(spark, index, "warc-index")


def _record_pieces(page_id, url, payload: memoryview, refers_to, plan: WarcPlan) -> Iterator[bytes]:
    """One record as a gzip member, in pieces."""
    whole = hashlib.sha1()
    for *_, data in chunk_rows(page_id, payload, plan):
        whole.update(data)
    pack = zlib.compressobj(plan.level, zlib.DEFLATED, 31)
    yield pack.compress(record_head(page_id, url, len(payload), sha1_base32(whole.digest()), refers_to))
    if refers_to is None:
        for *_, data in chunk_rows(page_id, payload, plan):
            yield pack.compress(data)
    yield pack.compress(b"\r\n\r\n")
    yield pack.flush()


class _Inflated:
    """Bytes of one gzip member of a file, in bounded pieces."""

    def __init__(self, file, place: int, length: int, step: int):
        file.seek(place)
        self.file, self.left, self.step = file, length, step
        self.member = zlib.decompressobj(31)
        self.held = b""

    def more(self) -> bool:
        raw = self.member.unconsumed_tail
        if not raw and self.left:
            raw = self.file.read(min(self.step, self.left))
            self.left -= len(raw)
        made = self.member.decompress(raw, self.step) if raw else b""
        self.held += made
        return bool(raw)

    def head(self) -> bytes:
        """Bytes up to an empty line, which is dropped."""
        while (at := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise ValueError("a record's header has no end")
        out, self.held = self.held[:at], self.held[at + 4:]
        return out

    def take(self, most: int) -> bytes:
        while len(self.held) < most and self.more():
            pass
        out, self.held = self.held[:most], self.held[most:]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def _page(field: str | None):
    number = (field or "").removeprefix(f"<{PAGE}").removesuffix(">")
    return int(number) if number else None


def read_record(file, place: int, length: int, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """Chunk rows of one record, in the order of ``CHUNKS``."""
    source = _Inflated(file, place, length, chunk_bytes)
    warc = _fields(source.head())
    http = _fields(source.head())
    page_id, refers_to, size = _page(warc["warc-record-id"]), _page(warc.get("warc-refers-to")), int(http["content-length"])
    told = warc["warc-payload-digest"].removeprefix("sha1:")
    if warc["warc-type"] == "revisit":
        yield page_id, 0, True, "revisit", refers_to, size, told, None
        return
    running, done, number = hashlib.sha1(), 0, 0
    while True:
        data = source.take(min(chunk_bytes, size - done))
        if not data and done < size:
            raise ValueError(f"the payload of page {page_id} ends after {done} of {size} bytes")
        running.update(data)
        done += len(data)
        so_far, last = sha1_base32(running.digest()), done >= size
        if last and so_far != told:
            raise ValueError(f"the payload of page {page_id} differs from its digest")
        yield page_id, number, last, "response", None, done, so_far, data if with_data else None
        if last:
            return
        number += 1


def read_archives(index: DataFrame, folder: str, plan: WarcPlan = WarcPlan(), with_data: bool = True) -> DataFrame:
    """The chunked record table of all indexed records; ``data`` is null for revisits."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = [part.split()[0] for part in CHUNKS.split(", ")]
        store, path = open_store(folder)
        opened, file = None, None

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(types)], names)

        for batch in batches:
            made, held = [], 0
            for name, place, length in zip(*(batch.column(c).to_pylist() for c in ("file", "place", "length"))):
                if name != opened:
                    if file is not None:
                        file.close()
                    opened, file = name, store.open_input_file(f"{path.rstrip('/')}/{name}")
                for row in read_record(file, place, length, plan.chunk_bytes, with_data):
                    made.append(row)
                    held += len(row[7] or b"") + 100
                    if held > 1 << 23:
                        yield batch_of(made)
                        made, held = [], 0
            if made:
                yield batch_of(made)
        if file is not None:
            file.close()

    # by file and place within the index's own partitions: a file was indexed by one task
    return index.sortWithinPartitions("file", "place").mapInArrow(rows, CHUNKS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, plan: WarcPlan = WarcPlan(), page_id: str = "page_id",
                       payload: str = "html", url: str = "url") -> DataFrame:
    """Write archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = scratch_path(spark, "warc")
    index = write_archives(spark, pages, folder, plan, page_id, payload, url)
    return read_archives(index, folder, plan, with_data=False).filter("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
