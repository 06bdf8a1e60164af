"""Web archives (WARC 1.1) without repeated payloads: revisit resolution.

Reading archives gives one row of headers per record, with the payload's digest computed from its bytes; payloads
stay in the archives. The headers are shuffled by digest, one record of each payload becomes the original, and the
records of equal payloads are joined to it. Rewriting copies originals and turns the others into ``revisit``
records that refer to them, all with fresh headers.

Tasks write and read archives themselves, record by record, in the folder that all executors share. A file's name
belongs to one attempt of one task, and only files named by a table that Spark has committed are ever read, so a
lost executor or a repeated task leaves at most files that nobody reads. A record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimtree.llm.common import give_back_memory, shared_files, small_batches, stored
from claimtree.session import scratch_path

# Fixed values of the format.
VERSION, IDENTICAL = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP, HTML_HEAD = "application/http; msgtype=response", "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
BREAK = b"\r\n"
# A field of our own that carries the id of the row that a record was made from.
SOURCE_FIELD = "X-Source-ID"
# Compressed bytes after which a task goes on in a new file, and bytes that are read or written at once.
FILE_BYTES, PIECE = 256 << 20, 1 << 18

FILES = "file string, records long, bytes long"
HEADERS = (
    "file string, offset long, number long, type string, record_id string, uri string, date string, source_id string, "
    "payload_bytes long, payload_digest string, refers_to string"
)


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def clean(value: str) -> str:
    """A value that stays on its line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


class Writer:
    """Archives of one attempt of a task; ``files`` are those it has closed."""

    def __init__(self, folder: str, file_bytes: int):
        self.folder, self.file_bytes, self.files = folder.rstrip("/"), file_bytes, []
        self.store, self.path = shared_files(self.folder)
        self.out = None

    def _open(self) -> None:
        self.store.create_dir(self.path, recursive=True)
        self.name = f"{TaskContext.get().partitionId():06d}-{len(self.files):04d}-{uuid.uuid4().hex}.warc.gz"
        self.out = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
        self.records = self.bytes = 0
        info = b"software: claimtree\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", now()), ("Content-Type", "application/warc-fields")]
        self._write(fields, [info], len(info))

    def _write(self, fields: list[tuple[str, str | None]], block: Iterable[bytes], length: int) -> None:
        head = "".join(f"{name}: {clean(value)}\r\n" for name, value in fields if value is not None)
        pack = zlib.compressobj(wbits=31)
        self._put(pack.compress(f"{VERSION}\r\n{head}Content-Length: {length}\r\n\r\n".encode()))
        for piece in block:
            self._put(pack.compress(piece))
        self._put(pack.compress(BREAK + BREAK) + pack.flush())

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.bytes += len(data)

    def add(self, fields: list[tuple[str, str | None]], block: Iterable[bytes], length: int) -> None:
        if self.out is None:
            self._open()
        self._write(fields, block, length)
        self.records += 1
        if self.bytes >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.append((f"{self.folder}/{self.name}", self.records, self.bytes))
            self.out = None

    def rows(self) -> pa.RecordBatch:
        self.close()
        columns = list(zip(*self.files, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "records", "bytes"])


class Record:
    """Fields of a record; its block is read from the archive once, in pieces."""

    def __init__(self, archive: Archive, offset: int, number: int, head: bytes):
        self.archive, self.offset, self.number = archive, offset, number
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record in {archive.path} at {offset}")
        self.fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        self.length = self.left = int(self.fields["content-length"])
        self.type = self.fields.get("warc-type", "")

    def block(self) -> Iterator[bytes]:
        while self.left:
            piece = self.archive.take(min(self.left, PIECE))
            self.left -= len(piece)
            yield piece

    def is_http(self) -> bool:
        return self.fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")

    def http_head(self) -> bytes:
        """The block up to and with its first empty line; without one, all of it."""
        if not self.is_http():
            return b""
        head = self.archive.take_through(BREAK + BREAK, self.left)
        self.left -= len(head)
        return head


class Archive:
    """Records of one file from an offset on, in order; compressed by record, compressed as a whole, or plain."""

    def __init__(self, file: str, offset: int = 0):
        store, self.path = shared_files(file)
        self.stream = store.open_input_file(self.path)
        self.packed = self.stream.read(2) == b"\x1f\x8b"
        self.stream.seek(offset)
        self.at, self.raw, self.data, self.engine = offset, b"", bytearray(), None
        self.start, self.number, self.current = offset, -1, None

    def _more(self) -> bool:
        """Reads on inside the member, or into the next one where there is none."""
        if not self.raw:
            self.raw = self.stream.read(PIECE)
        if not self.raw:
            return False
        if not self.packed:
            self.data += self.raw
            self.raw = b""
            return True
        if self.engine is None:
            self.engine, self.start, self.number = zlib.decompressobj(31), self.at, -1
        size = len(self.raw)
        self.data += self.engine.decompress(self.raw, PIECE)
        ended = self.engine.eof
        self.raw = self.engine.unused_data if ended else self.engine.unconsumed_tail
        self.at += size - len(self.raw)
        if ended:
            self.engine = None
        return True

    def take(self, size: int) -> bytes:
        while not self.data:
            if not self._more():
                raise ValueError(f"{self.path} ends inside a record")
        piece = bytes(self.data[:size])
        del self.data[:size]
        if not self.packed:
            self.at += len(piece)
        return piece

    def take_through(self, mark: bytes, most: int | None = None) -> bytes:
        found = self.data.find(mark)
        while found < 0 and (most is None or len(self.data) < most):
            seen = max(0, len(self.data) - len(mark))
            if not self._more():
                raise ValueError(f"{self.path} ends inside a record")
            found = self.data.find(mark, seen)
        size = len(self.data) if found < 0 else found + len(mark)
        size, piece = size if most is None else min(size, most), b""
        while len(piece) < size:
            piece += self.take(size - len(piece))
        return piece

    def __iter__(self) -> Iterator[Record]:
        while True:
            if self.current is not None:
                for _ in self.current.block():
                    pass
            # Empty lines between records; a member ends behind them.
            while True:
                while self.data[:1] in (b"\r", b"\n"):
                    self.take(1)
                if self.data or (self.packed and self.engine is None):
                    break
                if not self._more():
                    return
            if not self.data:
                if not self._more():
                    return
                if not self.data:
                    continue
            if not self.packed:
                self.start, self.number = self.at, -1
            self.number += 1
            offset, number = self.start, self.number
            self.current = Record(self, offset, number, self.take_through(BREAK + BREAK)[:-4])
            yield self.current

    def close(self) -> None:
        self.stream.close()


def _files(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """The committed table of written files, one row per file and one file per partition."""
    return one_per_task(stored(rows, label))


def one_per_task(files: DataFrame) -> DataFrame:
    # As many rows as archives; an explicit number keeps small partitions from being merged.
    return files.repartitionByRange(max(1, files.count()), "file")


def write_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str | None = None, file_bytes: int = FILE_BYTES, folder: str | None = None,
) -> DataFrame:
    """Writes one response record per row and returns the files (``file``, ``records``, ``bytes``).

    The payload is the html in UTF-8, of any length; NULL is an empty payload. A NULL url or id leaves out its
    field. Repeated rows are repeated records; other columns are not used; an empty table gives no file.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder, date = folder or scratch_path(spark, "archives"), date or now()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer(folder, file_bytes)
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("id", "url", "html")]
            for key, address, payload in zip(*columns, strict=True):
                payload = payload or b""
                head = HTML_HEAD.format(len(payload)).encode()
                fields = [
                    ("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                    ("WARC-Target-URI", address), (SOURCE_FIELD, key),
                    ("WARC-Payload-Digest", f"sha1:{digest_text(hashlib.sha1(payload).digest())}"),
                    ("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(head + payload).digest())}"), ("Content-Type", HTTP),
                ]
                out.add(fields, (head, payload), len(head) + len(payload))
        yield out.rows()
        give_back_memory()

    rows = pages.select(F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"))
    return _files(spark, rows.mapInArrow(run, FILES), "archive-files")


def header(file: str, record: Record) -> dict:
    fields, size, digest = record.fields, None, None
    if record.type in ("response", "resource"):
        record.http_head()
        sha1, size = hashlib.sha1(), 0
        for piece in record.block():
            sha1.update(piece)
            size += len(piece)
        digest = digest_text(sha1.digest())
    elif record.type == "revisit" and fields.get("warc-payload-digest", "").startswith("sha1:"):
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
    return {
        "file": file, "offset": record.offset, "number": record.number, "type": record.type,
        "record_id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "source_id": fields.get(SOURCE_FIELD.lower()), "payload_bytes": size, "payload_digest": digest,
        "refers_to": fields.get("warc-refers-to"),
    }


def read_headers(files: DataFrame) -> DataFrame:
    """One row per record but ``warcinfo`` of the archives that ``file`` names; a task reads a file from end to end.

    ``offset`` and ``number`` are the record's place: the start of its gzip member (of the record, in a plain
    file) and its number there. Payload sizes and digests (SHA-1, base 32) are computed from the bytes of
    ``response`` and ``resource`` records; a ``revisit`` has the digest that it states and no size. A file that
    is cut off or holds something else raises an error that names it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in HEADERS.split(", ")]
        schema = pa.schema([(n, pa.int64() if n in ("offset", "number", "payload_bytes") else pa.string()) for n in names])
        for batch in batches:
            for file in batch.column("file").to_pylist():
                archive, rows = Archive(file), []
                for record in archive:
                    if record.type != "warcinfo":
                        rows.append(header(file, record))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)
                archive.close()
        give_back_memory()

    return files.select("file").mapInArrow(run, HEADERS)


def resolve(headers: DataFrame, prefer: Column | None = None, least_bytes: int = 0) -> DataFrame:
    """Headers with ``verdict`` and the original's ``original_id``, ``original_uri``, ``original_date``.

    Of the payload records with equal payloads of at least ``least_bytes`` bytes, that with the greatest
    ``prefer`` is the original (by default the latest date); equal ones go by record id, NULL comes last. Its
    verdict is ``response``, as is that of smaller ones; all others are ``revisit``. A record that was a revisit
    already refers to the original of its digest; where there is none, and for other record types, the verdict
    is ``copy``.
    """
    payload = F.col("type").isin("response", "resource")
    keyed = headers.withColumn("_key", F.when((payload & (F.col("payload_bytes") >= least_bytes)) | (F.col("type") == "revisit"), F.col("payload_digest")))
    chosen = F.max(F.struct((prefer if prefer is not None else F.col("date")).alias("prefer"), "record_id", "uri", "date"))
    # One row per payload; equal ones are combined in the task before the shuffle.
    originals = keyed.where(payload & F.col("_key").isNotNull()).groupBy(F.col("_key").alias("_digest")).agg(chosen.alias("o"))
    originals = originals.select("_digest", F.col("o.record_id").alias("original_id"), F.col("o.uri").alias("original_uri"), F.col("o.date").alias("original_date"))
    # A payload that a third of all records share is split by the join, as nothing is grouped behind it.
    met = keyed.where(F.col("_key").isNotNull()).join(originals, F.col("_key") == F.col("_digest"), "left")
    verdict = (
        F.when(F.col("original_id").isNull(), F.lit("copy"))
        .when(F.col("original_id") == F.col("record_id"), F.lit("response"))
        .otherwise(F.lit("revisit"))
    )
    alone = keyed.where(F.col("_key").isNull()).withColumns({c: F.lit(None).cast("string") for c in ("original_id", "original_uri", "original_date")})
    alone = alone.withColumn("verdict", F.when(payload, F.lit("response")).otherwise(F.lit("copy")))
    return met.drop("_digest").withColumn("verdict", verdict).unionByName(alone).drop("_key")


def rewrite(resolved: DataFrame, file_bytes: int = FILE_BYTES, folder: str | None = None) -> DataFrame:
    """Writes new archives and returns their files.

    Originals keep their id and block and get fresh headers. Revisits are new records: they keep date, address and
    HTTP head, refer to the original and have no payload. Records with verdict ``copy`` stay as they are. Records
    go by their place in the archives, so a task reads on from one to the next, and a large archive is shared
    among tasks.
    """
    spark = resolved.sparkSession
    folder, run_id = folder or scratch_path(spark, "archives"), uuid.uuid4()

    def fields_of(row: dict, record: Record) -> list[tuple[str, str | None]]:
        if row["verdict"] == "copy":
            return [(name, value) for name, value in record.fields.items() if name != "content-length"]
        kept = [
            ("WARC-Date", row["date"]), ("WARC-Target-URI", row["uri"]), (SOURCE_FIELD, row["source_id"]),
            ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), ("Content-Type", record.fields.get("content-type")),
        ]
        if row["verdict"] == "response":
            own = [("WARC-Type", row["type"]), ("WARC-Record-ID", row["record_id"])]
            return [*own, *kept, ("WARC-Block-Digest", record.fields.get("warc-block-digest"))]
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(run_id, row['record_id'] or '')}>")]
        return [
            *own, *kept, ("WARC-Profile", IDENTICAL), ("WARC-Refers-To", row["original_id"]),
            ("WARC-Refers-To-Target-URI", row["original_uri"]), ("WARC-Refers-To-Date", row["original_date"]),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, archive, records, record, file = Writer(folder, file_bytes), None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                place = (row["offset"], row["number"])
                if record is None or row["file"] != file or (record.offset, record.number) >= place:
                    if archive is not None:
                        archive.close()
                    archive, file = Archive(row["file"], row["offset"]), row["file"]
                    records = iter(archive)
                    record = next(records)
                while (record.offset, record.number) < place:
                    record = next(records)
                if row["verdict"] == "revisit":
                    head = record.http_head()
                    out.add(fields_of(row, record), (head,), len(head))
                else:
                    out.add(fields_of(row, record), record.block(), record.length)
        yield out.rows()
        if archive is not None:
            archive.close()
        give_back_memory()

    # Written first: the ranges come from a sample, and a second run of the rows may not fall otherwise.
    placed = stored(resolved, "verdicts").repartitionByRange("file", "offset", "number")
    placed = placed.sortWithinPartitions("file", "offset", "number")
    return _files(spark, placed.mapInArrow(run, FILES), "archive-files")


def deduplicate(files: DataFrame, prefer: Column | None = None, least_bytes: int = 0, **options) -> DataFrame:
    """New archives with each payload once: headers read, resolved and rewritten (see there)."""
    return rewrite(resolve(stored(read_headers(files), "headers"), prefer, least_bytes), **options)


def payload_records(headers: DataFrame) -> DataFrame:
    """One row per ``response``, ``resource`` and ``revisit`` record of stored headers: revisits joined to originals.

    The headers with ``payload_bytes`` of every record and the ``source_id`` of the record that a revisit refers
    to as ``refers_source_id``; both are NULL where that record is in none of the archives.
    """
    own = headers.where(F.col("type").isin("response", "resource"))
    known = own.select(F.col("record_id").alias("_id"), F.col("payload_bytes").alias("_bytes"), F.col("source_id").alias("refers_source_id"))
    again = headers.where(F.col("type") == "revisit").join(known, F.col("refers_to") == F.col("_id"), "left")
    again = again.withColumn("payload_bytes", F.col("_bytes")).drop("_id", "_bytes")
    return own.withColumn("refers_source_id", F.lit(None).cast("string")).unionByName(again)


def archive_files(spark: SparkSession, folder: str, pattern: str = "*.warc*") -> DataFrame:
    """Archives under a folder as the table that ``read_headers`` takes."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return one_per_task(found.select(F.col("path").alias("file")))
