"""Web archives: written, read and resolved against plain digests; foreign archives of every layout."""

import base64
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from claimtree.llm import warc
from claimtree.llm.common import stored

SCHEMA = "page_id long, url string, html string, file string, type int"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain_records(rows, least=0):
    """(id, bytes, digest, type, refers) of every row; of equal payloads the greatest id, NULL last, is the response."""
    by_payload = defaultdict(list)
    for key, html in rows:
        by_payload[(html or "").encode()].append(key)
    out = []
    for payload, keys in by_payload.items():
        best = max((k for k in keys if k is not None), default=None)
        first = True
        for key in sorted(keys, key=lambda k: (k is not None, k or 0), reverse=True):
            kind = "response" if first or len(payload) < least else "revisit"
            out.append((key, len(payload), digest(payload), kind, best if kind == "revisit" else None))
            first = False
    return Counter(out)


PAGES = [
    (1, "<p>a</p>"), (2, "<p>a</p>"), (7, "<p>a</p>"), (3, None), (4, ""), (5, "\r\n\r\nWARC/1.1\r\n\r\n"), (6, "\r\n"),
    (8, "é東京🙂"), (9, "x" * 700_000), (10, "x" * 700_000), (None, "<p>n</p>"), (None, "<p>n</p>"), (11, "q"), (11, "q"),
    (1 << 60, "big"), ((1 << 60) + 1, "big"), (12, "\x00\x01"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(k, None if k == 2 else f"http://x/{k}\r\nX: y", h, "f", 3) for k, h in rows], SCHEMA)


def result(back):
    rows = back.select(F.col("source_id").cast("bigint"), "payload_bytes", "payload_digest", "type", F.col("refers_source_id").cast("bigint"))
    return Counter(tuple(r) for r in rows.collect())


@pytest.mark.parametrize(("least", "file_bytes"), [(0, 1), (0, 1 << 20), (5, 400), (10**9, 1 << 20)])
def test_round_trip(spark, least, file_bytes):
    written = warc.write_pages(pages_of(spark, PAGES), file_bytes=file_bytes)
    reduced = warc.deduplicate(written, prefer=F.col("source_id").cast("bigint"), least_bytes=least, file_bytes=file_bytes)
    back = warc.payload_records(stored(warc.read_headers(reduced), "headers"))
    assert result(back) == plain_records(PAGES, least)
    assert reduced.agg(F.sum("records")).first()[0] == len(PAGES)


def test_resolving_twice_changes_nothing(spark):
    prefer = F.col("source_id").cast("bigint")
    once = warc.deduplicate(warc.write_pages(pages_of(spark, PAGES)), prefer=prefer)
    twice = warc.deduplicate(once, prefer=prefer)
    assert result(warc.payload_records(stored(warc.read_headers(twice), "h"))) == plain_records(PAGES)


def test_empty_table(spark):
    written = warc.write_pages(pages_of(spark, PAGES).limit(0))
    assert written.count() == 0
    headers = stored(warc.read_headers(warc.deduplicate(written)), "headers")
    assert headers.count() == 0 and warc.payload_records(headers).count() == 0


def parsed(data):
    """A plain reader of uncompressed archives."""
    stream, out = io.BytesIO(data), []
    while line := stream.readline():
        if line.strip():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.decode().partition(":")
                fields[name] = value.strip()
            out.append((fields, stream.read(int(fields["Content-Length"]))))
            assert stream.read(4) == b"\r\n\r\n"
    return out


def test_written_files(spark):
    """Every record is a gzip member; revisits keep the HTTP head and nothing else, and name the original."""
    rows = [(1, "same"), (2, "same"), (3, "other")]
    files = [r.file for r in warc.deduplicate(warc.write_pages(pages_of(spark, rows).coalesce(1)), prefer=F.col("source_id").cast("int")).collect()]
    records = []
    for name in files:
        with open(name.removeprefix("file://"), "rb") as f:
            records += parsed(gzip.decompress(f.read()))
    kinds = Counter(f["WARC-Type"] for f, _ in records)
    assert kinds == {"warcinfo": len(files), "response": 2, "revisit": 1}
    again, block = next((f, b) for f, b in records if f["WARC-Type"] == "revisit")
    first, first_block = next((f, b) for f, b in records if f.get(warc.SOURCE_FIELD) == "2")
    assert again["WARC-Refers-To"] == first["WARC-Record-ID"] != again["WARC-Record-ID"]
    assert again["WARC-Profile"] == warc.IDENTICAL and again["WARC-Target-URI"] == "http://x/1%0D%0AX: y"
    assert block + b"same" == first_block and again["WARC-Payload-Digest"] == f"sha1:{digest(b'same')}"
    assert first["WARC-Block-Digest"] == f"sha1:{digest(first_block)}"


def foreign(fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": len(block)}.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


HTTP = {"Content-Type": "application/http;msgtype=response"}
FOREIGN = [
    foreign({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"a: b\r\n"),
    foreign({"WARC-Type": "response", "WARC-Record-ID": "<r1>", "WARC-Date": "2020-01-01T00:00:00Z", **HTTP}, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"),
    foreign({"WARC-Type": "request", "WARC-Record-ID": "<q1>", "WARC-Concurrent-To": "<r1>"}, b"GET / HTTP/1.1\r\n\r\n"),
    foreign({"WARC-Type": "resource", "WARC-Record-ID": "<r2>", "WARC-Date": "2021-01-01T00:00:00Z", "Content-Type": "text/html"}, b"body"),
    foreign({"WARC-Type": "revisit", "WARC-Record-ID": "<v1>", "WARC-Date": "2022-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha1:{digest(b'body')}", "WARC-Refers-To": "<gone>", **HTTP}, b"HTTP/1.1 304 Not\r\n\r\n"),
    foreign({"WARC-Type": "revisit", "WARC-Record-ID": "<v2>", "WARC-Payload-Digest": "sha1:AAAA", "WARC-Refers-To": "<far>", **HTTP}, b""),
    foreign({"WARC-Type": "response", "WARC-Record-ID": "<r3>", "WARC-Date": "2019-01-01T00:00:00Z", **HTTP}, b"no empty line"),
]


@pytest.mark.parametrize("layout", ["plain", "whole", "records"])
def test_foreign_archives(spark, tmp_path, layout):
    pack = {"plain": b"".join, "whole": lambda x: gzip.compress(b"".join(x)), "records": lambda x: b"".join(map(gzip.compress, x))}[layout]
    (tmp_path / "x.warc.gz").write_bytes(pack(FOREIGN))
    files = warc.archive_files(spark, str(tmp_path))
    headers = {r.record_id: r for r in warc.read_headers(files).collect()}
    assert headers.keys() == {"<r1>", "<q1>", "<r2>", "<v1>", "<v2>", "<r3>"}
    assert headers["<r1>"].payload_digest == headers["<r2>"].payload_digest == digest(b"body")
    assert headers["<r3>"].payload_bytes == 0
    reduced = stored(warc.read_headers(warc.deduplicate(files)), "headers")
    found = {r.record_id: r for r in reduced.collect()}
    assert found["<r2>"].type == "resource" and found["<q1>"].type == "request" and found["<v2>"].refers_to == "<far>"
    assert Counter((r.type, r.refers_to) for r in found.values()) == Counter(
        [("resource", None), ("request", None), ("revisit", "<r2>"), ("revisit", "<r2>"), ("revisit", "<far>"), ("response", None)]
    )
    known = {(r.record_id, r.payload_bytes) for r in warc.payload_records(reduced).collect()}
    assert {n for _, n in known} == {4, 0, None} and ("<v2>", None) in known


def test_broken_archive(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(FOREIGN[1][:-20])
    with pytest.raises(Exception, match="x.warc"):
        warc.read_headers(warc.archive_files(spark, str(tmp_path))).collect()
