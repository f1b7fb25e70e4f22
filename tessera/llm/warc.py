"""WARC archives: a writer with revisit records and a sequential reader.

Archives are files of one gzip member per record in the shared folder. The
reader inflates incrementally, one member at a time, frames each record by its
Content-Length and verifies its digest; it holds one record and one input
block in memory, whatever the archive's length.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
largest page id is written as a response, the others as revisits of it. A null
or empty html is an empty payload. A page without an id is always a response.
Rows repeated with the same page id and payload are equal records. A payload is
held whole by the task that writes or reads it. Extra columns are ignored. An
empty table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, light, staged, staging_path

BLOCK = 1 << 16


class WarcError(ValueError):
    """A record that breaks the framing or its digest."""


def digest_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as one gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode() + block + b"\r\n\r\n") + deflate.flush()


def one_line(value: object) -> str:
    return " ".join(str(value).split())


def page_urn(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_record(page_id: object, url: str | None, payload: bytes, refers_to: object, date: str = "1970-01-01T00:00:00Z") -> bytes:
    kind = "response" if refers_to is None else "revisit"
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", page_urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(url or "urn:none")),
        ("WARC-Payload-Digest", digest_label(payload)),
    ]
    if refers_to is None:
        return record([*headers, ("Content-Type", "text/html; charset=utf-8"), ("WARC-Block-Digest", digest_label(payload))], payload)
    length = ("X-Payload-Length", str(len(payload)))
    profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return record([*headers, profile, ("WARC-Refers-To", page_urn(refers_to)), length], b"")


def members(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one after the other."""
    inflate, parts, started = zlib.decompressobj(31), [], False
    for block in blocks:
        while block:
            started = True
            parts.append(inflate.decompress(block))
            block = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts, started = zlib.decompressobj(31), [], False
    if started:
        raise WarcError("the archive ends within a record")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record."""
    head, sep, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not sep or not first.startswith("WARC/"):
        raise WarcError(f"not a record: {first[:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(headers.get("content-length", "-1"))
    if length < 0 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"{headers.get('warc-record-id')}: the content length doesn't frame the record")
    block = rest[:length]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != digest_label(block):
        raise WarcError(f"{headers.get('warc-record-id')}: the digest differs")
    return headers, block


def read_records(blocks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    for member in members(blocks):
        yield parse(member)


def file_blocks(path: str) -> Iterator[bytes]:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as stream:
        while block := stream.read(BLOCK):
            yield block


def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, html, refers_to): the response that a revisit refers to."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    slim = pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("n")).filter(F.col("n") >= min_bytes)
    groups = slim.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("least < refers_to")
    # Written first, so that the pages of a hot payload can be split between tasks.
    groups = staged(groups.drop("least"), "payloads")
    revisits = slim.join(groups, ["digest", "n"]).filter("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), body.alias("body"), F.sha1(body).alias("digest"))
    return rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "body", "refers_to")


def write_archives(pages: DataFrame, min_bytes: int = 1000, max_archive: int = 1 << 30) -> DataFrame:
    """Writes the archives and returns (path, records), one row per file.

    A file gets a name of its own per attempt and moves into place when it is
    whole, and only files named by a finished task are listed, so a lost
    executor leaves no half archive behind. A task begins another file once one
    has ``max_archive`` bytes.
    """
    spark = pages.sparkSession
    folder = staging_path(spark, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, n, size, out = "", 0, 0, None

        def closed() -> pd.DataFrame:
            out.close()
            store.move(f"{base}/_{name}", f"{base}/{name}")
            return pd.DataFrame({"path": [f"{folder}/{name}"], "records": [n]})

        for pdf in batches:
            for page_id, url, body, refers_to in zip(*(pdf[c].tolist() for c in ("page_id", "url", "body", "refers_to"))):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/_{name}", compression=None)
                member = page_record(page_id, url, body, refers_to)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= max_archive:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    bounded_batches(spark)
    # Ids pass as strings: pandas would make nullable longs floats.
    rows = with_revisits(pages, min_bytes)
    rows = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "body", F.col("refers_to").cast("string").alias("refers_to"))
    return staged(rows.mapInPandas(light(write), "path string, records long"), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per record of the archives that ``files.path`` names, a task per
    archive. A response's payload digest is computed, and must be its header's."""

    def page(name: str | None) -> str | None:
        return (name.rpartition(":")[2].rstrip(">") or None) if name else None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                rows, size = [], 0
                for headers, block in read_records(file_blocks(path)):
                    label = headers["warc-payload-digest"]
                    if headers["warc-type"] == "response" and label != digest_label(block):
                        raise WarcError(f"{headers.get('warc-record-id')}: the payload's digest differs")
                    n = int(headers.get("x-payload-length", len(block)))
                    rows.append((page(headers["warc-record-id"]), headers.get("warc-target-uri"), n, base64.b32decode(label.partition(":")[2]).hex(), headers["warc-type"], page(headers.get("warc-refers-to")), block))
                    size += len(block)
                    if len(rows) >= 1024 or size >= 4 << 20:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    found = files.select("path").repartition(max(1, files.count())).mapInPandas(light(read), schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
