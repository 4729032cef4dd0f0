"""Deterministic sharded WARC archives.

Records are sorted by range of their key, written as gzip members into files that roll at
a compressed size, and read back from the files the manifest names. Headers and digests
are made anew from the payload; names, ids and dates depend on the input alone. A file is
written under a temporary name and moved when it is complete; the manifest, written last,
commits the archive, so leftovers of failed tasks are never read.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
largest key is a response and the others revisit it; smaller ones are all responses. NULL
payloads are empty. NULL keys sort first and lose against any key; of rows with an equal
key and payload one is the response, the others refer to it. An empty table gives an empty manifest.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.store import open_store, write_file
from folioflow.session import workspace

REVISIT_BYTES = 1000
ROLL_BYTES = 8 << 20
SPLIT_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, records long, bytes long, sha1 string"


def record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member without time stamp or name."""
    fields = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Length": str(len(block))}
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def header_text(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in value or "\r" in value else value


def record_id(page: int | None, sha1: str, nth: int) -> str:
    return f"<urn:page:{'' if page is None else page}:{sha1}:{nth}>"


def page_record(page: int | None, url: str | None, html: str, sha1: str, nth: int, refers: tuple[int | None] | None) -> bytes:
    """The nth record of an equal page and payload; ``refers`` holds the response's page for a revisit."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Record-ID": record_id(page, sha1, nth), "WARC-Target-URI": header_text(url), "WARC-Page-ID": None if page is None else str(page),
        "WARC-Payload-Digest": f"sha1:{sha1}", "Content-Type": "application/http; msgtype=response",
    }
    if refers is None:
        block = http + payload
        return record("response", fields | {"WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}"}, block)
    fields |= {
        "WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers[0], sha1, 0),
        "WARC-Refers-To-Page-ID": None if refers[0] is None else str(refers[0]), "WARC-Block-Digest": f"sha1:{hashlib.sha1(http).hexdigest()}",
    }
    return record("revisit", fields, http)


def plan(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Every page, and before each page of a repeated payload a note that names the response.

    Only keys and digests are grouped and joined; a group of equal payloads is one row after
    the first, combined, aggregation. The payloads themselves are shuffled once, together
    with the notes, by the range of their keys.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("html")
    ).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    large = rows.where(F.octet_length("html") >= REVISIT_BYTES).groupBy("page_id", "sha1").agg(F.count("*").alias("n"))
    first = large.groupBy("sha1").agg(F.max("page_id").alias("lead"), F.sum("n").alias("n")).where("n > 1")
    notes = large.join(first.drop("n"), "sha1").select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "sha1", "lead")
    return notes.union(rows.withColumn("lead", F.lit(None).cast("long")))


def write(pages: DataFrame, key: str, url: str, payload: str, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archive and its manifest; the manifest's rows (name, records, bytes, sha1)."""
    spark = pages.sparkSession
    planned = plan(pages, key, url, payload)
    store, path = open_store(folder)
    store.create_dir(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, path = open_store(folder)
        part = TaskContext.get().partitionId()
        held, size, number = [], 0, 0
        last, nth, lead = None, 0, None

        def roll() -> pa.RecordBatch:
            nonlocal held, size, number
            name = f"pages-{part:06d}-{number:05d}.warc.gz"
            info = f"software: folioflow\r\nformat: {VERSION}\r\n".encode()
            fields = {"WARC-Record-ID": f"<urn:file:{name}>", "WARC-Filename": name, "Content-Type": "application/warc-fields"}
            content = b"".join([record("warcinfo", fields, info), *held])
            write_file(store, f"{path}/{name}", content)
            out = {"name": [name], "records": [len(held)], "bytes": [len(content)], "sha1": [hashlib.sha1(content).hexdigest()]}
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            for values in zip(*[batch.column(k) for k in range(batch.num_columns)], strict=True):
                page, url, html, sha1, named = [value.as_py() for value in values]
                if (page, sha1) != last:
                    last, nth, lead = (page, sha1), 0, None
                if html is None:
                    lead = (named,)
                    continue
                refers = lead if lead and (lead[0] != page or nth) else None
                held.append(page_record(page, url, html, sha1, nth, refers))
                nth += 1
                size += len(held[-1])
                if size >= roll_bytes:
                    yield roll()
        if held:
            yield roll()

    total = pages.agg(F.sum(F.octet_length(payload))).first()[0] or 0
    ranges = max(1, -(-total // SPLIT_BYTES))
    dealt = planned.repartitionByRange(int(ranges), "page_id", "sha1").sortWithinPartitions("page_id", "sha1", F.col("html").isNotNull(), "url")
    dealt.mapInArrow(run, MANIFEST).write.json(f"{folder}-manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}-manifest")


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of an uncompressed WARC stream."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(":")
            fields[name] = value.strip()
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield fields, block


def page_of(fields: dict[str, str], block: bytes) -> dict:
    """What a page's record says; digests of blocks and payloads are checked."""
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block of {fields['WARC-Record-ID']} is damaged")
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    page, refers = (fields.get(name) for name in ("WARC-Page-ID", "WARC-Refers-To-Page-ID"))
    return {
        "page_id": None if page is None else int(page), "payload_bytes": length, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": None if refers is None else int(refers),
    }


PAGE_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per page's record of the files in the manifest, each file streamed by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64())])
        store, path = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.open(raw) as stream:
                    for fields, block in records(stream):
                        if fields["WARC-Type"] != "warcinfo":
                            held.append(page_of(fields, block))
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held = []
                yield pa.RecordBatch.from_pylist(held, kinds)

    files = manifest(spark, folder).select("name")
    return files.repartition(max(1, min(1000, files.count())), "name").mapInArrow(run, PAGE_ROWS)


def archive(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """Write all pages and read them back."""
    folder = workspace(pages.sparkSession, "warc")
    write(pages, key, url, payload, folder)
    return read(pages.sparkSession, folder)
