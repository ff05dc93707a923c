"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

Each task writes archives of a bounded size: a dictionary built from its first records, in the
order in which they reach the task (that of the table, where the join moves no rows), goes into a leading
skippable frame, then every record is a frame of its own. Files are written under a temporary name and renamed, so a repeated task leaves the same
archives. Equal payloads are stored once: the record with the largest page id is the response, the
others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize, scratch_path

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@dataclass(frozen=True)
class WarcSpec:
    """Archives close at ``archive_bytes``; the dictionary has ``dictionary_bytes`` and is built from
    ``sample_bytes`` of records."""

    archive_bytes: int = 64 << 20
    dictionary_bytes: int = 32 << 10
    sample_bytes: int = 1 << 20
    level: int = 3
    least_payload: int = 0


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def file_system(uri: str):
    """The Arrow file system of a folder that Spark names, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _train(samples: list[bytes], size: int):
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:  # too few or too small records to learn from: their bytes serve as they are
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Archive:
    """One archive that is being written."""

    def __init__(self, folder: str, name: str, spec: WarcSpec, samples: list[bytes]):
        import zstandard

        self.system, base = file_system(folder)
        self.system.create_dir(base, recursive=True)
        self.path, self.part = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.uri, self.records, self.bytes = f"{folder}/{name}", 0, 0
        dictionary = _train(samples, spec.dictionary_bytes)
        self.coder = zstandard.ZstdCompressor(level=spec.level, dict_data=dictionary)
        self.out = self.system.open_output_stream(self.part)
        content = dictionary.as_bytes()
        self.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self.write(self.coder.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.system.move(self.part, self.path)
        return self.uri, self.records, self.bytes


def write_archives(pages: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; (path, records, bytes) of each.

    Null html is an empty payload; null urls are empty targets. Payloads of at least
    ``least_payload`` bytes that are equal make one response, with the largest page id; rows with that
    id are all responses, null ids are smaller than any. An empty table writes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, open_archive, waiting = TaskContext.get().partitionId(), 0, None, []
        done: list[tuple[str, int, int]] = []

        def flush():
            nonlocal open_archive, number
            if waiting and open_archive is None:
                name = f"part-{task:06d}-{number:04d}.warc.zst"
                open_archive, number = _Archive(folder, name, spec, waiting), number + 1
            for record in waiting:
                open_archive.add(record)
            waiting.clear()

        size = 0
        for batch in batches:
            for row in range(batch.num_rows):
                page, url, html, digest, refers, revisit = (batch.column(k)[row].as_py() for k in range(6))
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                record = build_record(page, url, (html or "").encode(), digest, refers, revisit)
                waiting.append(record)
                size += len(record)
                if open_archive is not None or size >= spec.sample_bytes:
                    flush()
                    size = 0
                if open_archive is not None and open_archive.bytes >= spec.archive_bytes:
                    done.append(open_archive.close())
                    open_archive = None
        flush()
        if open_archive is not None:
            done.append(open_archive.close())
        if done:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("path", "records", "bytes"), d, strict=True)) for d in done],
                pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

    payload = F.coalesce("html", F.lit("")).cast("binary")
    # Digests are worked out in either scan, so that only the pages' own join moves payloads.
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")
    )
    winners = (
        keyed.filter(F.col("size") >= spec.least_payload)
        .groupBy("digest")
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select(F.col("digest").alias("w_digest"), "winner")
    )
    winners = materialize(winners, "responses")  # written first, so that AQE splits a hot payload's join
    other = F.col("winner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("winner"))
    records = keyed.join(winners, F.col("digest") == F.col("w_digest"), "left").select(
        "page_id", "url", "html", "digest", F.when(other, F.col("winner")).alias("refers"), other.alias("revisit")
    )
    return materialize(records.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of an archive that is open for reading; one record at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start")
    content = stream.read(size)
    kind = zstandard.DICT_TYPE_AUTO
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind)).stream_reader(
        stream, read_across_frames=True
    )
    lines = io.BufferedReader(reader, 1 << 20)
    while first := lines.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {first[:40]!r}")
        header = {}
        while (line := lines.readline()) != b"\r\n":
            if not line:
                raise ValueError("the archive ends inside a header")
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            header[name] = value
        block = lines.read(int(header["Content-Length"]))
        if lines.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its header says")
        yield header, block


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of each record.

    ``payload`` is null for revisits; a response whose payload does not have its digest is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = file_system(uri)
                rows, size = [], 0
                with system.open_input_file(path) as stream:
                    for header, block in records_of(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = header["WARC-Type"] == "revisit"
                        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"payload of {header['WARC-Record-ID']} in {uri} is damaged")
                        page, refers = header["X-Page-Id"], header.get("X-Refers-To-Page-Id")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1]) if revisit else len(payload)
                        rows.append(
                            (
                                int(page) if page else None,
                                header["WARC-Target-URI"],
                                length,
                                digest,
                                header["WARC-Type"],
                                int(refers) if refers else None,
                                None if revisit else payload,
                            )
                        )
                        size += len(block)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    count = archives.count()
    spread = archives.select("path").repartitionByRange(max(1, min(count, 10_000)), "path")
    return spread.mapInArrow(
        run,
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary",
    )


def archive_folder(spark) -> str:
    return scratch_path(spark, "archives")
