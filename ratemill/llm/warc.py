"""WARC archives compressed with Zstandard: one frame per record, dictionary in front.

Writing: each task compresses its records one by one with a dictionary trained on
the first of them, and rolls over to a new archive at a size limit. The dictionary
stands, compressed, in a skippable frame at the head of the file. Archives have
names of their own per attempt; the manifest, which Spark commits, names those
that count, so lost executors and repeated tasks leave nothing half done in it.

Reading: a task streams an archive, loads the dictionary from the leading
skippable frame, decodes frame by frame, and checks each record: version, mandatory
headers, the block's length, the closing line breaks, the declared length of the
payload and its digest. What is wrong is put into ``problem``; a frame that cannot
be decoded ends its archive with a problem row.

A payload of at least ``least_shared`` bytes is stored once, by the record with the
largest page_id (every row that has it, if rows repeat); the others revisit it and
hold its digest and length only. NULL html is an empty payload. A NULL page_id is
smaller than any other and is kept as such. A NULL url becomes a name made of the
page_id; characters that a header cannot hold are percent-encoded. Empty tables
give no archives. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratemill.operators.order import with_positions

from .tables import filesystem, stored

#: Skippable frames: the number for dictionaries, and the range of all.
DICTIONARY = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME = 0xFD2FB528
DATE = "2026-01-01T00:00:00Z"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, least_shared: int = 1000) -> DataFrame:
    """page_id, url, payload, record_type and refers_to for every page."""
    sized = pages.select(
        "page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    shared = (
        sized.where(F.octet_length("payload") >= least_shared)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    same = sized.join(shared, "digest", "left")
    revisits = F.col("refers_to").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    )
    return same.select(
        "page_id",
        "url",
        F.when(~revisits, F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("refers_to")).alias("refers_to"),
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _digest_name(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_bytes(row: dict) -> bytes:
    """A record: headers, block, and two line breaks."""
    page_id, revisit = row["page_id"], row["record_type"] == "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = block % row["payload_bytes"] + (b"" if revisit else row["payload"])
    url = row["url"] if row["url"] else f"urn:page:{page_id}"
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": _digest_name(row["digest"]),
    }
    if page_id is not None:
        headers["Page-ID"] = str(page_id)
    if revisit:
        headers |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": _record_id(row["refers_to"]),
            "Refers-To-Page-ID": str(row["refers_to"]),
        }
    headers |= {
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    """Trained on pieces of the samples; None where they are too few or too much alike."""
    pieces = [s[i : i + 2048] for s in samples for i in range(0, len(s), 2048)]
    try:
        return zstandard.train_dictionary(size, pieces)
    except zstandard.ZstdError:
        return None


class _Archive:
    """One file being written."""

    def __init__(
        self, system: fs.FileSystem, base: str, name: str, samples: list[bytes], size: int
    ) -> None:
        trained = _dictionary(samples, size)
        self.name, self.records, self.bytes = name, 0, 0
        self.out = system.open_output_stream(f"{base}/{name}", compression=None)
        if trained:
            packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
            self._write(struct.pack("<II", DICTIONARY, len(packed)) + packed)
        self.compressor = zstandard.ZstdCompressor(
            dict_data=trained, write_checksum=True, write_content_size=True
        )
        for sample in samples:
            self.add(sample)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.name, self.records, self.bytes


MANIFEST = "path string, records long, bytes long"


def _written(
    batches: Iterator[pa.RecordBatch], folder: str, most: int, sample: int, size: int
) -> Iterator[pa.RecordBatch]:
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
    archive, waiting, waiting_bytes, done = None, [], 0, []

    def opened() -> _Archive:
        return _Archive(system, base, f"{name}-{len(done):04d}.warc.zst", waiting, size)

    for batch in batches:
        for row in batch.to_pylist():
            record = record_bytes(row)
            if archive is None:
                waiting.append(record)
                waiting_bytes += len(record)
                if waiting_bytes >= sample:
                    archive, waiting, waiting_bytes = opened(), [], 0
            else:
                archive.add(record)
            if archive and archive.bytes >= most:
                done.append(archive.close())
                archive = None
    if waiting:
        archive = opened()
    if archive:
        done.append(archive.close())
    names, records, sizes = zip(*done) if done else ((), (), ())
    paths = [f"{folder.rstrip('/')}/{name}" for name in names]
    yield pa.record_batch(
        [pa.array(paths, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
        ["path", "records", "bytes"],
    )


def write_archives(
    records: DataFrame,
    folder: str,
    most_bytes: int = 64 << 20,
    sample_bytes: int = 1 << 20,
    dictionary_bytes: int = 16 << 10,
) -> DataFrame:
    """Write planned records below ``folder``; the manifest of the archives that count."""
    return stored(
        records.mapInArrow(
            lambda batches: _written(batches, folder, most_bytes, sample_bytes, dictionary_bytes),
            MANIFEST,
        )
    )


class _Stream:
    """Bytes of a file with a look ahead."""

    def __init__(self, file, block: int = 1 << 16) -> None:
        self.file, self.block, self.buffer, self.offset = file, block, b"", 0

    def fill(self, n: int) -> bool:
        while len(self.buffer) < n:
            more = self.file.read(max(self.block, n - len(self.buffer)))
            if not more:
                return False
            self.buffer += more
        return True

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError("the file ends within a frame")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        self.offset += n
        return out

    def frame(self, decompressor: zstandard.ZstdDecompressor) -> bytes:
        """Decode one frame; what follows it stays."""
        self.fill(18)
        declared = zstandard.frame_content_size(self.buffer[:18])
        decoder, parts = decompressor.decompressobj(), []
        while not decoder.eof:
            if not self.fill(1):
                raise ValueError("the file ends within a frame")
            data, self.buffer = self.buffer, b""
            parts.append(decoder.decompress(data))
            self.buffer = decoder.unused_data
            self.offset += len(data) - len(self.buffer)
        out = b"".join(parts)
        if declared not in (-1, len(out)):
            raise ValueError(f"a frame of {len(out)} bytes declares {declared}")
        return out


def frames(file) -> Iterator[tuple[int, bytes]]:
    """(offset, record) for every frame of an archive."""
    stream, decompressor = _Stream(file), zstandard.ZstdDecompressor()
    while stream.fill(4):
        at, (magic,) = stream.offset, struct.unpack("<I", stream.buffer[:4])
        if magic in SKIPPABLE:
            _, length = struct.unpack("<II", stream.take(8))
            content = stream.take(length)
            if magic == DICTIONARY and at == 0:
                if content[:4] == struct.pack("<I", FRAME):
                    content = zstandard.ZstdDecompressor().decompress(content)
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_FULLDICT)
                decompressor = zstandard.ZstdDecompressor(dict_data=known)
        elif magic == FRAME:
            yield at, stream.frame(decompressor)
        else:
            raise ValueError(f"no frame starts at byte {at}")
    if stream.buffer:
        raise ValueError("the file ends within a frame")


def _headers(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"not a header: {line[:60]!r}")
        found[name.strip().decode().lower()] = value.strip().decode()
    return found


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; ValueError if it is not valid."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError(f"not a WARC record: {data[:20]!r}")
    headers = _headers(lines)
    if missing := [name for name in MANDATORY if not headers.get(name.lower())]:
        raise ValueError(f"without {', '.join(missing)}")
    if not headers["content-length"].isdecimal():
        raise ValueError(f"Content-Length is {headers['content-length']!r}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"a block of {len(rest) - 4} bytes declares {length}")
    record = {"headers": headers, "payload": None, "payload_bytes": None, "payload_digest": None}
    if headers["warc-type"] in ("response", "revisit"):
        http, found, payload = rest[:length].partition(b"\r\n\r\n")
        status, *lines = http.split(b"\r\n")
        if not found or not status.startswith(b"HTTP/"):
            raise ValueError("the block is not an HTTP response")
        declared = _headers(lines).get("content-length", "")
        name, _, digest = headers.get("warc-payload-digest", "").partition(":")
        if name != "sha1" or not declared.isdecimal():
            raise ValueError("without SHA-1 digest or length of the payload")
        record["payload_bytes"] = int(declared)
        record["payload_digest"] = base64.b32decode(digest).hex()
        if headers["warc-type"] == "response":
            if len(payload) != int(declared):
                raise ValueError(f"a payload of {len(payload)} bytes declares {declared}")
            if hashlib.sha1(payload).hexdigest() != record["payload_digest"]:
                raise ValueError("the payload does not have its digest")
            record["payload"] = payload
        elif payload or "warc-refers-to" not in headers:
            raise ValueError("a revisit with a payload or without a reference")
    return record


RECORDS = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("problem", pa.string()),
    ]
)
RECORD_SQL = (
    "path string, offset long, headers map<string,string>, payload binary, "
    "payload_bytes long, payload_digest string, problem string"
)


def _records_of(path: str) -> Iterator[dict]:
    system, at = filesystem(path)
    nothing = {"headers": None, "payload": None, "payload_bytes": None, "payload_digest": None}
    offset = 0
    try:
        with system.open_input_stream(at, compression=None) as file:
            for offset, data in frames(file):
                try:
                    record = parse_record(data) | {"problem": None}
                    record["headers"] = list(record["headers"].items())
                except ValueError as error:
                    record = nothing | {"problem": str(error)}
                yield {"path": path, "offset": offset} | record
    except (ValueError, zstandard.ZstdError) as error:
        yield {"path": path, "offset": offset, **nothing, "problem": str(error)}


def _read(
    batches: Iterator[pa.RecordBatch], payloads: bool, most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows, size = [], 0
            for record in _records_of(path):
                if not payloads:
                    record["payload"] = None
                rows.append(record)
                size += len(record["payload"] or b"") + 500
                if size >= most:
                    yield pa.RecordBatch.from_pylist(rows, RECORDS)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, RECORDS)


def read_archives(
    manifest: DataFrame, payloads: bool = True, task_bytes: int = 128 << 20
) -> DataFrame:
    """The records of the archives in ``manifest`` (path, and bytes if known), in columns of RECORD_SQL.

    Archives are dealt out in turn, largest first, over as many tasks as ``task_bytes`` asks for, and over all
    cores at least; there is no task without an archive. ``payloads=False`` checks payloads
    and leaves them out.
    """
    size = F.col("bytes") if "bytes" in manifest.columns else F.lit(0)
    listed = manifest.select("path", size.cast("long").alias("bytes"))
    placed = with_positions(listed, [F.desc("bytes"), F.col("path")], "place")
    n, total = placed.agg(F.count("*"), F.sum("bytes")).first()
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(cores, -(-(total or 0) // task_bytes))))
    spread = placed.select("path", F.pmod("place", F.lit(tasks)).cast("int").alias("task"))
    spread = spread.repartitionById(tasks, "task").select("path")
    return spread.mapInArrow(lambda batches: _read(batches, payloads), RECORD_SQL)
