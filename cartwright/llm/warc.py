"""WARC records in ZIP packages, written by Spark and read back record by record."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.common import join_counted, saved

#: Tasks that read records; with more blocks each takes several.
MOST_TASKS = 50_000

ARCHIVE, INDEX = b"archive/data.warc.gz", b"indexes/index.cdxj"

# A gzip header with a comment of one newline, without that newline and its zero byte.
_GZIP = b"\x1f\x8b\x08\x10\x00\x00\x00\x00\x00\xff"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _local_header(name: bytes) -> bytes:
    """Of a stored member whose sizes follow it, in the 64-bit form."""
    most = 0xFFFFFFFF
    extra = struct.pack("<HHQQ", 1, 16, 0, 0)
    fixed = struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 8, 0, 0, 0x21, 0, most, most, len(name), len(extra))
    return fixed + name + extra


def _descriptor(crc: int, size: int) -> bytes:
    return struct.pack("<IIQQ", 0x08074B50, crc, size, size)


def _directory(members: list[tuple[bytes, int, int, int]], at: int) -> bytes:
    """Central directory, ZIP64 records and the end record with a comment of one byte to follow."""
    most, entries = 0xFFFFFFFF, b""
    for name, offset, crc, size in members:
        extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
        entries += struct.pack(
            "<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 8, 0, 0, 0x21, crc, most, most,
            len(name), len(extra), 0, 0, 0, 0, most,
        ) + name + extra
    n, size = len(members), len(entries)
    end64 = struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, at)
    locator = struct.pack("<IIQI", 0x07064B50, 0, at + size, 1)
    end = struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, most, most, 1)
    return entries + end64 + locator + end


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries the response's headers without its payload."""
    name = lambda page: f"<urn:x-page:{'' if page is None else page}>"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _deflated(data: bytes) -> bytes:
    """The rest of a gzip member after its comment's newline."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    return b"\0" + packer.compress(data) + packer.flush() + struct.pack(
        "<II", zlib.crc32(data), len(data) & 0xFFFFFFFF
    )


class _Member:
    """Keeps count of a member's bytes."""

    def __init__(self, name: bytes, offset: int):
        self.name, self.offset, self.crc, self.size = name, offset, 0, 0

    def add(self, data: bytes) -> bytes:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        return data

    def entry(self) -> tuple[bytes, int, int, int]:
        return self.name, self.offset, self.crc, self.size


def _package(rows: Iterator[tuple]) -> Iterator[bytes]:
    """The lines of one ZIP package: its bytes, cut after newlines, without these newlines.

    Every gzip member has a comment of one newline, so a line ends inside every gzip header; the
    index has lines anyway; and the package ends with a comment of one newline.
    """
    archive, index = _Member(ARCHIVE, 0), []
    pending = _local_header(ARCHIVE)
    for page_id, url, html, digest, refers_to in rows:
        packed = _deflated(record(page_id, url, html, digest, refers_to))
        entry = {"page_id": page_id, "url": url, "digest": f"sha1:{digest}", "offset": archive.size}
        archive.add(_GZIP + b"\n")
        yield pending + _GZIP
        archive.add(packed)
        pending = packed
        index.append(json.dumps(entry | {"length": archive.size - entry["offset"]}))
    if not index:
        return
    pending += _descriptor(archive.crc, archive.size)
    start = len(_local_header(ARCHIVE)) + archive.size + 24
    listing = _Member(INDEX, start)
    pending += _local_header(INDEX)
    for line in index:
        yield pending + listing.add(line.encode() + b"\n")[:-1]
        pending = b""
    end = start + len(_local_header(INDEX)) + listing.size + 24
    yield _descriptor(listing.crc, listing.size) + _directory([archive.entry(), listing.entry()], end)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write ``page_id``, ``url`` and ``html`` of every row as WARC records in ZIP packages in ``folder``.

    Each task writes one package: a stored member of gzipped records and a stored index. Of records
    with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is a
    response, as are all that share this id, and the others are revisits of it.

    The bytes go through Spark's text writer, line by line, so they reach any file system that
    Spark writes to, and a task that is run again commits its package once. Payloads are compared by
    SHA-1. The largest ids are aggregated before they shuffle. The pages of the most frequent payloads
    aren't shuffled, so none fills one task.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    least = F.length("payload") >= min_bytes
    latest = hashed.filter(least).groupBy("sha1").agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
    latest = saved(latest.filter("n > 1"), "payloads")
    joined = join_counted(hashed, latest, ["sha1"], "left")
    refers = F.when(~F.col("latest").eqNullSafe(F.col("page_id")), F.col("latest"))
    rows = joined.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for page_id, url, data, sha1, latest_id in zip(*(column.to_pylist() for column in batch.columns)):
                    yield page_id, url, data, base64.b32encode(bytes.fromhex(sha1)).decode(), latest_id

        held, size = [], 0
        for line in _package(each()):
            held.append(line)
            size += len(line)
            if size > 4_000_000:
                yield _lines(held)
                held, size = [], 0
        if held:
            yield _lines(held)

    rows.mapInArrow(run, "value string").write.text(folder, lineSep="\n")


def _lines(held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).view(pa.string())], ["value"])


def open_file(path: str) -> pa.NativeFile:
    """A file of the shared store for reading at any offset."""
    if path.startswith("file:/"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    system, name = pa.fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def zip_members(file: pa.NativeFile, length: int) -> dict[str, tuple[int, int]]:
    """(offset of the data, size) of every stored member, from the central or ZIP64 directory."""

    def at(offset: int, size: int) -> bytes:
        file.seek(offset)
        return file.read(size)

    tail_at = max(0, length - 22 - 65535)
    tail = at(tail_at, length - tail_at)
    # A comment may hold the mark too: the right one is followed by just its comment.
    end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, offset = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFFFFFF in (size, offset) or count == 0xFFFF:
        mark, _, record_at, _ = struct.unpack("<IIQI", at(tail_at + end - 20, 20))
        if mark != 0x07064B50:
            raise ValueError("no ZIP64 locator")
        count, size, offset = struct.unpack_from("<QQQ", at(record_at, 56), 32)
    directory, place, members = at(offset, size), 0, {}
    for _ in range(count):
        method, packed, full = (*struct.unpack_from("<H", directory, place + 10), *struct.unpack_from("<II", directory, place + 20))
        name_size, extra_size, comment_size = struct.unpack_from("<HHH", directory, place + 28)
        start = struct.unpack_from("<I", directory, place + 42)[0]
        name = directory[place + 46 : place + 46 + name_size].decode()
        extra = directory[place + 46 + name_size : place + 46 + name_size + extra_size]
        wide = _wide_fields(extra)
        full = wide.pop(0) if full == 0xFFFFFFFF else full
        packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
        start = wide.pop(0) if start == 0xFFFFFFFF else start
        if method == 0:
            local = at(start, 30)
            members[name] = start + 30 + sum(struct.unpack_from("<HH", local, 26)), packed
        place += 46 + name_size + extra_size + comment_size
    return members


def _wide_fields(extra: bytes) -> list[int]:
    place = 0
    while place + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, place)
        if kind == 1:
            return list(struct.unpack_from(f"<{size // 8}Q", extra, place + 4))
        place += 4 + size
    return []


def _list_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, offset, length) of every record that the indexes of packages name."""
    for batch in batches:
        for path, length in batch.itertuples(index=False):
            with open_file(path) as file:
                members = zip_members(file, length)
                data_at = members[ARCHIVE.decode()][0]
                at, left = members[INDEX.decode()]
                file.seek(at)
                rest = b""
                while left:
                    piece = file.read(min(left, 1 << 20))
                    left -= len(piece)
                    *lines, rest = (rest + piece).split(b"\n")
                    entries = [json.loads(line) for line in lines]
                    yield pd.DataFrame(
                        [(path, data_at + e["offset"], e["length"]) for e in entries],
                        columns=["path", "offset", "length"],
                    )


_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$")


def _fields(head: bytes) -> dict[str, str]:
    found = (_FIELD.match(line) for line in head.split(b"\r\n")[1:])
    return {m[1].decode().lower(): m[2].decode() for m in found if m}


def parse_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of a WARC record.

    A response's payload is measured and must have the digest that the record states. A revisit's
    length is that in the HTTP headers it repeats.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    number = lambda name: int(v) if (v := name.strip("<>").rpartition(":")[2]) else None
    refers_to = None
    if fields["warc-type"] == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    else:
        size = int(_fields(http)["content-length"])
        refers_to = number(fields["warc-refers-to"])
    page = number(fields["warc-record-id"])
    return page, size, digest, fields["warc-type"], refers_to, fields.get("warc-target-uri")


def _read_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    file, opened = None, None
    for batch in batches:
        rows = []
        for path, offset, length in batch.itertuples(index=False):
            if path != opened:
                file, opened = open_file(path), path
            file.seek(offset)
            rows.append(parse_record(zlib.decompress(file.read(length), 31)))
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        frame = pd.DataFrame(rows, columns=names)
        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, folder: str, block_bytes: int = 16 << 20) -> DataFrame:
    """Read every record of the ZIP packages in ``folder`` by its range, without extracting anything.

    Each package's directory and index are read first; then records are dealt out in runs of about
    ``block_bytes`` of a package, and each is fetched by its offset and length. There are as many tasks as
    the archives have blocks, MOST_TASKS at most. Returns page_id,
    payload_bytes, payload_digest, record_type, refers_to, url. Files of no bytes hold nothing. The
    folder must be on a file system that pyarrow opens on the executors.
    """
    packages = spark.read.format("binaryFile").load(folder).select("path", "length").filter("length > 0")
    total = packages.agg(F.sum("length")).first()[0] or 0
    # Numbers, as the rows are too narrow for adaptive execution to see what they stand for.
    tasks = min(MOST_TASKS, max(1, -(-total // block_bytes)))
    listed = packages.repartition(tasks, "path").mapInPandas(_list_records, "path string, offset long, length long")
    block = F.floor(F.col("offset") / block_bytes)
    dealt = listed.repartition(tasks, "path", block).sortWithinPartitions("path", "offset")
    return dealt.mapInPandas(
        _read_records,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string",
    )


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as archives into ``folder`` and read them back.

    One row per input row. NULL html is an empty payload; a NULL url is left out of its record; a
    NULL page_id is no largest id, and its record is a revisit if an equal payload has an id. Repeated
    rows are records each. Payloads may be of any length that fits a row; other columns don't matter.
    An empty table gives no rows.
    """
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
