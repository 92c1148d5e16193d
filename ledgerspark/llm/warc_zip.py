"""WARC archives packaged in ZIP files: written by tasks, read by ranges.

A package holds the archive (one gzip member per record) and an index as *stored* ZIP
members, so that a record is a range of bytes of the package. The reader parses the ZIP
directory, finds where the stored members begin, takes the record ranges from the index and
reads only those; nothing is extracted. An index has JSON lines, CDXJ lines or CDX fields,
plain or in gzip members, and may itself be a deflated ZIP member. An archive without an
index is read from its begin to its end in chunks. Files are opened through Arrow's file
systems by URI, in the shared folder that the caller names.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.quality import own_exchange
from ledgerspark.session import materialize

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"

# Signatures and sizes of the ZIP format (fixed values).
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ReadAt = Callable[[int, int], bytes]  # offset, length


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header: int  # offset of the local header


def _zip64_extra(extra: bytes) -> bytes:
    """Body of the ZIP64 field among extra fields; empty without it."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return extra[at + 4 : at + 4 + length]
        at += 4 + length
    return b""


def zip_directory(read: ReadAt, size: int) -> list[Member]:
    """Members of the central directory of a ZIP file, with or without ZIP64 records."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:
        # The comment may hold the signature; the right record ends the file.
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("Not a ZIP file: no end of central directory.")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    end_at = tail_at + at
    if end_at >= 20 and (count == FULL16 or FULL32 in (length, offset)):
        locator = read(end_at - 20, 20)
        if locator[:4] == LOCATOR64:
            end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end64[:4] != END64:
                raise ValueError("Damaged ZIP file: ZIP64 end record not found.")
            count, length, offset = struct.unpack_from("<QQQ", end64, 32)
    directory = read(offset, length)
    members, at = [], 0
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("Damaged ZIP file: central directory ends early.")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, full, n, m, k = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        wide = _zip64_extra(directory[at + 46 + n : at + 46 + n + m])
        values = []
        for value in (full, stored, header):  # in the order of the ZIP64 field
            if value == FULL32:
                if len(wide) < 8:
                    raise ValueError("Damaged ZIP file: ZIP64 field is short.")
                value, wide = struct.unpack_from("<Q", wide)[0], wide[8:]
            values.append(value)
        members.append(Member(name, method, values[0], values[1], values[2]))
        at += 46 + n + m + k
    return members


def stored_range(read: ReadAt, member: Member) -> tuple[int, int]:
    """Offset and length of a stored member's bytes in the package."""
    if member.method != 0 or member.size != member.stored_size:
        raise ValueError(f"{member.name} is compressed; only stored members are read by range.")
    return _member_range(read, member)


def _member_range(read: ReadAt, member: Member) -> tuple[int, int]:
    """Offset and length of a member's bytes as they lie in the package."""
    header = read(member.header, 30)
    if header[:4] != LOCAL:
        raise ValueError(f"Damaged ZIP file: no local header of {member.name}.")
    n, m = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n + m, member.stored_size


def zip_package(members: list[tuple[str, bytes]]) -> list[bytes]:
    """The chunks of a ZIP file of stored members, with ZIP64 records throughout."""
    chunks, directory, at = [], [], 0
    for name, data in members:
        raw, crc = name.encode(), zlib.crc32(data)
        wide = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        common = struct.pack("<HHHHHIII", 45, 0x800, 0, 0, 0x21, crc, FULL32, FULL32)
        chunks += [LOCAL + common + struct.pack("<HH", len(raw), len(wide)) + raw + wide, data]
        wide = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        directory.append(
            CENTRAL + struct.pack("<H", 45) + common
            + struct.pack("<HHHHHII", len(raw), len(wide), 0, 0, 0, 0, FULL32) + raw + wide
        )
        at += len(chunks[-2]) + len(data)
    body = b"".join(directory)
    n = len(directory)
    end = END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(body), at)
    end += LOCATOR64 + struct.pack("<IQI", 0, at + len(body), 1)
    end += END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    return [*chunks, body, end]


def _head(lines: list[tuple[str, str | None]], first: str) -> bytes:
    fields = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None)
    return f"{first}\r\n{fields}\r\n".encode()


def warc_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One record. A revisit has the HTTP head, with the full length, but no payload."""
    http = _head(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
        "HTTP/1.1 200 OK",
    )
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = _head(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Profile", REVISIT_PROFILE if revisit else None),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))),
        ],
        "WARC/1.1",
    )
    return head + block + b"\r\n\r\n"


def _parse_head(data: bytes) -> tuple[str, dict[str, str], int]:
    """First line, fields by lower-case name, and where the body begins."""
    end = data.index(b"\r\n\r\n")
    first, *lines = data[:end].decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return first, fields, end + 4


def parse_record(data: bytes) -> dict:
    """Fields of one uncompressed record; ``payload`` is None for a revisit.

    Of a response over HTTP the payload is what follows the HTTP head, else the whole block.
    A payload that does not have the digest of its record is an error; digests other than
    SHA-1 and SHA-256, and bodies in a transfer encoding, are not compared. ``payload_digest``
    is bare for SHA-256 and keeps its label otherwise.
    """
    version, fields, begin = _parse_head(data)
    if not version.startswith("WARC/"):
        raise ValueError("Not a WARC record.")
    block = data[begin : begin + int(fields["content-length"])]
    kind = fields.get("warc-type")
    http, body = {}, 0
    if kind in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
        _, http, body = _parse_head(block)
    payload = None if kind == "revisit" else block[body:]

    def page(name: str) -> str | None:
        return fields.get(name, "").strip("<>").removeprefix("urn:page:") or None

    label = fields.get("warc-payload-digest")
    if payload is not None and label and "transfer-encoding" not in http and not _digest_fits(label, payload):
        raise ValueError(f"Payload of {page('warc-record-id')} is damaged.")
    length = http.get("content-length", "") if payload is None else str(len(payload))
    return {
        "record_id": page("warc-record-id"),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": page("warc-refers-to"),
        "payload_digest": label and label.removeprefix("sha256:"),
        "payload_bytes": int(length) if length.isdecimal() else None,
        "payload": payload,
    }


# Lengths of the digests that are checked, by algorithm.
DIGESTS = {"sha1": 20, "sha256": 32}


def _digest_fits(label: str, payload: bytes) -> bool:
    """Whether a ``name:value`` digest is the payload's; true for algorithms not checked.

    Values are hexadecimal or base32, as other writers use the one or the other.
    """
    name, _, value = label.partition(":")
    size = DIGESTS.get(name.lower())
    if size is None:
        return True
    try:
        wanted = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper())
    except (ValueError, binascii.Error):
        return False
    return hashlib.new(name.lower(), payload).digest() == wanted


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def with_revisits(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100
) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response).

    Only contents that repeat are joined back; they are counted on the map side first and
    have an exchange of their own, so that adaptive execution splits a content that many
    pages share.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return rows.join(own_exchange(repeated), "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )


def write_packages(
    records: DataFrame, folder: str, package_bytes: int = 8_000_000, date: str = "2000-01-01T00:00:00Z"
) -> DataFrame:
    """Write packages of about so many bytes; a stored table of path, n_bytes, n_records.

    ``records`` as from :func:`with_revisits`. Names are unique to the task's attempt and
    only those of attempts that succeeded are in the result, so a lost executor leaves at
    most a file that nobody reads. An empty table gives no package.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        archive, index, size = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal archive, index, size
            name = f"{uuid.uuid4().hex}.wacz"
            lines = "".join(json.dumps(x) + "\n" for x in index).encode()
            chunks = zip_package([(ARCHIVE, b"".join(archive)), (INDEX, lines)])
            with filesystem.open_output_stream(f"{root}/{name}") as stream:
                for chunk in chunks:
                    stream.write(chunk)
            row = [f"{folder}/{name}"], [sum(map(len, chunks))], [len(index)]
            archive, index, size = [], [], 0
            return pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["path", "n_bytes", "n_records"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                packer = zlib.compressobj(1, wbits=31)
                data = packer.compress(warc_record(*row, date)) + packer.flush()
                index.append({"member": ARCHIVE, "offset": size, "length": len(data)})
                archive.append(data)
                size += len(data)
                if size >= package_bytes:
                    yield close()
        if index:
            yield close()

    written = records.select("page_id", "url", "payload", "digest", "refers_to")
    return materialize(
        written.mapInArrow(run, "path string, n_bytes bigint, n_records bigint"), "packages"
    )


def _splits(split_bytes: int):
    """Ranges of whole records from the packages' indexes; a member without index is one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, name = _filesystem(path)
                with filesystem.open_input_file(name) as file:
                    rows = list(_package_splits(file, split_bytes))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(rows)),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    ],
                    ["path", "begin", "size", "lengths"],
                )

    return run


def member_bytes(read: ReadAt, member: Member) -> bytes:
    """Content of a small member, stored or deflated."""
    begin, size = _member_range(read, member)
    data = read(begin, size)
    if member.method == 0:
        return data
    if member.method != 8:
        raise ValueError(f"{member.name}: compression method {member.method} is not known.")
    return zlib.decompress(data, wbits=-15)


def _gunzipped(data: bytes) -> bytes:
    """Content of all gzip members of ``data``."""
    parts, view = [], memoryview(data)
    while len(view):
        unpacker = zlib.decompressobj(wbits=31)
        parts.append(unpacker.decompress(view))
        if not unpacker.eof:
            raise ValueError("Damaged index: a gzip member ends early.")
        view = view[len(view) - len(unpacker.unused_data) :]
    return b"".join(parts)


def index_entries(name: str, data: bytes) -> Iterator[tuple[str, int, int]]:
    """Archive file, offset and length of each record that an index names.

    Lines are JSON objects, CDXJ (key, time, JSON), or CDX fields as the head line orders
    them (g: file, V: offset, S: length). Lines that begin with ``!`` and entries without an
    offset are left out; so are ``.idx`` files, which only point into another index.
    """
    if name.endswith(".idx"):
        return
    if data[:2] == b"\x1f\x8b":
        data = _gunzipped(data)
    fields: list[str] = []
    for line in data.decode("utf-8").splitlines():
        if not line.strip() or line.startswith("!"):
            continue
        if line.lstrip().startswith("CDX "):
            fields = line.split()[1:]
            continue
        if fields:
            values = dict(zip(fields, line.split(" ")))
            place = values.get("g"), values.get("V"), values.get("S")
        else:
            at = line.find("{")
            if at < 0:
                raise ValueError(f"{name}: a line is neither JSON nor CDXJ: {line[:80]!r}")
            entry = json.loads(line[at:])
            place = entry.get("member", entry.get("filename")), entry.get("offset"), entry.get("length")
        if None not in place and "-" not in place:
            yield place[0], int(place[1]), int(place[2])


def _package_splits(file, split_bytes: int) -> Iterator[tuple[int, int, list[int]]]:
    def read(offset: int, length: int) -> bytes:
        return file.read_at(length, offset)

    members = {m.name: m for m in zip_directory(read, file.size())}
    # Several indexes may name the same record.
    ranges: dict[str, set[tuple[int, int]]] = {
        name: set() for name in members if name.endswith((".warc.gz", ".warc"))
    }
    for name, member in members.items():
        if name.startswith("indexes/"):
            for archive, offset, length in index_entries(name, member_bytes(read, member)):
                # Indexes of other writers give the file's name below archive/.
                held = archive if archive in ranges else f"archive/{archive}"
                if held not in ranges:
                    raise ValueError(f"{name} names {archive}, which the package does not hold.")
                ranges[held].add((offset, length))
    for name, places in ranges.items():
        base, size = stored_range(read, members[name])
        if not places:
            if size:
                yield base, size, []
            continue
        records = sorted(places)
        lengths: list[int] = []
        begin = end = records[0][0]
        for offset, length in records:
            if lengths and (offset != end or end - begin >= split_bytes):
                yield base + begin, end - begin, lengths
                begin, lengths = offset, []
            lengths.append(length)
            end = offset + length
        yield base + begin, end - begin, lengths


class _Chunks:
    """Bytes of a range of a file, read in chunks and taken from the front."""

    def __init__(self, read: ReadAt, begin: int, size: int, chunk: int = 1 << 20) -> None:
        self.read, self.at, self.end, self.chunk = read, begin, begin + size, chunk
        self.held, self.used = b"", 0

    def more(self) -> bool:
        """Read another chunk behind what is held; false at the end."""
        data = self.read(self.at, min(max(self.chunk, len(self.held) - self.used), self.end - self.at))
        if not data:
            return False
        self.at += len(data)
        self.held, self.used = self.held[self.used :] + data, 0
        return True

    def have(self, n: int) -> bool:
        while len(self.held) - self.used < n:
            if not self.more():
                return False
        return True

    def take(self, n: int) -> bytes:
        self.used += n
        return self.held[self.used - n : self.used]

    def find(self, mark: bytes) -> int:
        """Where the mark begins, counted from the front; -1 without it."""
        start = 0
        while True:
            at = self.held.find(mark, self.used + start)
            if at >= 0:
                return at - self.used
            start = max(0, len(self.held) - self.used - len(mark) + 1)
            if not self.more():
                return -1


def unindexed(read: ReadAt, begin: int, size: int, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Records of a range without index, one at a time: gzip members, or plain by their length.

    Holds one record and about one chunk; the time grows with the range.
    """
    data = _Chunks(read, begin, size, chunk)
    while data.have(1):
        if data.have(2) and data.held[data.used : data.used + 2] == b"\x1f\x8b":
            unpacker, parts = zlib.decompressobj(wbits=31), []
            while not unpacker.eof:
                if not data.have(1):
                    raise ValueError("Damaged archive: a gzip member ends early.")
                piece = data.take(min(len(data.held) - data.used, 1 << 16))
                parts.append(unpacker.decompress(piece))
            data.used -= len(unpacker.unused_data)
            raw = b"".join(parts)
            # A member is one record by the standard; others may have put several into it.
            yield from unindexed(lambda o, n, raw=raw: raw[o : o + n], 0, len(raw), len(raw))
        else:
            head = data.find(b"\r\n\r\n")
            if head < 0:
                raise ValueError("Damaged archive: a record's head does not end.")
            _, fields, body = _parse_head(data.held[data.used : data.used + head + 4])
            length = body + int(fields["content-length"]) + 4
            if not data.have(length):
                raise ValueError("Damaged archive: a record ends early.")
            yield data.take(length)


RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _raw_records(file, begin: int, size: int, lengths: list[int]) -> Iterator[bytes]:
    """Uncompressed records of a range: as the lengths of its index say, else one after another."""

    def read(offset: int, length: int) -> bytes:
        return file.read_at(length, offset)

    if not lengths:
        yield from unindexed(read, begin, size)
        return
    data, at = read(begin, size), 0
    for length in lengths:
        piece = data[at : at + length]
        at += length
        yield from unindexed(lambda o, n, piece=piece: piece[o : o + n], 0, len(piece))


def _records(with_payload: bool, batch_bytes: int = 8_000_000):
    names = RECORD.names if with_payload else RECORD.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, *place in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "size", "lengths"))):
                filesystem, name = _filesystem(path)
                with filesystem.open_input_file(name) as file:
                    rows, held = [], 0
                    for raw in _raw_records(file, *place):
                        try:
                            record = parse_record(raw)
                        except ValueError as damage:
                            raise ValueError(f"{path}: {damage}") from damage
                        held += 500 + (len(raw) if with_payload else 0)
                        if not with_payload:
                            record["payload"] = None
                        rows.append(record)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, RECORD).select(names)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, RECORD).select(names)

    return run


def read_packages(packages: DataFrame, split_bytes: int = 4_000_000, with_payload: bool = True) -> DataFrame:
    """Records of the packages in ``path``; ``n_bytes`` tells how many tasks to use.

    record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes and, on
    demand, payload. Payloads are held against their digest; a revisit's length is that of
    its HTTP head, null without one. A package is split at records, so a large one is read by
    many tasks; of an archive that an index names, the named records are read. An archive
    without an index is read by one task, in chunks. No package gives no record.
    """
    total = packages.agg(F.sum("n_bytes")).first()[0] or 0
    count = packages.count()
    tasks = max(1, -(-total // split_bytes))
    ranges = packages.select("path").repartition(max(1, min(count, tasks))).mapInArrow(
        _splits(split_bytes), "path string, begin bigint, size bigint, lengths array<bigint>"
    )
    schema = (
        "record_id string, record_type string, target_uri string, refers_to string, "
        "payload_digest string, payload_bytes bigint"
    )
    return ranges.repartition(tasks).mapInArrow(
        _records(with_payload), schema + (", payload binary" if with_payload else "")
    )


def archive_round_trip(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as read from packages.

    Null html is an empty payload, a null url has no target, a null id an empty record id.
    Of equal payloads of 100 bytes or more the smallest id is a response and the others
    revisit it; rows that repeat that id are responses too, and so are all rows of a group
    without any id. Further columns are ignored.
    """
    packages = write_packages(with_revisits(pages, page_id, url, html), folder)
    kind = pages.schema[page_id].dataType
    return read_packages(packages, with_payload=False).select(
        F.col("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
