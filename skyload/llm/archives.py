"""WARC records in ZIP packages: a writer, and a reader that fetches single records by range.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, whose records are gzipped one
by one, and ``indexes/index.cdxj``, a line for each record with its place in the first. The reader takes
the central directory from the end of the file (the ZIP64 one where there is one), finds where stored
members begin, and reads the index and then the records by range; nothing is unpacked to a file.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.session import shared_folder, stable

WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# A payload of fewer bytes is written again each time.
REVISIT_BYTES = 100
# A package is closed once its records have so many bytes; neighbouring records are read at once up to so many.
PACKAGE_BYTES = 64 << 20
READ_BYTES = 1 << 20

# Fixed values of the ZIP format: signatures and layouts after them.
END, END_LAYOUT = b"PK\x05\x06", "<HHHHIIH"
END64_PLACE, END64_PLACE_LAYOUT = b"PK\x06\x07", "<IQI"
END64, END64_LAYOUT = b"PK\x06\x06", "<QHHIIQQQQ"
ENTRY, ENTRY_LAYOUT = b"PK\x01\x02", "<HHHHHHIIIHHHHHII"
LOCAL, LOCAL_LAYOUT = b"PK\x03\x04", "<HHHHHIIIHH"


@dataclass(frozen=True)
class Member:
    """A file in a ZIP package: name, compression method, packed size and where its local header is."""

    name: str
    method: int
    size: int
    header: int


def _zip64(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int]:
    """Packed size and header place, with those that did not fit in 32 bits taken from the extra field."""
    while len(extra) >= 4:
        kind, length = struct.unpack_from("<HH", extra)
        if kind == 1:
            numbers = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
            size = next(numbers) if size == 0xFFFFFFFF else size
            packed = next(numbers) if packed == 0xFFFFFFFF else packed
            header = next(numbers) if header == 0xFFFFFFFF else header
        extra = extra[4 + length :]
    return packed, header


def read_directory(file: pa.NativeFile) -> list[Member]:
    """The members that a package's central directory lists."""
    total = file.size()
    tail_at = max(0, total - (1 << 16) - 22 - 20)
    tail = file.read_at(total - tail_at, tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP package, or a cut one")
    _, _, _, count, size, at, _ = struct.unpack_from(END_LAYOUT, tail, end + 4)
    if end >= 20 and tail[end - 20 : end - 16] == END64_PLACE:
        _, place, _ = struct.unpack_from(END64_PLACE_LAYOUT, tail, end - 16)
        record = file.read_at(4 + struct.calcsize(END64_LAYOUT), place)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory where its locator points")
        *_, count, size, at = struct.unpack_from(END64_LAYOUT, record, 4)
    directory, members, i = file.read_at(size, at), [], 0
    for _ in range(count):
        if directory[i : i + 4] != ENTRY:
            raise ValueError("broken central directory")
        _, _, flags, method, _, _, _, packed, full, n, m, k, _, _, _, header = struct.unpack_from(ENTRY_LAYOUT, directory, i + 4)
        name_at = i + 4 + struct.calcsize(ENTRY_LAYOUT)
        name = directory[name_at : name_at + n].decode("utf-8" if flags & 0x800 else "cp437")
        packed, header = _zip64(directory[name_at + n : name_at + n + m], full, packed, header)
        members.append(Member(name, method, packed, header))
        i = name_at + n + m + k
    return members


def member_start(file: pa.NativeFile, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed; ranges can be read from stored members only")
    head = file.read_at(4 + struct.calcsize(LOCAL_LAYOUT), member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    *_, name, extra = struct.unpack_from(LOCAL_LAYOUT, head, 4)
    return member.header + len(head) + name + extra


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, kind: str) -> bytes:
    """One gzipped WARC record."""
    body = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F))).replace("%", "")))
    if kind == "revisit":
        head.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", mtime=0)


def parse_record(packed: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and body of one gzipped record."""
    raw = gzip.decompress(packed)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def plan_records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Pages with what is written of each: (page, url, payload, digest, refers_to).

    Of equal payloads of at least ``least`` bytes the smallest id is written in full.
    """
    payload: Column = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id}`").cast("bigint").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # The smallest page of each digest is found before any payload moves; only digests that repeat are joined.
    firsts = (
        rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "first")
    )
    refers = F.when(F.col("page") != F.col("first"), F.col("first"))
    # Short payloads, such as the empty one that very many pages may have, take no part in the join.
    sent = F.when(F.octet_length("payload") >= least, F.col("digest"))
    named = rows.withColumn("sent", sent).join(firsts.withColumnRenamed("digest", "sent"), "sent", "left")
    return named.select("page", "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write records into packages below ``folder`` (any store that pyarrow opens); their list as (path, records).

    Each attempt of a task writes files of its own; the list has those of the attempts that counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}

        left = rows()
        row = next(left, None)
        while row is not None:
            path, lines, at = f"{root}/{uuid.uuid4().hex}.wacz", [], 0
            with store.open_output_stream(path) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
                with package.open(WARC, "w", force_zip64=True) as data:
                    while row is not None and at < package_bytes:
                        kind = "response" if row["refers_to"] is None else "revisit"
                        packed = _record(row["page"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"], kind)
                        lines.append(json.dumps({"page": row["page"], "offset": at, "length": len(packed), "mime": "text/html" if kind == "response" else "warc/revisit"}))
                        data.write(packed)
                        at += len(packed)
                        row = next(left, None)
                package.writestr(INDEX, "\n".join(lines) + "\n")
            done.append((f"{folder}/{path.rpartition('/')[2]}", len(lines)))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    return stable(records.mapInArrow(run, "path string, records bigint"))


def _index(file: pa.NativeFile) -> tuple[int, list[dict]]:
    members = {m.name: m for m in read_directory(file)}
    for name in (WARC, INDEX):
        if name not in members:
            raise ValueError(f"no {name} in the package")
    text = file.read_at(members[INDEX].size, member_start(file, members[INDEX])).decode()
    return member_start(file, members[WARC]), [json.loads(line) for line in text.splitlines() if line]


def read_records(packages: DataFrame, path: str = "path", payloads: bool = True) -> DataFrame:
    """All records of the packages listed: (page, url, record_type, refers_to, payload_bytes, payload_digest, payload).

    Without ``payloads`` the last is NULL; what the tasks read and check is the same.
    Size and digest of a response are taken from the payload that was read, and a digest unlike
    the one in its header is an error; those of a revisit, which has no payload, from its headers.
    """
    schema = "page bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
    names = [part.split()[0] for part in schema.split(", ")]
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())

    def record(packed: bytes) -> tuple:
        headers, body = parse_record(packed)
        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
        size = int(headers["warc-payload-length"])
        if kind == "response":
            found = hashlib.sha256(body).hexdigest()
            if found != digest:
                raise ValueError(f"payload of {headers['warc-record-id']} has digest {found}, not {digest}")
            size = len(body)
        return (_page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, _page(headers.get("warc-refers-to")), size, digest, body if payloads and kind == "response" else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, place = FileSystem.from_uri(uri)
                with store.open_input_file(place) as file:
                    start, entries = _index(file)
                    i = 0
                    while i < len(entries):
                        last, begin = i + 1, entries[i]["offset"]
                        while last < len(entries) and entries[last]["offset"] + entries[last]["length"] - begin <= READ_BYTES:
                            last += 1
                        end = entries[last - 1]["offset"] + entries[last - 1]["length"]
                        block = file.read_at(end - begin, start + begin)
                        rows = [record(block[e["offset"] - begin : e["offset"] - begin + e["length"]]) for e in entries[i:last]]
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)], names=names)
                        i = last

    listed = packages.select(path)
    spread = listed.repartition(max(1, listed.sparkSession.sparkContext.defaultParallelism))
    return spread.mapInArrow(run, schema)


def read_record(uri: str, page: int) -> tuple[dict[str, str], bytes] | None:
    """The first record of one page, by range from its package."""
    store, place = FileSystem.from_uri(uri)
    with store.open_input_file(place) as file:
        start, entries = _index(file)
        for e in entries:
            if e["page"] == page:
                return parse_record(file.read_at(e["length"], start + e["offset"]))
    return None


def archive_pages(pages: DataFrame, folder: str | None = None, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write pages into packages and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A NULL payload is written as an empty one. A page without id is written in full; pages that share
    the smallest id of a payload all are. Characters that a header cannot hold are percent-encoded in URLs.
    No pages give no packages and no rows; other columns are not looked at.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/packages-{uuid.uuid4().hex}"
    packages = write_packages(plan_records(pages, id, url, html), folder)
    return read_records(packages, payloads=False).select(F.col("page").alias(id), "payload_bytes", "payload_digest", "record_type", "refers_to")
