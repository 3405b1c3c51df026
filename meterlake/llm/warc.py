"""WARC archives: a writer with revisit records and a salvage reader.

Writer: each record is one gzip member with a payload and a block digest. Of records with equal payloads of a least size, the one with
the smallest page id carries the payload, the others refer to it. Partitions write files of bounded size and
report them; files of failed attempts are never listed, so a repeated task does no harm.

Salvage reader: every member is checked (gzip checksum, version line, length, closing line ends, block digest). After a failed check
it searches for the next gzip magic or version line at which a whole valid record starts, logs the bytes between as a quarantined gap and goes on.
The same search runs over the inflated bytes of a member, also over those before a damage.
Files are memory-mapped; a task holds one inflated member at a time.

NULL payloads are empty. NULL ids and URLs have no header and come back NULL; rows with equal ids and payloads are all responses.
Control characters in URLs are percent-encoded. An empty table writes no archives and reads none.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import filesystem, mapped, stored
from meterlake.session import scratch_path

LEAST_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
CRAWLED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"


def roles(pages: DataFrame, page_id: str = "page_id", payload: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Adds ``payload_bytes``, ``payload_digest`` and ``refers_to``: the page whose payload a row repeats, else NULL."""
    content = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    sized = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        content.alias("payload"),
        (F.col("`url`").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
        F.octet_length(content).cast("long").alias("payload_bytes"),
        F.sha2(content, 256).alias("payload_digest"),
    )
    groups = (
        sized.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) & F.col("_first").isNotNull())
        .select("_digest", "_first")
    )
    joined = sized.join(groups, F.col("payload_digest") == F.col("_digest"), "left")
    repeats = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.withColumn("refers_to", F.when(repeats, F.col("_first"))).drop("_digest", "_first")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {CRAWLED}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + END + block + END


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of :func:`roles` as archives in the shared folder; returns the stored list ``path, records, bytes``."""
    folder = scratch_path(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", "payload", "payload_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = filesystem(folder)
        system.create_dir(place, recursive=True)
        out, path, records, size = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"path": pa.array([f"{folder}/{path}"]), "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())}
            )

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{place}/{path}", compression=None)
                data = member(record(page_id, url, payload.encode(), digest, refers_to))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield listed()
        if out is not None:
            out.close()
            yield listed()

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-list")


class Broken(ValueError):
    """A failed check."""


def parsed(data, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the uncompressed record at a place, or :class:`Broken`."""
    if bytes(data[at : at + len(VERSION)]) != VERSION:
        raise Broken("no version line")
    size = len(data)
    stop = (data.obj if isinstance(data, memoryview) else data).find(END, at)
    if stop < 0:
        raise Broken("unfinished header")
    head = bytes(data[at:stop])
    headers = {}
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("malformed header")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise Broken("no length")
    begin = at + len(head) + len(END)
    end = begin + int(length)
    if end + len(END) > size or bytes(data[end : end + len(END)]) != END:
        raise Broken("wrong length")
    block = bytes(data[begin:end])
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        raise Broken("block digest")
    return headers, block, end + len(END)


def inflated(data, at: int) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member at a place; with a reason, what could be inflated before the damage."""
    unpacker, out, stop = zlib.decompressobj(31), [], at
    while not unpacker.eof:
        chunk = bytes(data[stop : stop + (1 << 16)])
        if not chunk:
            return b"".join(out), stop, "unfinished member"
        spare = unpacker.copy()
        try:
            out.append(unpacker.decompress(chunk))
        except zlib.error:
            try:
                for k in range(len(chunk)):
                    out.append(spare.decompress(chunk[k : k + 1]))
            except zlib.error:
                pass
            return b"".join(out), stop, "damaged member"
        stop += len(chunk)
    return b"".join(out), stop - len(unpacker.unused_data), None


def inner(content: bytes, damaged: bool) -> tuple[list[tuple], int]:
    """Valid records and gaps of a member's content, as ``(start, end, headers, block, reason)``, and the number of records.
    In a damaged member only records with a matching block digest are valid."""
    found, at, n, begin, reason = [], 0, 0, None, None
    while 0 <= at < len(content):
        try:
            headers, block, end = parsed(content, at)
            if damaged and not headers.get("warc-block-digest", "").startswith("sha256:"):
                raise Broken("no block digest")
        except Broken as error:
            if begin is None:
                begin, reason = at, str(error)
            at = content.find(VERSION, at + 1)
            continue
        if begin is not None:
            found.append((begin, at, None, None, reason))
            begin = None
        found.append((at, end, headers, block, None))
        at, n = end, n + 1
    if begin is not None:
        found.append((begin, len(content), None, None, reason))
    return found, n


def records_at(data, at: int) -> tuple[list[tuple], int, str | None]:
    """What starts at a place, at least one valid record of it, where it ends, and a reason if it is a damaged member."""
    if bytes(data[at : at + len(MAGIC)]) != MAGIC:
        headers, block, end = parsed(data, at)
        return [(at, end, headers, block, None)], end, None
    content, end, damage = inflated(data, at)
    found, n = inner(content, damage is not None)
    if not n:
        raise Broken(damage or (found[0][4] if found else "empty member"))
    if damage and found[-1][2] is None:
        # the rest belongs to the gap of the damage
        found.pop()
    told = []
    for a, b, headers, block, reason in found:
        told.append((at, end, headers, block, None if reason is None else f"{reason}, inflated bytes {a} to {b}"))
    if damage:
        damage = f"{damage}, from inflated byte {found[-1][1]}"
    return told, end, damage


def salvage(data) -> Iterator[tuple]:
    """``(start, end, headers, block, None)`` per valid record, ``(start, end, None, None, reason)`` per quarantined gap, in order. Records and gaps
    inside a member carry the member's place; a gap's reason then names its inflated bytes."""
    raw = data.obj if isinstance(data, memoryview) else data
    at, size = 0, len(data)
    while at < size:
        found, reason = [], None
        try:
            found, end, reason = records_at(data, at)
        except Broken as error:
            reason = str(error)
        yield from found
        if reason is None:
            at = end
            continue
        begin, candidate = at, at
        while True:
            nearest = [p for p in (raw.find(MAGIC, candidate + 1), raw.find(VERSION, candidate + 1)) if p >= 0]
            if not nearest:
                at = size
                break
            candidate = min(nearest)
            try:
                records_at(data, candidate)
            except Broken:
                continue
            at = candidate
            break
        yield begin, at, None, None, reason


def page_of(name: str | None) -> int | None:
    return int(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


READ = (
    "path string, start long, stop long, gap string, page_id long, url string, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def read(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the listed archives; ``gap`` is the failed check, NULL for records. A revisit's size and digest
    are those its headers give for the full payload; a response's are taken from its payload."""
    n = max(1, archives.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in READ.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in READ.split(", ")]

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for start, stop, headers, block, gap in salvage(mapped(path)):
                    if headers is None:
                        rows.append((path, start, stop, gap, *[None] * 7))
                    else:
                        http, _, payload = block.partition(END)
                        kind = headers.get("warc-type")
                        length = len(payload)
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        if kind == "revisit":
                            sizes = [v for k, _, v in (h.partition(b":") for h in http.split(b"\r\n")) if k.lower() == b"content-length"]
                            length = int(sizes[0]) if sizes else None
                        else:
                            digest = hashlib.sha256(payload).hexdigest()
                        url = headers.get("warc-target-uri")
                        refers = page_of(headers.get("warc-refers-to"))
                        rows.append(
                            (path, start, stop, None, page_of(headers.get("warc-record-id")), url, kind, refers, length, digest, payload if with_payload else None)
                        )
                        held += len(payload) if with_payload else 0
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield told(rows)
                        rows, held = [], 0
                if rows:
                    yield told(rows)

    return archives.select("path").repartition(n, "path").mapInArrow(run, READ)
