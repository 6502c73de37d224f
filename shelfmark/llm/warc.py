"""Web archives: writing captures as WARC records, reading them, and assembling transactions.

Every capture is a request, a response or revisit, and a metadata record, tied
by WARC-Concurrent-To.  Tasks write archives of bounded size into the shared
folder, one gzip member per record, and return their names; only archives so
returned are read, so what a lost or repeated task left behind is never seen.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, stored, table, text_slices
from shelfmark.llm.registry import query
from shelfmark.session import scratch_path
from shelfmark.sources.files import open_filesystem

ARCHIVE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("5a4ed1f0-6f0c-4b39-8b7e-0f5d2f6f7a11")

RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, intact boolean, fields map<string,string>, payload binary"
)


def record_id(kind: str, uid: int) -> str:
    return f"<{uuid.uuid5(_NAMES, f'{kind}:{uid}').urn}>"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{name}: {value}" for name, value in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


def _clean(value: str | None) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value or "")


def capture_records(uid: int, page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> list[bytes]:
    """The three records of a capture; ``refers`` is the row whose response a revisit repeats."""
    uri, main = _clean(url), record_id("response", uid)
    host, slash, rest = uri.partition("://")[2].partition("/")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    ask = f"GET {slash}{rest or ('' if slash else '/')} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    got = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    answer = [("WARC-Record-ID", main), *common, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers is None:
        answer, block = [("WARC-Type", "response"), *answer], got + payload
    else:
        answer = [("WARC-Type", "revisit"), *answer, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id("response", refers))]
        block = got
    tied = [*common, ("WARC-Concurrent-To", main)]
    request = [("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", uid)), *tied, ("Content-Type", "application/http; msgtype=request")]
    about = [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", uid)), *tied, ("Content-Type", "application/warc-fields")]
    fields = b"" if page is None else f"page-id: {page}\r\n".encode()
    return [record(request, ask), record(answer, block), record(about, fields)]


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives into ``folder``; the rows are their ``path, records, size``.

    Of equal payloads of at least ``least_bytes`` bytes that of the largest
    ``page_id`` is the response and the others revisit it.  Only payloads that
    occur twice are joined back, by digest, and usually fit a broadcast.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = stored(
        pages.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn(
            "sha", F.sha1("payload")
        ),
        "pages",
    )
    latest = F.max(F.struct("page_id", "uid")).getField("uid")
    owners = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("sha")
        .agg(latest.alias("owner"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("sha", "owner")
    )
    refers = F.when(F.col("owner") != F.col("uid"), F.col("owner")).alias("refers")
    decided = rows.join(stored(owners, "owners"), "sha", "left").select("uid", "page_id", "url", "payload", refers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = open_filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        stamp = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        stream, name, count, size, done = None, "", 0, 0, 0

        def finished() -> pa.RecordBatch:
            stream.close()
            path = f"{folder.rstrip('/')}/{name}"
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count]), pa.array([size])], names=["path", "records", "size"])

        for batch in text_slices(batches, "payload"):
            for row in batch.to_pylist():
                if stream is None:
                    name, count, size = f"captures-{stamp}-{done:05d}.warc.gz", 0, 0
                    stream = filesystem.open_output_stream(f"{root}/{name}", compression=None)
                sha = digest_of(row["payload"])
                for one in capture_records(row["uid"], row["page_id"], row["url"], row["payload"], sha, row["refers"]):
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    packed = packer.compress(one) + packer.flush()
                    stream.write(packed)
                    count, size = count + 1, size + len(packed)
                if size >= ARCHIVE_BYTES:
                    yield finished()
                    stream, done = None, done + 1
        if stream is not None:
            yield finished()

    return map_arrow(decided, run, "path string, records long, size long")


def members(stream) -> Iterator[bytes]:
    """The gzip members of an archive, each one record, read a piece at a time."""
    held, parts = b"", []
    opener = zlib.decompressobj(31)
    while True:
        piece = held or stream.read(1 << 16)
        if not piece:
            if parts:
                raise ValueError("the archive ends within a record")
            return
        parts.append(opener.decompress(piece))
        held = b""
        if opener.eof:
            yield b"".join(parts)
            held, parts, opener = opener.unused_data, [], zlib.decompressobj(31)


def _fields(lines: bytes) -> list[tuple[str, str]]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return [(name.strip().lower(), value.strip()) for name, _, value in pairs]


def parsed(raw: bytes, with_payload: bool) -> dict:
    """A record as a row of ``RECORD``; ``intact`` tells whether a payload matches its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    pairs = _fields(head.partition(b"\r\n")[2])
    headers = dict(pairs)
    block = rest[: int(headers["content-length"])]
    kind = headers.get("warc-type")
    row = {
        "record_id": headers.get("warc-record-id"),
        "record_type": kind,
        "concurrent_to": [value for name, value in pairs if name == "warc-concurrent-to"],
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "fields": [],
    }
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        own = digest_of(payload)
        row |= {"payload_bytes": len(payload), "intact": own == row["payload_digest"], "payload_digest": own}
        if with_payload:
            row["payload"] = payload
    elif kind == "metadata":
        row["fields"] = _fields(block)
    elif kind == "request":
        row["fields"] = [("request", block.partition(b"\r\n")[0].decode("utf-8", "replace")), *_fields(block.partition(b"\r\n")[2])]
    return row


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives named in ``path``, each archive read by one task as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.list_(pa.string()))]
            + [("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string())]
            + [("payload_bytes", pa.int64()), ("intact", pa.bool_()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, where = open_filesystem(path)
                with filesystem.open_input_stream(where, compression=None) as stream:
                    rows, held = [], 0
                    for raw in members(stream):
                        rows.append(parsed(raw, with_payload))
                        held += len(raw) if with_payload else 512
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    count = archives.count()
    return map_arrow(archives.select("path").repartition(max(1, min(count, 100_000))), run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id`` and ``request, response, metadata`` structs.

    A capture is a response or revisit; requests and metadata that name it in
    WARC-Concurrent-To, or that it names, belong to it, of several the one with
    the smallest id.  What is missing is null.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit"))
    others = records.filter(F.col("record_type").isin("request", "metadata"))
    forward = others.select(F.explode("concurrent_to").alias("capture_id"), F.col("record_id").alias("other"))
    back = main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other"))
    links = forward.unionByName(back).distinct()
    packed = F.struct("record_id", "target_uri", F.map_entries("fields").alias("fields"))

    def smallest(kind: str):
        return F.min(F.when(F.col("record_type") == kind, packed)).alias(kind)

    tied = (
        others.join(links, F.col("record_id") == F.col("other"))
        .groupBy("capture_id")
        .agg(smallest("request"), smallest("metadata"))
    )
    response = F.struct("record_type", "refers_to", "target_uri", "payload_digest", "payload_bytes", "intact", "payload")
    captures = main.select(F.col("record_id").alias("capture_id"), response.alias("response"))
    return captures.join(tied, "capture_id", "left").select("capture_id", "request", "response", "metadata")


def archived_pages(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of pages written and read back.

    A null html is an empty payload and a null url an empty one.  A null
    ``page_id`` counts as the smallest; repeated rows are captures of their own,
    of which one is the response.  Other columns are ignored.  An empty table
    writes no archive and gives no rows.
    """
    where = folder or scratch_path(pages.sparkSession, "warc")
    archives = stored(write_archives(pages, where, least_bytes), "archives")
    captures = stored(assemble(stored(read_archives(archives), "records")), "captures")
    page = F.get(F.filter("metadata.fields", lambda f: f["key"] == "page-id"), F.lit(0))["value"].cast("long")
    flat = captures.select("capture_id", page.alias("page_id"), "response.*")
    targets = flat.filter("record_type = 'response'").select(
        F.col("capture_id").alias("refers_to"),
        F.col("page_id").alias("of"),
        F.col("payload_bytes").alias("of_bytes"),
        F.col("payload_digest").alias("of_digest"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    # Responses refer to nothing, so they stay out of the join: their nulls would all be one key.
    own = flat.filter("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    again = flat.filter("record_type <> 'response'").join(targets, "refers_to", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "of_bytes").alias("payload_bytes"),
        F.coalesce("of_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.col("of").alias("refers_to"),
    )
    return own.unionByName(again)


@query()
def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))
