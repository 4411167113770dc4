"""WARC archives written by Spark, indexed first, then read by coalesced byte ranges.

Writing: one WARC/1.1 record per page. Of pages with the same payload the one with the smallest id is a response, the others
revisit it and carry no payload. Records are plain text rows that Spark's text writer ends with the blank lines a record
ends with, so archives are written, committed and retried like any table on any file system.

Reading: a first pass walks the record headers of every archive, skipping payloads, and writes an index (file, offset,
length, url, digest). Archives of other writers are read too: uncompressed or with a gzip member per record, with records of any type and without digests. Records are then selected in the index alone; their ranges are sorted by place, neighbours are coalesced
to reads of at most ``READ_BYTES`` (a longer record is one read), and the reads are dealt over the tasks.

Edge cases: a null payload is empty; a null url is left out of the record; line ends in a url are percent-encoded; rows with equal id and
payload are all responses; pages with null ids are responses unless a page with an id has their payload. No pages give no archive
and no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import bitmap
from cohortspark.llm.common import lookup, text_of
from cohortspark.shared import cut_lineage

RECORD_END = "\r\n\r\n"
READ_BYTES = 8 << 20
#: Header lines are read in steps of this size.
_HEAD_BYTES = 1 << 12
#: Fixed by RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_SHA1 = re.compile(f"[{BASE32}]{{32}}")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_INDEX = "file string, offset bigint, length bigint, record_id string, record_type string, url string, digest string, payload_bytes bigint, refers_to string"


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight groups of 20 bits, four digits each."""
    digest = F.sha1(data)
    digits = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        digits += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*digits)


def with_types(pages: DataFrame, key: str = "page_id", html: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Per page (``key`` and ``content``): payload_bytes, payload_digest, record_type and refers_to; payloads are not kept."""
    data = text_of(html).cast("binary")
    facts = cut_lineage(pages.select(
        F.col(key).alias("id"), F.xxhash64(data).alias("content"), F.sha2(data, 256).alias("sha256"), F.octet_length(data).cast("bigint").alias("payload_bytes"),
        sha1_base32(data).alias("payload_digest"),
    ))
    groups = facts.filter(F.col("payload_bytes") >= min_revisit_bytes).groupBy("sha256").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    joined = lookup(facts, groups, ["sha256"], "n", facts.count(), F.struct("id"))
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "id", "content", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _record_id(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def _record(url: str, html: str) -> Column:
    """The record of a page, up to its end mark."""
    response = F.col("record_type") == "response"
    block = F.when(response, F.concat(F.lit(_HTTP), text_of(html))).otherwise(F.lit(""))
    safe_url = F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")), F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z"), F.concat(F.lit("WARC-Target-URI: "), safe_url), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(response, F.lit("Content-Type: application/http; msgtype=response")),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_revisit_bytes: int = 0) -> None:
    """WARC files under ``path``. Pages whose payload cannot repeat are written where they are read; the others are shuffled once to meet their record types."""
    data = text_of("html").cast("binary")
    own = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn("content", F.xxhash64(data))
    hashes = pages.select(F.xxhash64(text_of(html).cast("binary")).alias("h"))
    size = bitmap.size_for(hashes.count())
    repeated = bitmap.build(hashes, size, twice=True)
    split = own.withColumn("again", bitmap.hit(repeated, size, F.col("content")))
    facts = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    single = split.filter(~F.col("again")).select(
        "id", "url", "html", F.octet_length(data).cast("bigint").alias("payload_bytes"), sha1_base32(data).alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast(own.schema["id"].dataType).alias("refers_to"),
    )
    several = split.filter("again")
    types = with_types(several, "id", "html", min_revisit_bytes).distinct().withColumnsRenamed({"id": "tid", "content": "tcontent"})
    joined = several.join(types, F.col("id").eqNullSafe(F.col("tid")) & (F.col("content") == F.col("tcontent")))
    rows = single.unionByName(joined.select("id", "url", "html", *facts))
    rows.select(_record("url", "html").alias("value")).write.option("lineSep", RECORD_END).text(path)
    repeated.destroy()


def _open(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("/") else fs.FileSystem.from_uri("file://" + urlsplit(uri).path)
    return system.open_input_file(path)


def _uri(path: str) -> str:
    """Spark writes ``file:/x`` for what other readers call ``file:///x``."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, sign, value in pairs if sign}


def _page(mark: str | None) -> str | None:
    """The id inside a record id of our own, others as they are."""
    if not mark:
        return None
    inner = mark.removeprefix("<").removesuffix(">")
    return inner.removeprefix("urn:page:") or None


def _plain_records(file, name: str, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and header of uncompressed records; blocks are skipped."""
    offset = 0
    while offset < size:
        head, step = b"", _HEAD_BYTES
        while b"\r\n\r\n" not in head:
            more = file.read_at(min(step, size - offset - len(head)), offset + len(head))
            if not more:
                if not head.strip():
                    return
                raise ValueError(f"{name}: no record at byte {offset}")
            head += more
        # Some writers put more line ends between records than the two they need.
        begun = len(head) - len(head.lstrip(b"\r\n"))
        offset, head = offset + begun, head[begun:]
        if b"\r\n\r\n" not in head:
            continue
        head = head[: head.index(b"\r\n\r\n")]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record at byte {offset}")
        length = len(head) + 4 + int(_headers(head).get("content-length", 0))
        yield offset, length, head
        offset += length + len(RECORD_END)


def _gzip_records(file, name: str, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and header of records that are a gzip member each."""
    offset = 0
    while offset < size:
        member, head, at = zlib.decompressobj(31), b"", offset
        while not member.eof:
            more = file.read_at(min(1 << 20, size - at), at)
            if not more:
                raise ValueError(f"{name}: the record at byte {offset} has no end")
            at += len(more)
            while more and not member.eof:
                text = member.decompress(more, 1 << 20)
                more = member.unconsumed_tail
                if b"\r\n\r\n" not in head:
                    head += text
        length = at - len(member.unused_data) - offset
        head = head.lstrip(b"\r\n")
        if not head.startswith(b"WARC/") or b"\r\n\r\n" not in head:
            raise ValueError(f"{name}: no record at byte {offset}")
        yield offset, length, head[: head.index(b"\r\n\r\n")]
        offset += length


def _index_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
        ("digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
    ])
    for batch in batches:
        for name, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            with _open(_uri(name)) as file:
                records = _gzip_records if file.read_at(2, 0) == b"\x1f\x8b" else _plain_records
                for offset, length, head in records(file, name, size):
                    h = _headers(head)
                    own = h.get("x-payload-length", "")
                    rows.append({
                        "file": name, "offset": offset, "length": length, "record_id": _page(h.get("warc-record-id")), "record_type": h.get("warc-type"), "url": h.get("warc-target-uri"),
                        "digest": h["warc-payload-digest"].removeprefix("sha1:") if "warc-payload-digest" in h else None,
                        "payload_bytes": int(own) if own.isdigit() else None, "refers_to": _page(h.get("warc-refers-to")),
                    })
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """The stored index of all archives under ``path``: one row per record, from the headers alone."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    # A file is the unit of this pass; a partition each, as far as there are tasks for them.
    return cut_lineage(files.repartition("path").mapInArrow(_index_files, _INDEX))


def _payload(record: bytes, kind: str | None) -> bytes | None:
    """What a record brings: the body of a response, the block of a resource or conversion, nothing for other kinds."""
    if record[:2] == b"\x1f\x8b":
        record = zlib.decompress(record, 31).lstrip(b"\r\n")
    head, _, block = record.partition(b"\r\n\r\n")
    block = block[: int(_headers(head).get("content-length", len(block)))]
    if kind == "response" and block.startswith(b"HTTP/"):
        return block.partition(b"\r\n\r\n")[2]
    return block if kind in ("response", "resource", "conversion") else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of ranges: rows come sorted by file and offset within a read."""
    columns = ["record_id", "record_type", "url", "digest", "payload_bytes", "refers_to"]

    def load(file: str, rows: list[dict]) -> pa.RecordBatch:
        begin, end = rows[0]["offset"], rows[-1]["offset"] + rows[-1]["length"]
        with _open(_uri(file)) as opened:
            data = opened.read_at(end - begin, begin)
        payloads = []
        for r in rows:
            payload = _payload(data[r["offset"] - begin : r["offset"] - begin + r["length"]], r["record_type"])
            if payload is not None:
                # The length of what was read, not what a header says; revisits have only that.
                r["payload_bytes"] = len(payload)
                known = r["digest"] is not None and _SHA1.fullmatch(r["digest"])
                if known and base64.b32encode(hashlib.sha1(payload).digest()).decode() != r["digest"]:
                    raise ValueError(f"{file}: the payload at byte {r['offset']} does not match its digest")
            payloads.append(payload)
        table = pa.RecordBatch.from_pylist([{c: r[c] for c in columns} for r in rows], pa.schema([
            (c, pa.int64() if c == "payload_bytes" else pa.string()) for c in columns
        ]))
        return table.append_column("payload", pa.array(payloads, pa.binary()))

    current, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if current != (r["file"], r["read"]):
                if rows:
                    yield load(current[0], rows)
                current, rows = (r["file"], r["read"]), []
            rows.append(r)
    if rows:
        yield load(current[0], rows)


def read_records(selected: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """Records of index rows: record_id, record_type, url, digest, payload_bytes, refers_to, payload (null for revisits).

    Reads are cut at fixed places of a file, so records near each other share one and no read needs the whole file's index.
    """
    reads = selected.withColumn("read", F.floor(F.col("offset") / read_bytes).cast("bigint"))
    return reads.repartition("file", "read").sortWithinPartitions("file", "read", "offset").mapInArrow(
        _read, "record_id string, record_type string, url string, digest string, payload_bytes bigint, refers_to string, payload binary"
    )
