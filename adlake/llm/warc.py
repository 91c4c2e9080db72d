"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by page over key ranges. Every task writes its range as files of
gzip members, starts another file once the compressed size reaches a limit, and
writes under names of its own attempt. Only the attempts that Spark accepted appear
in the manifest; a second job moves their files to the final names, which a rerun
may repeat. Files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow, stored

DATE = "1970-01-01T00:00:00Z"
MANIFEST = "shard int, file int, temporary string, final string, records long, bytes long, sha256 string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
LEVEL = 3


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pafs.LocalFileSystem(), uri)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None, digest: str, turn: int) -> str:
    """Fixed by the page, its payload, and the place among rows that repeat both."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}:{turn}')}>"


def _clean(url: str | None) -> str:
    """A header value: no control characters or blanks."""
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url or "about:blank")


def _member(page, turn, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One record as a gzip member; a revisit (payload None) holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload or b"")
    block_digest = _digest(block)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if payload is not None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page, digest, turn)}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{block_digest}",
        f"Page-ID: {'' if page is None else page}",
    ]
    if payload is None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}")
            lines.append(f"Refers-To-Page-ID: {refers_to}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(raw) + squeeze.flush()


class _Roller:
    """Writes members to files of about ``limit`` compressed bytes."""

    def __init__(self, root: str, shard: int, limit: int):
        self.fs, self.path = _filesystem(root)
        self.root, self.shard, self.limit = root, shard, limit
        self.attempt = uuid.uuid4().hex
        self.out, self.file, self.done = None, 0, []
        self.fs.create_dir(f"{self.path}/_temporary", recursive=True)

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"_temporary/{self.shard:06d}-{self.file:05d}-{self.attempt}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        self.out.write(member)
        self.records += 1
        self.bytes += len(member)
        self.sha.update(member)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.done.append(
            {
                "shard": self.shard,
                "file": self.file,
                "temporary": self.name,
                "final": f"pages-{self.shard:06d}-{self.file:05d}.warc.gz",
                "records": self.records,
                "bytes": self.bytes,
                "sha256": self.sha.hexdigest(),
            }
        )
        self.out, self.file = None, self.file + 1


_MANIFEST_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("file", pa.int32()),
        ("temporary", pa.string()),
        ("final", pa.string()),
        ("records", pa.int64()),
        ("bytes", pa.int64()),
        ("sha256", pa.string()),
    ]
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _writer(root: str, limit: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        roller = _Roller(root, TaskContext.get().partitionId(), limit)
        # Of each run of rows with one page and payload, the first is the decision.
        current, first_page, turn = None, None, 0
        for batch in batches:
            for r in zip(*[batch.column(n).to_pylist() for n in ("page_id", "digest", "tag", "first_page", "url", "html")]):
                page, digest, tag, first, url, html = r
                if tag == 0:
                    current, first_page, turn = (page, digest), first, 0
                    continue
                if current != (page, digest):
                    raise RuntimeError("a page without its decision")
                payload = (html or "").encode()
                answers = turn == 0 and page == first_page
                size, code = len(payload), _digest(payload)
                member = _member(page, turn, url, payload if answers else None, size, code, first_page)
                turn += 1
                roller.add(member)
        roller.close()
        yield pa.RecordBatch.from_pylist(roller.done, schema=_MANIFEST_ARROW)

    return write


def _committer(root: str):
    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                source, final = f"{path}/{row['temporary']}", f"{path}/{row['final']}"
                # A repeated commit finds its file moved already.
                if fs.get_file_info(source).type != pafs.FileType.NotFound:
                    fs.move(source, final)
                found = fs.get_file_info(final)
                if found.type == pafs.FileType.NotFound or found.size != row["bytes"]:
                    raise RuntimeError(f"incomplete file {final}")
            yield batch

    return commit


def payload_digest(html: Column) -> Column:
    """Hex SHA-1 of the payload; null html is the empty payload."""
    return F.sha1(F.encode(F.coalesce(html, F.lit("")), "UTF-8"))


def write_warc(pages: DataFrame, root: str, *, file_bytes: int = 64 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``root``; returns the stored manifest.

    Of rows with equal payloads, the one with the smallest page_id becomes a response and
    the others revisit it; of repeated rows with that id one is the response. Rows
    without page_id come first and revisit the smallest id there is; if no row of the
    group has one, the first is the response and the others refer to none. Null html is
    the empty payload, a null url is written as ``about:blank``; other columns are ignored.
    An empty input writes no file and returns an empty manifest.

    What decides a record's type is found on digests alone and meets the pages in the one
    shuffle that sorts them; html moves once.
    """
    keyed = pages.select("page_id", "url", "html", payload_digest(F.col("html")).alias("digest"))
    ids = keyed.select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("first_page"))
    decisions = (
        ids.distinct()
        .join(firsts, "digest")
        .select("page_id", "digest", F.lit(0).alias("tag"), "first_page",
                F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"))
    )
    rows = keyed.select("page_id", "digest", F.lit(1).alias("tag"),
                        F.lit(None).cast("long").alias("first_page"), "url", "html")
    ordered = (
        rows.union(decisions)
        .repartitionByRange("page_id", "digest")
        .sortWithinPartitions("page_id", "digest", "tag", "url")
    )
    manifest = stored(map_arrow(ordered, _writer(root, file_bytes), MANIFEST), "manifest")
    committed = map_arrow(manifest, _committer(root), MANIFEST)
    path = f"{root.rstrip('/')}/_manifest"
    committed.write.parquet(path)
    return pages.sparkSession.read.schema(committed.schema).parquet(path)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked."""
    unpack, parts, data = zlib.decompressobj(31), [], stream.read(1 << 20)
    while data:
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            data = unpack.unused_data
            unpack, parts = zlib.decompressobj(31), []
            if not data:
                data = stream.read(1 << 20)
        else:
            data = stream.read(1 << 20)
    if parts and any(parts):
        raise RuntimeError("the archive ends inside a record")


def parse_record(raw: bytes) -> dict:
    """Header fields, HTTP header length and payload of a record; checks its digests."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = body[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if fields["WARC-Block-Digest"] != "sha1:" + _digest(block):
        raise RuntimeError("block digest differs")
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != "sha1:" + _digest(payload):
        raise RuntimeError("payload digest differs")
    return {"fields": fields, "payload": payload, "size": size}


def _reader(root: str):
    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(root)
        for batch in batches:
            for name in batch.column("final").to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        record = parse_record(raw)
                        fields = record["fields"]
                        rows.append(
                            {
                                "page_id": number(fields["Page-ID"]),
                                "payload_bytes": record["size"],
                                "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                "record_type": fields["WARC-Type"],
                                "refers_to": number(fields.get("Refers-To-Page-ID")),
                            }
                        )
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)

    return read


def read_warc(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record of the archives that ``manifest`` names, read back and checked."""
    # A task for each archive, as these are cut by size.
    files = manifest.select("final")
    files = files.repartition(max(1, files.count()))
    return map_arrow(files, _reader(root), RECORD)
