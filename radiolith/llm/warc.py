"""WARC archives with a two-level capture index.

*Archives.* Every page becomes a record, a gzip member of its own. Of records with equal payloads of at least
``min_revisit_bytes`` the one with the largest id is a response and the others are revisits that refer to it. Payloads are
compressed before they are shuffled to meet their group.

*Index.* A capture's key is its url with the host's labels reversed. Keys are range-partitioned and sorted; each
partition is an index file of compressed blocks of ``BLOCK_ENTRIES`` entries, and beside it lies a sparse directory
with the first key, offset and length of each block. A lookup finds the file by binary search over the files' first keys (one
per partition: that list is all the driver holds), the block by binary search in the file's directory, and then reads the
block's range, and the records' ranges.

Files are written by tasks into the shared folder through Arrow's file systems (local, HDFS, object stores), under names
that no other attempt of a task uses. Only files that a task's result names are ever read, so what a lost executor
left behind is never seen.

Defined cases: a null payload is empty; a null url has the key ``)``; rows that repeat the largest id of their group are
responses too; a null id is smaller than all others and reads back as null; equal urls have several captures, all of
which a lookup finds; an empty table gives an archive without files; columns other than id, url and payload are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radiolith.llm.common import shared_folder, store_of, stored, text_bytes, width

BLOCK_ENTRIES = 256
#: An archive file is closed after so many bytes.
FILE_BYTES = 1 << 30
_LEVEL = 2
_STRETCH = 8 << 20
_DATE = "1970-01-01T00:00:00Z"


def url_key(url: str | None) -> str:
    """``https://a.B.org/x?y`` becomes ``org,b,a)/x?y``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return ")" + (url or "")
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:end].lower().split("."))) + ")" + rest[end:]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(kind: str, page: str, url: str, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {json.dumps(url)[1:-1]}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append("Content-Type: text/html")
    lines.append(f"Content-Length: {len(payload)}")
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + payload + b"\r\n\r\n", _LEVEL, mtime=0)


@dataclass
class Record:
    kind: str
    page: str
    url: str
    digest: str
    size: int
    payload: bytes
    refers_to: str | None


def read_record(member: bytes) -> Record:
    """Parses a member; a response's payload must have the digest and length that its header states."""
    data = zlib.decompress(member, 31)
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = body[: int(fields["Content-Length"])]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    kind = fields["WARC-Type"]
    if kind == "response" and (payload_digest(payload), len(payload)) != (digest, size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = lambda name: fields[name][len("<urn:page:") : -1] if name in fields else None
    return Record(kind, page("WARC-Record-ID"), json.loads(f'"{fields["WARC-Target-URI"]}"'), digest, size, payload, page("WARC-Refers-To"))


@dataclass
class Archive:
    """``captures``: the table of ``key, id, file, offset, length``; ``shards``: first key and path of each index file."""

    captures: DataFrame
    shards: list[tuple[str, str]]


def _write_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store_of(folder)
        out, name = None, None
        try:
            for batch in batches:
                keys, files, offsets, lengths = [], [], [], []
                for page, url, digest, size, member, refers in zip(*(batch.column(n).to_pylist() for n in ("id", "url", "sha", "size", "member", "refers_to")), strict=True):
                    if refers is not None:
                        bare = base64.b32encode(bytes.fromhex(digest)).decode()
                        member = _member("revisit", "" if page is None else str(page), url or "", bare, size, b"", str(refers))
                    if out is not None and out.tell() >= FILE_BYTES:
                        out.close()
                        out = None
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        system.create_dir(root, recursive=True)
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    keys.append(url_key(url))
                    files.append(name)
                    offsets.append(out.tell())
                    lengths.append(len(member))
                    out.write(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "file", "offset", "length"],
                )
        finally:
            if out is not None:
                out.close()

    return run


def _write_index(folder: str):
    """Sorted captures to one index file with its directory; yields its first key and path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store_of(folder)
        name, out, directory, entries = f"{uuid.uuid4().hex}.idx", None, [], []

        def flush():
            block = gzip.compress("\n".join(json.dumps(e) for e in entries).encode(), _LEVEL, mtime=0)
            directory.append((entries[0][0], out.tell(), len(block)))
            out.write(block)
            entries.clear()

        for batch in batches:
            for entry in zip(*(batch.column(n).to_pylist() for n in ("key", "file", "offset", "length")), strict=True):
                if out is None:
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                entries.append(entry)
                if len(entries) == BLOCK_ENTRIES:
                    flush()
        if out is None:
            return
        if entries:
            flush()
        out.close()
        with system.open_output_stream(f"{root}/{name}.dir") as file:
            file.write(gzip.compress(json.dumps(directory).encode(), _LEVEL, mtime=0))
        yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], names=["first_key", "file"])

    return run


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_revisit_bytes: int = 0) -> Archive:
    """Writes archives and index below ``folder``, which all executors must share."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("size") >= min_revisit_bytes).groupBy("sha").agg(F.max("id").alias("response"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("id", "url", "sha", "size")]
            members = [
                _member("response", "" if p is None else str(p), u or "", base64.b32encode(bytes.fromhex(s)).decode(), n, body, None)
                for p, u, s, n, body in zip(*columns, text_bytes(batch, "payload"), strict=True)
            ]
            kept = [batch.column(n) for n in ("id", "url", "sha", "size")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(members, pa.binary())], names=["id", "url", "sha", "size", "member"])

    kind = rows.schema["id"].dataType.simpleString()
    ready = rows.mapInArrow(compress, f"id {kind}, url string, sha string, size long, member binary").join(first, "sha", "left")
    follows = (F.col("size") >= min_revisit_bytes) & F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    records = ready.select(
        "id", "url", "sha", "size", F.when(~follows, F.col("member")).alias("member"),
        F.when(follows, F.col("response")).alias("refers_to"),
    )
    captures = stored(records.mapInArrow(_write_files(folder), "key string, file string, offset long, length long"), "captures")
    ordered = captures.repartitionByRange(width(pages.sparkSession), "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    shards = stored(ordered.mapInArrow(_write_index(f"{folder}/index"), "first_key string, file string"), "shards")
    listed = sorted((r["first_key"], r["file"]) for r in shards.collect())  # one per index file
    return Archive(captures, [(k, f"{folder}/index/{f}") for k, f in listed])


class _IndexFile:
    """An index file open for lookups in the order of keys; keeps the block read last."""

    def __init__(self, path: str):
        system, at = store_of(path)
        with system.open_input_file(f"{at}.dir") as file:
            self.directory = json.loads(gzip.decompress(file.read()))
        self.firsts = [d[0] for d in self.directory]
        self.file, self.at, self.block = system.open_input_file(at), -1, []

    def entries(self, number: int) -> list[list]:
        if number != self.at:
            _, offset, length = self.directory[number]
            lines = gzip.decompress(self.file.read_at(length, offset)).decode().split("\n")
            self.at, self.block = number, [json.loads(line) for line in lines]
        return self.block

    def find(self, key: str) -> Iterator[list]:
        for number in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            block = self.entries(number)
            low = bisect_left(block, key, key=lambda e: e[0])
            while low < len(block) and block[low][0] == key:
                yield block[low]
                low += 1


def lookup(spark: SparkSession, archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``key, file, offset, length`` of all captures of the urls, each once, by the index."""
    firsts = [k for k, _ in archive.shards]
    paths = [p for _, p in archive.shards]
    if not firsts:
        return archive.captures.select("key", "file", "offset", "length").limit(0)

    @F.pandas_udf("string")
    def key_of(url: pd.Series) -> pd.Series:
        return url.map(lambda u: url_key(u if isinstance(u, str) else None))

    @F.pandas_udf("array<int>")
    def shards_of(key: pd.Series) -> pd.Series:
        """The files that may hold a key: it can go on over several of them."""
        return key.map(lambda k: list(range(max(0, bisect_left(firsts, k) - 1), bisect_right(firsts, k))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, index = None, None
        for batch in batches:
            found = []
            for shard, key in zip(batch.column("shard").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if shard != number:
                    number, index = shard, _IndexFile(paths[shard])
                found.extend(index.find(key))
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "file", "offset", "length"])

    asked = urls.select(key_of(F.col(url_col).cast("string")).alias("key")).distinct()
    asked = asked.select(F.explode(shards_of("key")).alias("shard"), "key")
    return (
        asked.repartition(width(spark), "shard").sortWithinPartitions("shard", "key")
        .mapInArrow(read, "key string, file string, offset long, length long")
    )


def read_records(spark: SparkSession, folder: str, captures: DataFrame, id_type: str = "long") -> DataFrame:
    """Per capture, read from its range: ``id, url, payload`` (null for a revisit), ``payload_bytes``,
    ``payload_digest``, ``record_type``, ``refers_to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store_of(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for path, offset, length in zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length")), strict=True):
                if path != name:
                    name, file = path, system.open_input_file(f"{root}/{path}")
                r = read_record(file.read_at(length, offset))
                rows.append((r.page or None, r.url, r.payload if r.kind == "response" else None, r.size, r.digest, r.kind, r.refers_to))
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    stretch = F.floor(F.col("offset") / _STRETCH)
    records = (
        captures.repartition(width(spark), "file", stretch).sortWithinPartitions("file", "offset")
        .mapInArrow(run, "id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string")
    )
    return records.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def archive_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "warc")
