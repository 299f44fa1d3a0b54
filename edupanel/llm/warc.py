"""WARC archives as a Spark data source: one gzip member per record, read sequentially."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)

from edupanel.session import new_path

SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
REVISIT_FROM = 100
CHUNK = 1 << 16
ROLL_BYTES = 128 << 20
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that isn't framed as it says, or whose digests don't fit."""


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def encode(row) -> bytes:
    """One record as one gzip member."""
    payload = row.payload or b""
    digest = hashlib.sha256(payload).hexdigest()
    revisit = row.record_type == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: {_record_id(row.page_id, digest)}",
        f"WARC-Date: {_DATE}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    # JSON keeps any text on one line
    meta = {"page_id": row.page_id, "url": row.url, "refers_to": row.refers_to if revisit else None}
    head.append(f"X-Page: {json.dumps(meta)}")
    if row.url and not re.search(r"[\x00-\x20\x7f]", row.url):
        head.append(f"WARC-Target-URI: {row.url}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(row.refers_to, digest)}"]
    head.append(f"Content-Length: {len(block)}")
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def members(stream, chunk: int = CHUNK) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as pieces of inflated bytes; reads ``chunk`` bytes at a time."""
    rest = stream.read(chunk)
    while rest:
        state = [rest]

        def pieces(unpack=zlib.decompressobj(31), state=state) -> Iterator[bytes]:
            data = state[0]
            while True:
                try:
                    out = unpack.decompress(data, 1 << 20)
                except zlib.error as error:
                    raise WarcError(f"not a gzip member: {error}") from error
                if out:
                    yield out
                if unpack.eof:
                    state[0] = unpack.unused_data or stream.read(chunk)
                    return
                data = unpack.unconsumed_tail or stream.read(chunk)
                if not data and not out:
                    raise WarcError("the archive ends within a member")

        inflated = pieces()
        yield inflated
        for _ in inflated:
            raise WarcError("bytes after the end of a record")
        rest = state[0]


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(first):
        raise WarcError(f"expected {first!r}, found {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}


def records(stream, chunk: int = CHUNK) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record. Framing follows Content-Length; each block's digest is checked."""
    for pieces in members(stream, chunk):
        held = bytearray()
        end = -1
        for piece in pieces:
            since = max(0, len(held) - 3)
            held += piece
            if (end := held.find(b"\r\n\r\n", since)) >= 0:
                break
        if end < 0:
            raise WarcError("a record without a header")
        fields = _fields(bytes(held[:end]), b"WARC/1.")
        del held[:end + 4]
        length = int(fields["content-length"])
        for piece in pieces:
            held += piece
            if len(held) > length + 4:
                break
        if len(held) != length + 4 or held[length:] != b"\r\n\r\n":
            raise WarcError("a block that isn't as long as its header says")
        block = bytes(held[:length])
        if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise WarcError("a block that doesn't have its digest")
        yield fields, block


def decode(fields: dict[str, str], block: bytes) -> tuple:
    """A row of SCHEMA. A revisit's payload is null; its length and digest are those of the full payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http, meta = _fields(head, b"HTTP/1."), json.loads(fields["x-page"])
    size, digest = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "revisit":
        return meta["page_id"], meta["url"], kind, meta["refers_to"], size, digest, None
    if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise WarcError("a payload that doesn't have its length or digest")
    return meta["page_id"], meta["url"], kind, None, size, digest, payload


@dataclass
class Archive(InputPartition):
    path: str

    def __init__(self, path: str) -> None:
        self.path = path


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...] = ()


class WarcSource(DataSource):
    """``spark.read.format("warc")`` and ``df.write.format("warc")`` for one folder of archives.

    The folder's URI may be of any file system that pyarrow opens. A task writes archives of
    ``ROLL_BYTES`` under names of its own; committing writes one manifest that lists them.
    Readers take the archives that manifests list, so those of failed or repeated tasks don't
    count. Each archive is read by one task, sequentially.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options["path"])


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    # Spark writes local paths with one slash after the scheme
    path = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterable) -> Written:
        store, folder = _folder(self.path)
        store.create_dir(folder, recursive=True)
        names, out = [], None
        for row in iterator:
            if out is None or out.tell() >= ROLL_BYTES:
                if out is not None:
                    out.close()
                names.append(f"{uuid.uuid4().hex}.warc.gz")
                out = store.open_output_stream(f"{folder}/{names[-1]}", compression=None)
            out.write(encode(row))
        if out is not None:
            out.close()
        return Written(tuple(names))

    def commit(self, messages) -> None:
        store, folder = _folder(self.path)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages) -> None:
        """Archives that no manifest lists are never read."""


class WarcReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Archive]:
        store, folder = _folder(self.path)
        names: list[str] = []
        for found in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if found.base_name.startswith("manifest-"):
                with store.open_input_stream(found.path, compression=None) as file:
                    names += json.loads(file.read())
        return [Archive(n) for n in sorted(names)] or [Archive("")]

    def read(self, partition: Archive) -> Iterator[tuple]:
        if partition.path:
            store, folder = _folder(self.path)
            with store.open_input_stream(f"{folder}/{partition.path}", compression=None) as stream:
                for fields, block in records(stream):
                    yield decode(fields, block)


def mark_revisits(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_from: int = REVISIT_FROM,
) -> DataFrame:
    """Rows to write: of equal payloads of at least ``revisit_from`` bytes all but the smallest id are revisits.

    The smallest id per payload digest is a minimum that every task combines before the shuffle;
    the join back is one whose skew Spark splits. Null payloads are empty. A null id never is the
    smallest; rows that repeat the smallest id, and payloads with null ids only, are responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    long_ = rows.where(F.octet_length("payload") >= revisit_from)
    first = long_.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1 and first is not null").select("digest", "first")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.lower(F.hex("digest")).alias("payload_digest"), "payload")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)


def write_warc(pages: DataFrame, path: str, **columns: str) -> None:
    """Write one record per row (see ``mark_revisits``) to a folder of archives."""
    register(pages.sparkSession)
    mark_revisits(pages, **columns).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of a folder of archives, SCHEMA. Fails on wrong framing or digests.

    An empty folder gives an empty result.
    """
    register(spark)
    return spark.read.format("warc").load(path)


def round_trip(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write all rows as archives and read them back."""
    path = path or new_path(pages.sparkSession, "warc")
    write_warc(pages, path, **columns)
    return read_warc(pages.sparkSession, path)
