"""WARC archives as chunked records: written and read in parts, never a whole record at once."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import as_batch, salted_join, scratch, sliced, written

CHUNKS = "record_id string, chunk_no int, last boolean, record_type string, uri string, refers_to string, declared long, data binary, payload_bytes long, payload_digest string"
CHUNK_SCHEMA = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("declared", pa.int64()), ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
END = b"\r\n\r\n"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it of a URI or a local path."""
    if urlsplit(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(uri).path
    return fs.FileSystem.from_uri(uri)


def marked(pages: DataFrame, least_bytes: int, id_col: str, payload_col: str, uri_col: str | None) -> DataFrame:
    """id, payload, uri, n_bytes, digest and refers_to (null: a response of its own)."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    base = pages.select(F.col(id_col).cast("long").alias("id"), payload.alias("payload"), uri.alias("uri"))
    base = base.withColumn("n_bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    long = (F.col("n_bytes") >= least_bytes) & F.col("id").isNotNull()
    keys = written(base.filter(long).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1"), "payload-copies")
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # long enough payloads with a partner only; ids decide, so repeated ids are all responses
    out = salted_join(base.filter(long), keys, "digest", "n", total, "id")
    refers = F.when(F.col("id") != F.col("first"), F.col("first"))
    out = out.select("id", "payload", "uri", "n_bytes", "digest", refers.alias("refers_to"))
    return out.unionByName(base.filter(~F.coalesce(long, F.lit(False))).withColumn("refers_to", F.lit(None).cast("long")))


class ArchiveWriter:
    """Appends records to one .warc.gz file, a gzip member per record.

    The file grows under a name of this attempt and is renamed when complete, so a repeated
    task leaves one whole file.
    """

    def __init__(self, folder: str, part: int):
        self.store, path = file_system(folder)
        self.store.create_dir(path, recursive=True)
        self.final, self.name = f"{path}/part-{part:06d}.warc.gz", f"{path}/.part-{part:06d}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.name, compression=None)

    def write(self, header: list[tuple[str, str]], payload: memoryview, chunk: int) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        text = "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in header), f"Content-Length: {len(payload)}\r\n\r\n"])
        self.out.write(packer.compress(text.encode()))
        for i in range(0, len(payload), chunk):
            self.out.write(packer.compress(payload[i : i + chunk]))
        self.out.write(packer.compress(END) + packer.flush())

    def close(self) -> str:
        """The complete file's path; where an earlier attempt of the task left it, that one's."""
        self.out.close()
        if self.store.get_file_info(self.final).type == fs.FileType.File:
            self.store.delete_file(self.name)
            return self.final
        try:
            self.store.move(self.name, self.final)
        except OSError:  # another attempt was first, and the store doesn't replace files
            if self.store.get_file_info(self.final).type != fs.FileType.File:
                raise
            self.store.delete_file(self.name)
        return self.final

    def drop(self) -> None:
        """Removes what a failed attempt has written."""
        self.out.close()
        self.store.delete_file(self.name)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, chunk: int = 1 << 16, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url") -> list[str]:
    """Writes a record per row of ``pages`` to .warc.gz files in ``folder``; returns their paths.

    The payload is the column in UTF-8 (null: empty). Of rows with equal payloads of at least
    ``least_bytes`` bytes, that with the largest id is a response and the others are revisits
    without a payload, which name it, its digest and its length. Smaller payloads, and rows
    without an id, are responses. Rows that repeat the largest id are all responses. One
    file per non-empty task, in a folder that all executors and the reader share.
    """
    schema = pa.schema([("path", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        try:
            for batch in sliced(batches, "payload", 4 << 20):
                writer = writer or ArchiveWriter(folder, TaskContext.get().partitionId())
                append(writer, batch)
        except BaseException:
            if writer:
                writer.drop()
            raise
        if writer:
            yield as_batch(schema, [writer.close()])

    def append(writer: ArchiveWriter, batch: pa.RecordBatch) -> None:
        payload = batch.column("payload").cast(pa.binary())
        for i, (key, uri, n, digest, refers) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "uri", "n_bytes", "digest", "refers_to")), strict=True)):
            header = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>")]
            if uri is not None:
                header.append(("WARC-Target-URI", " ".join(uri.split())))
            header += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(n))]
            if refers is not None:
                header.append(("WARC-Refers-To", f"<urn:page:{refers}>"))
            writer.write(header, memoryview(payload[i].as_buffer() if refers is None and n else b""), chunk)

    rows = marked(pages, least_bytes, id_col, payload_col, uri_col)
    return [r["path"] for r in rows.mapInArrow(run, "path string").collect()]  # one short row per file


def records(stream, chunk: int) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """(header, payload parts) of each record of a .warc.gz stream; parts must be read in turn."""
    packed, plain, unpacker, ended = b"", bytearray(), zlib.decompressobj(31), False

    def more() -> bool:
        nonlocal packed, unpacker, ended
        while not ended:
            if unpacker.eof:
                packed, unpacker = unpacker.unused_data, zlib.decompressobj(31)
            packed = packed or unpacker.unconsumed_tail or stream.read(chunk)
            if not packed:
                ended = True
                break
            part = unpacker.decompress(packed, chunk)
            packed = unpacker.unconsumed_tail
            if part:
                plain.extend(part)
                return True
        return False

    while True:
        while (at := plain.find(END)) < 0:
            if not more():
                return
        lines = bytes(plain[:at]).decode().split("\r\n")
        del plain[: at + 4]
        header = dict(line.split(": ", 1) for line in lines[1:])
        left = int(header["Content-Length"])

        def parts(left: int = left) -> Iterator[bytes]:
            while left:
                while len(plain) < min(left, chunk):
                    if not more():
                        raise EOFError("an archive ends within a record")
                part = bytes(plain[: min(left, chunk)])
                del plain[: len(part)]
                left -= len(part)
                yield part
            while len(plain) < 4:
                if not more():
                    raise EOFError("an archive ends within a record")
            del plain[:4]

        body = parts()
        yield header, body
        for _ in body:  # what the caller left unread
            pass


def read_chunks(spark: SparkSession, paths: list[str], chunk: int = 1 << 16, per_task: int = 1) -> DataFrame:
    """Rows (record_id, chunk_no, last, ...) of all records of the archives, payloads in parts.

    Each row has its part of the payload, and the length and bare hexadecimal SHA-1 of all parts
    up to its own; so those of the ``last`` row are the payload's. A revisit has one row without
    data, with what its header states. A payload is never held whole; one that doesn't have the
    digest of its header is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                store, name = file_system(path)
                with store.open_input_stream(name, compression=None) as stream:
                    for header, body in records(stream, chunk):
                        for made in chunk_rows(path, header, body):
                            rows.append(made)
                            held += len(made[7])
                            if held > 4 << 20 or len(rows) > 5000:
                                yield as_batch(CHUNK_SCHEMA, *zip(*rows, strict=True))
                                rows, held = [], 0
                if rows:
                    yield as_batch(CHUNK_SCHEMA, *zip(*rows, strict=True))

    def chunk_rows(path: str, header: dict[str, str], body: Iterator[bytes]) -> Iterator[tuple]:
        kind, uri, refers = header["WARC-Type"], header.get("WARC-Target-URI"), header.get("WARC-Refers-To", "")[10:-1] or None
        key, declared, stated = header["WARC-Record-ID"][10:-1], int(header["WARC-Payload-Length"]), header["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "revisit":
            yield key, 0, True, kind, uri, refers, declared, b"", declared, stated
            return
        digest, total, number, part = hashlib.sha1(), 0, 0, next(body, b"")
        while True:
            after = next(body, None)
            digest.update(part)
            total += len(part)
            yield key, number, after is None, kind, uri, refers, declared, part, total, digest.hexdigest()
            if after is None:
                break
            number, part = number + 1, after
        if digest.hexdigest() != stated or total != declared:
            raise ValueError(f"{path}: the payload of {key} isn't the one of its header")

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, -(-len(paths) // per_task)))
    return files.mapInArrow(run, CHUNKS)


def warc_round_trip(pages: DataFrame, least_bytes: int = 1000, chunk: int = 1 << 16, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url") -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back in chunk rows, and returns a row per record.

    page_id, payload_bytes, payload_digest, record_type and refers_to, from each record's last
    chunk; see ``write_archives`` and ``read_chunks``. Null payloads and empty ones have no bytes.
    Null ids come back null. Repeated rows: a row each. Other columns: ignored. No rows: no rows.
    """
    spark = pages.sparkSession
    paths = write_archives(pages, scratch(spark, "archives"), least_bytes, chunk, id_col=id_col, payload_col=payload_col, uri_col=uri_col)
    last = read_chunks(spark, paths, chunk).filter("last")
    key = F.when(F.col("record_id") != "", F.col("record_id").cast("long"))
    return last.select(key.alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))
