"""Media columns: archives with directories, read back by a custom data source.

A payload (bytes, padded with zeros to a multiple of 64) is stored as the samples of
an 8-bit greyscale PNG, 64 wide. Each task of the writing job puts its PNG members
into one archive: members end to end, then a directory of (doc_id, size, offset,
length), then a footer with the directory's place. The ``media_archive`` data source
cuts the archives into byte ranges; a task reads the directory of its archive, takes
the members that start in its range, opens each at its offset and retries each alone.

Archives are opened through ``pyarrow.fs`` from their URI, so any store that it
knows (local or shared folders, HDFS, S3, ...) will do.
"""

from __future__ import annotations

import hashlib
import struct
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from keyflow.llm.store import fresh_path

WIDTH = 64
SPLIT_BYTES, BATCH_BYTES, RETRIES = 16 << 20, 8 << 20, 3
MAGIC = b"KFMEDIA1"
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed value of the format
_FOOTER = "<QQ8s"
_DIRECTORY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_bytes", "<i8"), ("offset", "<i8"), ("length", "<i8")])


def padded(payload: bytes) -> bytes:
    """Zeros appended up to a positive multiple of 64."""
    return payload.ljust(max(1, -(-len(payload) // WIDTH)) * WIDTH, b"\0")


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))


def to_png(payload: bytes) -> bytes:
    """Lossless 8-bit greyscale image whose rows are the payload's 64-byte rows."""
    rows = np.frombuffer(payload, dtype=np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), dtype=np.uint8)  # filter type 0 before each row
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG_SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def chunks_of(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Kind and body of each chunk; ``ValueError`` at the first that is damaged."""
    if data[:8] != PNG_SIGNATURE:
        raise ValueError("not a PNG")
    at, kind = 8, b""
    while at + 12 <= len(data):
        (size,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(body, zlib.crc32(kind))):
            raise ValueError("damaged PNG chunk")
        yield kind, body
        at += 12 + size
    if at != len(data) or kind != b"IEND":
        raise ValueError("PNG cut short")


def from_png(data: bytes) -> np.ndarray:
    """Samples of a PNG that ``to_png`` could have made; ``ValueError`` if damaged."""
    shape, parts = None, []
    for kind, body in chunks_of(data):
        if kind == b"IHDR":
            width, height, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if (depth, colour, interlace) != (8, 0, 0):
                raise ValueError("not a plain 8-bit greyscale PNG")
            shape = height, width + 1
        elif kind == b"IDAT":
            parts.append(body)
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), dtype=np.uint8).reshape(shape)
    if lines[:, 0].any():
        raise ValueError("filtered PNG rows")
    return np.ascontiguousarray(lines[:, 1:])


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_archives(df: DataFrame, directory: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Job that stores every row's text; one row ``(archive, members, bytes)`` per task.

    The archive of a task is written under the attempt's own name and then renamed to
    the partition's, so a retried or doubled attempt replaces it by the same content
    and an interrupted one leaves nothing that is read. A null text is an empty one.
    Members stream to the file; memory holds one batch and the directory.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(directory)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}"
        draft = f"{root}/_{name}-{context.taskAttemptId()}"
        entries, at = [], 0
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                for ident, text in zip(batch.column(0), batch.column(1), strict=True):
                    payload = text.as_py().encode()
                    member = to_png(padded(payload))
                    out.write(member)
                    ident = ident.as_py()
                    entries.append((ident or 0, ident is not None, len(payload), at, len(member)))
                    at += len(member)
            out.write(np.array(entries, dtype=_DIRECTORY).tobytes())
            out.write(struct.pack(_FOOTER, at, len(entries), MAGIC))
        fs.move(draft, f"{root}/{name}.kfm")
        yield pa.RecordBatch.from_arrays([pa.array([f"{name}.kfm"]), pa.array([len(entries)], pa.int64()), pa.array([at], pa.int64())], names=["archive", "members", "bytes"])

    return rows.mapInArrow(run, "archive string, members bigint, bytes bigint")


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class MediaArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.retries = int(options.get("retries", RETRIES))

    def partitions(self) -> list[InputPartition]:
        fs, root = _open(self.uri)
        files = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return [
            ByteRange(f.path, at, min(at + self.split, f.size))
            for f in sorted(files, key=lambda f: f.path) if f.path.endswith(".kfm")
            for at in range(0, f.size, self.split)
        ] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = _open(self.uri)
        entries = self._retried(lambda: self._directory(fs, partition.path))
        first, last = np.searchsorted(entries["offset"], [partition.start, partition.stop])
        rows, held = [], 0
        for e in entries[first:last]:
            data = self._retried(lambda e=e: self._member(fs, partition.path, int(e["offset"]), int(e["length"])))
            rows.append((int(e["doc_id"]) if e["has_id"] else None, int(e["n_bytes"]), data))
            held += len(data)
            if held >= BATCH_BYTES:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _retried(self, read):
        """Each member alone: what could not be read, or came damaged, is read again from
        its own offset; the members before and after it are not."""
        for attempt in range(self.retries + 1):
            try:
                return read()
            except (OSError, ValueError):
                if attempt == self.retries:
                    raise
                time.sleep(0.1 * 2**attempt)

    @staticmethod
    def _directory(fs: pafs.FileSystem, path: str) -> np.ndarray:
        with fs.open_input_file(path) as f:
            size = f.size()
            at, n, magic = struct.unpack(_FOOTER, f.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER)))
            if magic != MAGIC or at + n * _DIRECTORY.itemsize + struct.calcsize(_FOOTER) != size:
                raise ValueError(f"{path}: no archive footer")
            return np.frombuffer(f.read_at(n * _DIRECTORY.itemsize, at), dtype=_DIRECTORY)

    @staticmethod
    def _member(fs: pafs.FileSystem, path: str, offset: int, length: int) -> bytes:
        with fs.open_input_file(path) as f:
            data = f.read_at(length, offset)
        if len(data) != length:
            raise ValueError(f"{path}: no member at {offset}")
        for _ in chunks_of(data):  # their checksums
            pass
        return data

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, sizes, data = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "n_bytes", "media"])


class MediaArchiveSource(DataSource):
    """``spark.read.format("media_archive").load(uri)``; options ``splitBytes``, ``retries``."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "doc_id bigint, n_bytes bigint, media binary"

    def reader(self, schema) -> DataSourceReader:
        return MediaArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, directory: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchiveSource)
    return spark.read.format("media_archive").options(**options).load(directory)


def features(media: DataFrame) -> DataFrame:
    """Decode each member: payload digests and a summary of its samples.

    ``feature`` is ``HEIGHTxWIDTH mean deviation zeros`` of the samples.
    """
    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column(2):
                data = data.as_py()
                samples = from_png(data)
                payload = samples.tobytes()
                out.append((
                    len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(),
                    f"{samples.shape[0]}x{samples.shape[1]} {samples.mean():.4f} {samples.std():.4f} {int((samples == 0).sum())}",
                ))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return media.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    directory = fresh_path(spark, "media")
    write_archives(spark.read.parquet(f"{sf_dir}/documents.parquet"), directory).agg(F.sum("members")).collect()
    return features(read_archives(spark, directory))
