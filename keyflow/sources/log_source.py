"""``keyflow_log``: captured binary logs as a batch and streaming source.

A log directory holds files named by their number; each is a run of frames
``[u32 length][u32 pb file][u64 pb offset][u32 session][entry]`` (little endian). Read
it with ``spark.read`` or ``spark.readStream.format("keyflow_log").load(uri)``; offsets
are (file, byte), and ``maxbytes`` bounds a micro-batch. A stream with ``lanes`` n and
``lane`` i takes the files whose number leaves i when divided by n, so that n streams
share a log whose order across files does not matter. Rows are RAW:
``pb_filenum, pb_offset, session_id, binlog``.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FRAME = "<IIQI"
RAW_SCHEMA = "pb_filenum bigint, pb_offset bigint, session_id int, binlog binary"
BATCH_ROWS, BLOCK_BYTES, TASK_BYTES = 4096, 4 << 20, 1 << 20


def frame(pb_filenum: int, pb_offset: int, session_id: int, entry: bytes) -> bytes:
    return struct.pack(FRAME, len(entry), pb_filenum, pb_offset, session_id) + entry


class FileRange:
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class Ranges(InputPartition):
    """What one task reads."""

    def __init__(self, ranges: list[FileRange]):
        self.ranges = ranges


def _tasks(ranges: list[FileRange]) -> list[Ranges]:
    """Neighbouring ranges share a task up to ``TASK_BYTES``; a range is never split."""
    out, left = [], 0
    for r in ranges:
        if not out or left < r.stop - r.start:
            out.append(Ranges([]))
            left = TASK_BYTES
        out[-1].ranges.append(r)
        left -= r.stop - r.start
    return out or [Ranges([])]


def _files(uri: str) -> tuple[pafs.FileSystem, list[tuple[int, str, int]]]:
    fs, root = pafs.FileSystem.from_uri(uri)
    found = [(int(f.base_name), f.path, f.size) for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.is_file and f.base_name.isdigit()]
    return fs, sorted(found)


def _frames(uri: str, ranges: list[FileRange]) -> Iterator[tuple[int, int, int, bytes]]:
    fs, _ = pafs.FileSystem.from_uri(uri)
    for part in ranges:
        yield from _range_frames(fs, part)


def _range_frames(fs: pafs.FileSystem, part: FileRange) -> Iterator[tuple[int, int, int, bytes]]:
    """Whole frames that start in the range; a torn frame at the end of a file waits."""
    head = struct.calcsize(FRAME)
    with fs.open_input_file(part.path) as f:
        at, size, block, base = part.start, f.size(), b"", 0
        while at < part.stop and at + head <= size:
            if not base <= at <= base + len(block) - head:
                block, base = f.read_at(min(BLOCK_BYTES, size - at), at), at
            length, filenum, offset, session = struct.unpack_from(FRAME, block, at - base)
            if at + head + length > size:
                return
            if at + head + length > base + len(block):
                block, base = f.read_at(min(max(BLOCK_BYTES, head + length), size - at), at), at
            yield filenum, offset, session, block[at - base + head : at - base + head + length]
            at += head + length


def _whole_frames(f, at: int, size: int, limit: int) -> int:
    """End of the last whole frame, or of the first that reaches ``limit`` bytes."""
    head, start, block, base = struct.calcsize(FRAME), at, b"", 0
    while at + head <= size and at - start < limit:
        if not base <= at <= base + len(block) - head:
            block, base = f.read_at(min(BLOCK_BYTES, size - at), at), at
        length = struct.unpack_from("<I", block, at - base)[0]
        if at + head + length > size:
            break
        at += head + length
    return at


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["pb_filenum", "pb_offset", "session_id", "binlog"])


class LogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]

    def partitions(self) -> list[InputPartition]:
        """Whole files: frames have no index, so files are what can be read in parallel."""
        return _tasks([FileRange(path, 0, size) for _, path, size in _files(self.uri)[1]])

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        yield from _batches(_frames(self.uri, partition.ranges))


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.starting = options.get("startingoffsets", "earliest")
        self.max_bytes = int(options.get("maxbytes", 0))
        self.lanes, self.lane = int(options.get("lanes", 1)), int(options.get("lane", 0))
        self.at: dict | None = None
        self.listed: list[tuple[int, str, int]] = []

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            return {"file": -1, "byte": 0}
        if self.starting == "latest":
            return self._end({"file": -1, "byte": 0}, 0)
        return json.loads(self.starting)

    def _end(self, start: dict, limit: int) -> dict:
        """Place up to which whole frames can be read now, about ``limit`` bytes on.

        A file that has a successor is closed: its size is its end, and the tasks find
        its last whole frame. So the driver looks into the newest file only, in blocks,
        from where it left off, or into a closed one that alone exceeds the limit; and
        the log is listed again only when the closed files of the last listing are used up.
        """
        fs, _ = pafs.FileSystem.from_uri(self.uri)
        end, left = self._walk(fs, start, limit or 1 << 62, self.listed[:-1], None)
        if left > 0:
            self.listed = _files(self.uri)[1]
            end, _ = self._walk(fs, start, limit or 1 << 62, self.listed, self.listed[-1][0] if self.listed else None)
        return end

    def _walk(self, fs: pafs.FileSystem, start: dict, left: int, files: list[tuple[int, str, int]], newest: int | None) -> tuple[dict, int]:
        """The place ``left`` bytes on or the end of the files, and what is left of the bytes."""
        file, byte = start["file"], start["byte"]
        for number, path, size in files:
            if left <= 0:
                break
            if number < file or number % self.lanes != self.lane:
                continue
            at = byte if number == file else 0
            if number != newest and size - at <= left:
                end = max(at, size)
            else:
                with fs.open_input_file(path) as f:
                    end = _whole_frames(f, at, size, left)
                if end - at < left and number != newest:
                    end = max(end, size)
            left -= end - at
            file, byte = number, end
        return {"file": file, "byte": byte}, left

    def latestOffset(self) -> dict:
        self.at = self._end(self.at or self.initialOffset(), self.max_bytes)
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = end
        if not self.listed or self.listed[-1][0] < end["file"]:
            self.listed = _files(self.uri)[1]
        out = []
        for number, path, size in self.listed:
            if start["file"] <= number <= end["file"] and number % self.lanes == self.lane:
                a = start["byte"] if number == start["file"] else 0
                b = end["byte"] if number == end["file"] else size
                if a < b:
                    out.append(FileRange(path, a, b))
        return _tasks(out)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        yield from _batches(_frames(self.uri, partition.ranges))

    def commit(self, end: dict) -> None:
        """Nothing to acknowledge: the files stay."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyflow_log"

    def schema(self) -> str:
        return RAW_SCHEMA

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self._options())


def register(spark) -> None:
    spark.dataSource.register(LogSource)
