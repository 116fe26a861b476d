"""Binary decoding: log entries and RESP command arrays.

The entry header is plain columns (``substring`` and hex arithmetic). A RESP array
has length-prefixed parts of arbitrary bytes, which no SQL expression can walk, so it
is an Arrow-batched function. Both give null for anything malformed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_BYTES, CONTENT_TYPE = 34, 1
#: Fixed layout of an entry header, little endian: name, offset, size.
HEADER = (("type", 0, 2), ("exec_time_s", 2, 4), ("term", 6, 4), ("logic_id", 10, 8), ("filenum", 18, 4), ("offset", 22, 8), ("content_len", 30, 4))


def little_endian(data: Column, at: int, size: int) -> Column:
    """Unsigned integer of ``size`` bytes; null beyond the signed 64-bit range."""
    digits = F.concat(*[F.hex(F.substring(data, at + i + 1, 1)) for i in range(size - 1, -1, -1)])
    return F.conv(digits, 16, 10).try_cast("bigint")


def entry_header(data: Column) -> Column:
    """Struct of the header fields and the content, or null if the entry is too short,
    of another type, or not exactly as long as its header says."""
    fields = {name: little_endian(data, at, size) for name, at, size in HEADER}
    content = F.substring(data, HEADER_BYTES + 1, 2**31 - 1)
    valid = (F.octet_length(data) >= HEADER_BYTES) & (fields["type"] == CONTENT_TYPE) & (F.octet_length(data) == fields["content_len"] + HEADER_BYTES)
    return F.when(valid, F.struct(*[c.alias(n) for n, c in fields.items()], content.alias("content")))


def parse_resp(data: bytes | None) -> list[bytes] | None:
    """Arguments of a RESP array of bulk strings, or None: bad marks, negative or
    non-numeric lengths, missing or surplus bytes."""

    def number(at: int, mark: bytes) -> tuple[int, int]:
        end = data.find(b"\r\n", at)
        digits = data[at + 1 : end]
        if data[at : at + 1] != mark or end < 0 or not digits.isdigit() or len(digits) > 18:
            raise ValueError(at)
        return int(digits), end + 2

    if data is None:
        return None
    try:
        count, at = number(0, b"*")
        out = []
        for _ in range(count):
            size, at = number(at, b"$")
            if data[at + size : at + size + 2] != b"\r\n":
                return None
            out.append(data[at : at + size])
            at += size + 2
        return out if at == len(data) else None
    except ValueError:
        return None


def resp_bytes(argv: list[bytes]) -> bytes:
    return b"*%d\r\n" % len(argv) + b"".join(b"$%d\r\n%s\r\n" % (len(a), a) for a in argv)


def with_argv(df: DataFrame, column: str, name: str = "argv") -> DataFrame:
    """``df`` with the RESP array of a binary column decoded into ``name``."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.BinaryType()))])
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            argv = pa.array([parse_resp(v.as_py()) for v in batch.column(place)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, argv], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def decode_log(raw: DataFrame, session_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a raw log ``pb_filenum, pb_offset, session_id, binlog``.

    Keepalives (empty payloads) and foreign sessions are left out. ``good`` has the
    entry's start (``filenum, offset``), its end (``pb_end`` position), ``seq`` 0 and
    ``argv``; ``bad`` has the raw entry and a ``reason``.
    """
    rows = raw.where(F.octet_length("binlog") > 0)
    if session_id is not None:
        rows = rows.where(F.col("session_id") == session_id)
    heads = rows.withColumn("entry", entry_header(F.col("binlog")))
    bad = heads.where("entry IS NULL").select("pb_filenum", "pb_offset", "binlog", F.lit("undecodable entry").alias("reason"))
    entries = with_argv(heads.where("entry IS NOT NULL").select("pb_filenum", "pb_offset", "binlog", "entry.*"), "content")
    wrong = F.col("argv").isNull() | (F.size("argv") == 0)
    bad = bad.unionByName(entries.where(wrong).select("pb_filenum", "pb_offset", "binlog", F.lit("undecodable command").alias("reason")))
    pb_end = F.struct(F.col("pb_filenum").alias("filenum"), F.col("pb_offset").alias("offset")).alias("pb_end")
    good = entries.where(~wrong).select("filenum", "offset", pb_end, F.lit(0).cast("bigint").alias("seq"), "exec_time_s", "argv")
    return good, bad
