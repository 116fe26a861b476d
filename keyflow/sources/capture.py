"""An independent reading of captured entries, to hold the decoder against.

It shares no code with ``functions.decode``: entries are read front to back by the
standard library, one at a time, and what cannot be read is kept with its reason.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from keyflow.sources.files import GT_SCHEMA

_HEAD = struct.Struct("<HIIQIQI")


def reading(entry: bytes) -> dict:
    """Place, time and words of an entry, or why it has none (``bad``)."""
    if len(entry) < _HEAD.size:
        return {"bad": "short"}
    kind, seconds, _, _, file, offset, size = _HEAD.unpack_from(entry)
    found = {"f": file, "o": offset, "ex": seconds}
    body = io.BytesIO(entry[_HEAD.size :])
    if kind != 1 or size != len(entry) - _HEAD.size:
        return found | {"bad": "length" if kind == 1 else "kind"}

    def line(mark: bytes) -> int:
        text = body.readline()
        if text[:1] != mark or text[-2:] != b"\r\n" or not text[1:-2].isdigit():
            raise ValueError
        return int(text[1:-2])

    words = []
    try:
        for _ in range(line(b"*")):
            n = line(b"$")
            words.append(body.read(n))
            if len(words[-1]) != n or body.read(2) != b"\r\n":
                raise ValueError
        if body.read(1) or not words:
            raise ValueError
    except ValueError:
        return found | {"bad": "command"}
    text = [w.decode("utf-8", errors="replace") for w in words[:2]]
    return found | {"cmd": text[0], "key": text[1] if len(text) > 1 else "", "argc": len(words)}


def capture(raw: DataFrame) -> DataFrame:
    """Ground truth of a raw log ``pb_filenum, pb_offset, session_id, binlog``, keepalives
    left out: a row an entry, as ``files.read_truth`` reads it from JSON lines; the bytes
    of what cannot be read are kept in hexadecimal."""
    names = [c.split(" ")[0] for c in GT_SCHEMA.split(", ")]
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    kinds = [types[c.split(" ")[1]] for c in GT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, offset, entry in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if entry:
                    found = reading(entry)
                    rows.append(found | {"pef": file, "peo": offset} | ({"raw": entry.hex()} if "bad" in found else {}))
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, kinds, strict=True)], names=names)

    return raw.select("pb_filenum", "pb_offset", "binlog").mapInArrow(run, GT_SCHEMA)
