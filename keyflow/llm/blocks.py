"""Text blocks and exchanges of word keys between them.

A block is a few MB of whole documents, compressed into one row of a written table,
so its number is fixed once and for all. Operators that must know, for each key of a
document (a word, a passage), something about all documents send each block's
distinct keys, packed per key range, to the range's task and get packed answers
back. A key costs one entry per block, however frequent it is: nothing is skewed,
and memory on either side is a block or a key range.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.store import written
from keyflow.llm.words import many_word_hashes

BLOCK_BYTES = 6 << 20
WORDS_PER_RANGE = 2_000_000
BLOCK_SCHEMA = "block bigint, n_docs bigint, n_words bigint, payload binary"


@dataclass
class Block:
    """Documents of one block: ids (with a mask of the present ones), texts, and the
    carried columns of the same rows, if any. Parts of documents may have places."""

    ids: np.ndarray
    present: np.ndarray
    texts: list[bytes]
    carried: pa.RecordBatch | None = None
    places: np.ndarray | None = None


def pack(ids: list[int | None], texts: list[bytes], carried: list[pa.RecordBatch] = (), places: list[int] | None = None) -> bytes:
    sizes = np.array([len(t) for t in texts], dtype="<i8").tobytes()
    head = np.array([len(texts)], dtype="<i8").tobytes()
    numbered = np.array(places if places is not None else [0] * len(texts), dtype="<i8").tobytes()
    known = np.array([i is not None for i in ids], dtype="u1").tobytes()
    numbers = np.array([i or 0 for i in ids], dtype="<i8").tobytes()
    tail = pa.BufferOutputStream()
    if carried:
        with pa.ipc.new_stream(tail, carried[0].schema) as out:
            for batch in carried:
                out.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, numbers, known, sizes, numbered, *texts, tail.getvalue().to_pybytes()]))


def unpack(payload: bytes) -> Block:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ids = np.frombuffer(data, "<i8", n, 8)
    present = np.frombuffer(data, "u1", n, 8 + 8 * n).astype(bool)
    sizes = np.frombuffer(data, "<i8", n, 8 + 9 * n)
    places = np.frombuffer(data, "<i8", n, 8 + 17 * n)
    ends = 8 + 25 * n + np.cumsum(sizes)
    texts = [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    end = int(ends[-1]) if n else 8
    carried = pa.ipc.open_stream(data[end:]).read_all().combine_chunks().to_batches() if len(data) > end else []
    return Block(ids, present, texts, carried[0] if carried else None, places)


def text_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Written table of blocks over all rows; null texts are empty, null ids stay null.

    A text above ``block_bytes`` makes a block of its own. ``carry`` columns travel in
    the block, renamed to their number.
    """
    others = [F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(carry)]
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, slices, held = [], [], [], 0

        def row():
            words = int(many_word_hashes(texts)[1][-1])
            return pa.RecordBatch.from_arrays(
                [pa.array([secrets.randbits(63)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([words], pa.int64()), pa.array([pack(ids, texts, slices)], pa.binary())],
                names=["block", "n_docs", "n_words", "payload"],
            )

        for batch in batches:
            rest, since = batch.select(batch.schema.names[2:]), 0
            for at, (ident, text) in enumerate(zip(batch.column(0), batch.column(1), strict=True), 1):
                ids.append(ident.as_py())
                texts.append(text.as_py().encode())
                held += len(texts[-1])
                if held >= block_bytes:
                    if carry:
                        slices.append(rest.slice(since, at - since))
                    yield row()
                    ids, texts, slices, held, since = [], [], [], 0, at
            if carry and since < batch.num_rows:
                slices.append(rest.slice(since))
        if ids:
            yield row()

    return written(rows.mapInArrow(run, BLOCK_SCHEMA), "blocks", "none")


def key_ranges(blocks: DataFrame, words_per_range: int = WORDS_PER_RANGE) -> int:
    """Number of key ranges, in proportion to the words of all blocks."""
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    at_least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, -(-words // words_per_range))


def parts_of(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of the sorted array ``ranges``, and the bounds of each."""
    first = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(ranges) else np.empty(0, np.int64)
    return ranges[first], np.append(first, len(ranges))


def answers_by_block(answers: DataFrame) -> DataFrame:
    """``answers(block, part, answer)`` gathered per block: at most one row per range."""
    return answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "answer"))).alias("answers"))
