"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

Texts are parsed against reference blocks: a word run of a text that an earlier
document (one with a smaller id) has is a factor, told by where it stands there. A
window is ``width`` consecutive words; a factor has at least one.

1. Text blocks announce their distinct anchors (an anchor is the smallest hash of the
   shorter word runs inside a window, so neighbouring windows mostly share theirs) to
   key ranges, which answer which of them occur more than once.
2. Text blocks send their distinct windows that have such an anchor, with the smallest
   id each starts in. A range answers, for each window that starts in an earlier
   document of another block, that block and the window's number there: the block is
   its reference. A passage that a third of all documents share costs one entry a text
   block, not one a document, and has one reference.
3. Reference blocks lend the text blocks the stretches of words that were asked for.
4. A text block indexes the windows of what it was lent and of its own texts, and
   parses each text greedily: from the first window that the index has, the factor runs
   on for as long as the words of text and reference agree. The words themselves are
   compared, not hashes. The next factor starts at the first window that this one
   does not cover whole, so windows across a factor's end are looked up like any other.
   The spans of factors are the duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.blocks import answers_by_block, key_ranges, pack, parts_of, text_blocks, unpack
from keyflow.llm.store import discard, written
from keyflow.llm.words import gram_hashes, word_hashes

WIDTH, ANCHOR_WORDS = 13, 6
BLOCKS_A_TASK, LOANS_A_TASK = 4, 256
FACTOR = np.dtype([("text", "<i8"), ("start", "<i8"), ("length", "<i8"), ("source", "<i8"), ("source_start", "<i8")])


@dataclass
class Laid:
    """Texts end to end: their bytes, the hash and place of every word, and the words'
    bounds by text."""

    data: bytes
    words: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Laid:
        data = b"\n".join(texts)
        words, starts = word_hashes(data)
        ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.empty(0, np.int64)
        return cls(data, words, starts, np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64))

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, words, side="right") - 1

    def run(self, start: int, stop: int) -> bytes:
        """Bytes of the words start..stop-1, which lie in one text, and what follows them."""
        return self.data[self.starts[start] : self.starts[stop] if stop < len(self.starts) else len(self.data)]


def windows_of(laid: Laid, width: int, anchor_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows, in order: number of the first word, hash, anchor."""
    n = len(laid.words) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    low, have, need = gram_hashes(laid.words, anchor_words, 3), 1, width - anchor_words + 1
    while have < need:  # sliding minimum over ``need`` runs by doubling
        step = min(have, need - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    at = np.arange(n)
    at = at[at + width <= laid.bounds[laid.text_of(at) + 1]]
    return at, gram_hashes(laid.words, width, 4)[at], low[at]


def _range_of(anchors: np.ndarray, n: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _rows(columns: dict[str, list], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)], names=list(columns))


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


class Windows:
    """The distinct windows of a block's texts that have an id, numbered in the order of
    the places where they first occur in the text with the smallest id."""

    def __init__(self, block, width: int, anchor_words: int):
        self.laid = Laid.of(block.texts)
        self.at, window, anchor = windows_of(self.laid, width, anchor_words)
        self.text = self.laid.text_of(self.at)
        fit = np.flatnonzero(block.present[self.text])
        ids = block.ids[self.text[fit]]
        order = np.lexsort((ids, window[fit]))
        first = _firsts(window[fit][order])
        chosen = fit[order[first]]
        rank = np.argsort(chosen)
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        #: of each window its number, -1 in texts without id
        self.number = np.full(len(self.at), -1)
        self.number[fit[order]] = np.repeat(place, np.diff(first, append=len(order)))
        chosen = chosen[rank]
        #: of each distinct window: hash, anchor, smallest id, first word there
        self.window, self.anchor, self.low, self.first = window[chosen], anchor[chosen], block.ids[self.text[chosen]], self.at[chosen]
        self.ids = block.ids[self.text]
        order = fit[np.argsort(anchor[fit], kind="stable")]
        first = _firsts(anchor[order])
        #: distinct anchors in order, and whether two documents hold them
        self.anchors = anchor[order[first]]
        held = self.ids[order]
        self.shared = np.minimum.reduceat(held, first) != np.maximum.reduceat(held, first) if len(first) else np.empty(0, bool)


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.array([len(arrays[0])], "<i8").tobytes(), *[a.tobytes() for a in arrays]]))


def _unpacked(data: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for t in types:
        out.append(np.frombuffer(raw, t, n, at))
        at += out[-1].nbytes
    return out


@dataclass
class References:
    """Written tables: ``block, answers`` (the windows of a block that an earlier document
    elsewhere has) and ``block, loans`` (the words around them there)."""

    answers: DataFrame
    loans: DataFrame
    tasks: int


def references(blocks: DataFrame, width: int = WIDTH, anchor_words: int = ANCHOR_WORDS) -> References:
    """Steps 1 to 3 of the module text, over a written table of blocks."""
    n, anchor_words = key_ranges(blocks), min(anchor_words, width)
    spark = blocks.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BLOCKS_A_TASK))
    types = [pa.int64(), pa.int32(), pa.binary()]

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                found = Windows(unpack(payload.as_py()), width, anchor_words)
                parts, at = parts_of(_range_of(found.anchors, n))
                rows = {"block": [], "part": [], "said": []}
                for p, s, e in zip(parts.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = slice(s, e)
                    for k, v in zip(rows, (b, p, found.anchors[own].tobytes() + np.packbits(found.shared[own]).tobytes()), strict=True):
                        rows[k].append(v)
                yield _rows(rows, types)

    def size_of(said: bytes) -> int:
        return len(said) * 8 // 65  # eight bytes and a bit for each anchor

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)]
        if not held:
            return
        sizes = [size_of(said) for _, _, said in held]
        _, inverse, times = np.unique(np.concatenate([np.frombuffer(x[2], np.uint64, k) for x, k in zip(held, sizes, strict=True)]), return_inverse=True, return_counts=True)
        hit = times > 1
        np.logical_or.at(hit, inverse, np.concatenate([np.unpackbits(np.frombuffer(x[2], np.uint8, offset=8 * k), count=k).astype(bool) for x, k in zip(held, sizes, strict=True)]))
        hit, at = hit[inverse], 0
        for (b, p, _), size in zip(held, sizes, strict=True):
            own = hit[at : at + size]
            at += size
            if own.any():
                yield _rows({"block": [b], "part": [p], "answer": [np.packbits(own).tobytes()]}, types)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, payload, answers in zip(batch["block"].to_pylist(), batch["payload"], batch["answers"], strict=True):
                found = Windows(unpack(payload.as_py()), width, anchor_words)
                parts, bounds = parts_of(_range_of(found.anchors, n))
                live = np.zeros(len(found.anchors), bool)
                for x in answers.as_py():
                    k = int(np.searchsorted(parts, x["part"]))
                    s, e = bounds[k], bounds[k + 1]
                    live[s:e] = np.unpackbits(np.frombuffer(x["answer"], np.uint8), count=e - s)
                index = np.flatnonzero(live[np.searchsorted(found.anchors, found.anchor)])  # every anchor is known
                part = _range_of(found.anchor[index], n)
                order = np.argsort(part, kind="stable")
                index, part = index[order], part[order]
                parts, at = parts_of(part)
                rows = {"block": [], "part": [], "sent": []}
                for p, s, e in zip(parts.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = index[s:e]
                    for k, v in zip(rows, (b, p, _packed(found.window[own], found.low[own], own.astype("<u4"))), strict=True):
                        rows[k].append(v)
                yield _rows(rows, types)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b, p, *_unpacked(sent, "<u8", "<i8", "<u4")) for batch in batches for b, p, sent in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)]
        if not held:
            return
        windows, ids, numbers = (np.concatenate([r[i] for r in held]) for i in (2, 3, 4))
        whose = np.repeat(np.arange(len(held)), [len(r[2]) for r in held])
        order = np.lexsort((whose, ids, windows))
        first = _firsts(windows[order])
        source = np.empty(len(ids), np.int64)
        source[order] = np.repeat(order[first], np.diff(first, append=len(order)))
        blocks_of, at = np.array([r[0] for r in held], np.int64), 0
        for b, p, w, _, _ in held:
            own = np.arange(at, at + len(w))
            at += len(w)
            own = own[ids[source[own]] < ids[own]]
            if len(own):
                yield _rows({"block": [b], "part": [p], "answer": [_packed(numbers[own], numbers[source[own]], blocks_of[whose[source[own]]])]}, types)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, answers in zip(batch["block"].to_pylist(), batch["answers"], strict=True):
                parts = [_unpacked(x["answer"], "<u4", "<u4", "<i8") for x in answers.as_py()]
                numbers, source = np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts])
                order = np.lexsort((numbers, source))
                numbers, source = numbers[order], source[order]
                at = [*_firsts(source).tolist(), len(source)]
                rows = {"source": [], "target": [], "wanted": []}
                for s, e in zip(at[:-1], at[1:], strict=True):
                    for k, v in zip(rows, (int(source[s]), b, _packed(np.unique(numbers[s:e]))), strict=True):
                        rows[k].append(v)
                yield _rows(rows, [pa.int64(), pa.int64(), pa.binary()])

    def lend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, wanted in zip(batch["payload"], batch["wanted"], strict=True):
                block = unpack(payload.as_py())
                found = Windows(block, width, anchor_words)
                for ask in wanted.as_py():
                    first = found.first[_unpacked(ask["wanted"], "<u4")[0]]  # in order of their places
                    text = found.laid.text_of(first)
                    opens = np.flatnonzero(np.concatenate([[True], (np.diff(first) > width) | (np.diff(text) > 0)]))
                    starts, stops = first[opens], first[np.append(opens[1:] - 1, len(first) - 1)] + width
                    whose = text[opens]
                    within = (starts - found.laid.bounds[whose]).tolist()
                    runs = [found.laid.run(s, e) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]
                    # The run of a text's last words ends with the line break between texts.
                    data = pack(block.ids[whose].tolist(), runs, places=within)
                    yield _rows({"block": [ask["target"]], "loan": [data]}, [pa.int64(), pa.binary()])

    answer = "block bigint, part int, answer binary"
    said = blocks.select("block", "payload").mapInArrow(announce, "block bigint, part int, said binary")
    live = written(answers_by_block(said.repartition(n, "part").mapInArrow(shared, answer)), "shared", "none")
    routed = _joined(blocks, live, tasks, "inner").mapInArrow(route, "block bigint, part int, sent binary")
    found = written(answers_by_block(routed.repartition(n, "part").mapInArrow(match, answer)), "matches", "none")
    discard(live)
    # A block that very many others refer to is read by several tasks.
    asked = written(found.mapInArrow(ask, "source bigint, target bigint, wanted binary"), "asked", "none")
    share = F.pmod(F.xxhash64("target"), F.ceil(F.col("n") / LOANS_A_TASK))
    dealt = asked.join(asked.groupBy("source").agg(F.count("*").alias("n")), "source").withColumn("share", share)
    grouped = dealt.groupBy("source", "share").agg(F.collect_list(F.struct("target", "wanted")).alias("wanted")).select(F.col("source").alias("block"), "wanted")
    lent = _joined(blocks, grouped, tasks, "inner").mapInArrow(lend, "block bigint, loan binary")
    loans = written(lent.repartition(tasks, "block").groupBy("block").agg(F.collect_list("loan").alias("loans")), "loans", "none")
    discard(asked)
    return References(found, loans, tasks)


def _joined(blocks: DataFrame, other: DataFrame, tasks: int, how: str) -> DataFrame:
    """Blocks and what belongs to them, in a number of tasks that follows their number."""
    return blocks.select("block", "payload").repartition(tasks, "block").join(other.repartition(tasks, "block"), "block", how)


def agreement(text: Laid, start: int, stop: int, other: Laid, at: int, end: int) -> int:
    """Number of words from ``start`` that equal those from ``at``, before ``stop`` and
    ``end``: by hashes first, then by the words themselves."""
    n = min(stop - start, end - at)
    same = text.words[start : start + n] == other.words[at : at + n]
    n = n if same.all() else int(np.argmin(same))
    mine, theirs = text.run(start, start + n), other.run(at, at + n)
    if mine.rstrip() == theirs.rstrip():
        return n
    for i, (a, b) in enumerate(zip(mine.split(), theirs.split(), strict=False)):
        if i >= n or a != b:
            return min(i, n)
    return n


def factors_of(block, elsewhere: np.ndarray, loans: list[bytes], width: int, anchor_words: int, found: Windows) -> np.ndarray:
    """The parse of a block's texts: ``FACTOR`` rows in order. ``elsewhere`` are the
    numbers of the windows that the loans hold."""
    laid = found.laid
    lent = [unpack(x) for x in loans]
    loan = Laid.of([t for x in lent for t in x.texts])
    loan_ids = np.concatenate([x.ids for x in lent]) if lent else np.empty(0, np.int64)
    loan_places = np.concatenate([x.places for x in lent]) if lent else np.empty(0, np.int64)
    at, window, _ = windows_of(loan, width, anchor_words)
    owner = loan.text_of(at)
    order = np.lexsort((loan_ids[owner], window))
    first = order[_firsts(window[order])]
    index, index_at = window[first], at[first]
    is_lent = np.zeros(len(found.window) + 1, bool)  # the last stands for windows without number
    is_lent[elsewhere] = True
    low = np.append(found.low, np.iinfo(np.int64).max)
    matched = np.flatnonzero(is_lent[found.number] | (low[found.number] < found.ids))
    words, texts, numbers = found.at[matched], found.text[matched], found.number[matched]
    place = np.searchsorted(index, found.window[numbers])
    out, j = [], 0
    while j < len(matched):
        start, text, number, k = int(words[j]), int(texts[j]), int(numbers[j]), int(place[j])
        held, whole = (loan, k < len(index) and index[k] == found.window[number]) if is_lent[number] else (laid, True)
        source = int((index_at[k] if held is loan else found.first[number]) if whole else 0)
        whose = int(held.text_of(np.array([source]))[0]) if whole else 0
        length = agreement(laid, start, int(laid.bounds[text + 1]), held, source, int(held.bounds[whose + 1])) if whole else 0
        if length < width:  # equal hashes of other words
            j += 1
            continue
        ident, before = (loan_ids[whose], loan_places[whose]) if held is loan else (block.ids[whose], 0)
        out.append((text, start - int(laid.bounds[text]), length, int(ident), int(before) + source - int(held.bounds[whose])))
        # The next window that this factor does not cover whole.
        j = int(np.searchsorted(words, start + length - width + 1))
    return np.array(out, dtype=FACTOR)


def factored(blocks: DataFrame, found: References, width: int, anchor_words: int, make, schema) -> DataFrame:
    """Apply ``make(block, laid, factors)`` to each block and the parse of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, answers, loans in zip(batch["payload"], batch["answers"], batch["loans"], strict=True):
                block = unpack(payload.as_py())
                windows = Windows(block, width, anchor_words)
                parts = [_unpacked(x["answer"], "<u4", "<u4", "<i8")[0] for x in answers.as_py() or ()]
                elsewhere = np.concatenate(parts) if parts else np.empty(0, np.uint32)
                yield make(block, windows.laid, factors_of(block, elsewhere, loans.as_py() or [], width, anchor_words, windows))

    told = found.answers.join(found.loans, "block", "left")
    return _joined(blocks, told, found.tasks, "left").select("payload", "answers", "loans").mapInArrow(run, schema)


def _per_text(laid: Laid, factors: np.ndarray):
    """For each text: its number of words, and the mask of those to remove (or None)."""
    counts = np.diff(laid.bounds).tolist()
    at = np.searchsorted(factors["text"], np.arange(len(counts) + 1)).tolist()
    for t, n in enumerate(counts):
        if at[t] == at[t + 1]:
            yield n, None
            continue
        gone = np.zeros(n, dtype=bool)
        for f in factors[at[t] : at[t + 1]]:
            gone[f["start"] : f["start"] + f["length"]] = True
        yield n, gone


def duplicate_factors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The parse itself: ``doc_id, start, length, source_id, source_start`` (words) of each
    factor. Factors of a text may overlap by less than a window."""
    blocks = text_blocks(df, id_col, text_col)

    def make(block, laid, factors):
        return pa.RecordBatch.from_arrays(
            [pa.array(block.ids[factors["text"]]), *[pa.array(np.ascontiguousarray(factors[k])) for k in FACTOR.names[1:]]], names=["doc_id", "start", "length", "source_id", "source_start"]
        )

    return factored(blocks, references(blocks, width), width, min(ANCHOR_WORDS, width), make, "doc_id bigint, start bigint, length bigint, source_id bigint, source_start bigint")


def duplicate_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept`` (kept words, joined
    by single spaces).

    A word goes if a window over it also starts in a document with a smaller id. Null
    texts have no words; rows with a null id neither lose words nor cost others any;
    rows that share an id do not count as each other's earlier document. Extra columns
    are ignored.
    """
    blocks = text_blocks(df, id_col, text_col)

    def make(block, laid, factors):
        out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept")}
        for ident, known, text, (n, gone) in zip(block.ids.tolist(), block.present, block.texts, _per_text(laid, factors), strict=True):
            words = text.split()
            if gone is not None:
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out["doc_id"].append(ident if known else None)
            out["n_words"].append(n)
            out["n_removed"].append(n - len(words))
            out["kept"].append(b" ".join(words).decode())
        return _rows(out, [pa.int64(), pa.int64(), pa.int64(), pa.string()])

    return factored(blocks, references(blocks, width), width, min(ANCHOR_WORDS, width), make, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def without_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the duplicate spans cut out of ``text``; other columns as they are.

    A span goes with the white space after it. ``n_chars``, if there, is set to the new
    length. Documents that had words and keep none go; a null text stays null.
    """
    docs_columns = docs.columns
    others = tuple(c for c in docs_columns if c != "text")
    absent = "__no_text"
    blocks = text_blocks(docs.withColumn(absent, F.col("text").isNull()), carry=(*others, absent))
    counted = others.index("n_chars") if "n_chars" in others else None

    def make(block, laid, factors):
        rows, texts = [], []
        for t, (_, gone) in enumerate(_per_text(laid, factors)):
            text = block.texts[t]
            if gone is not None:
                if gone.all():
                    continue
                starts = np.append(word_hashes(text)[1], len(text))
                change = np.flatnonzero(np.diff(gone, prepend=gone[0])).tolist()
                marks = [0, *(starts[c] for c in change), len(text)]
                text = b"".join(text[a:b] for i, (a, b) in enumerate(zip(marks[:-1], marks[1:], strict=True)) if i % 2 == int(gone[0]))
            rows.append(t)
            texts.append(None if block.carried.column(len(others))[t].as_py() else text.decode())
        columns = list(block.carried.take(pa.array(rows, pa.int64())).columns[: len(others)])
        if counted is not None:
            lens = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            columns[counted] = lens.cast(columns[counted].type)
        columns.insert(docs_columns.index("text"), pa.array(texts, pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=docs_columns)

    return factored(blocks, references(blocks, width), width, min(ANCHOR_WORDS, width), make, docs.schema)


def op7(spark, sf_dir: str) -> DataFrame:
    out = duplicate_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
words AS (
  SELECT doc_id, rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
starts AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM words, unnest(range(1, len(w) - 11)) AS r(i) WHERE len(w) >= 13),
firsts AS (SELECT win, min(doc_id) AS low FROM starts GROUP BY win),
hits AS (SELECT s.rid, s.i FROM starts s JOIN firsts f ON s.win = f.win WHERE f.low < s.doc_id),
gone AS (SELECT DISTINCT rid, i + d AS k FROM hits, unnest(range(0, 13)) AS r(d)),
gone_lists AS (SELECT rid, list(k) AS ks FROM gone GROUP BY rid)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(len(g.ks), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string([w.w[k] for k in range(1, len(w.w) + 1) if g.ks IS NULL OR NOT list_contains(g.ks, k)], ' ')) AS kept_sha256
FROM words w LEFT JOIN gone_lists g USING (rid)
"""
