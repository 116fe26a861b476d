"""LM scoring with a hidden Markov language model.

Every word that is one of 2^15 or more of all words has a symbol of its own; the others
share symbols by the top bits of their hash. A state emits symbols, and a symbol stands
for its words by their training counts:

    P(text) = sum over state paths of  start * transitions * P(symbol | state)
              times the product of     P(word | symbol) = (c + a) / (C + a (V + 1))

(c: the word's count, C and V: count and distinct words of its symbol, a = 0.1; one
unseen word per symbol has its share; an own symbol's word has it whole). ``end`` is a
symbol of its own and closes each text. Word counts cover all training texts: blocks
exchange their distinct words with key ranges (see ``blocks``), so no task or driver
ever holds the vocabulary. States are trained by Baum-Welch: every round, tasks run
forward-backward over all training texts, and their expected counts are summed per
symbol by Spark; the driver only sees the model, whose size is fixed. Long texts are
taken in segments of ``SEGMENT`` tokens, each with ``CONTEXT`` tokens before and after
it, so that its ends are judged as inside the text; each token and each transition,
those between segments included, is counted once. A state's emissions are the symbols'
shares, weighted by how likely the state is given the symbol, which is smoothed
towards the states' own shares by ``PRIOR`` tokens: rare symbols tell no states apart.
Scoring runs the scaled forward recursion over each whole text, so the likelihood is
exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.blocks import answers_by_block, key_ranges, parts_of, text_blocks, unpack
from keyflow.llm.store import discard, written
from keyflow.llm.words import many_word_hashes, mix

OWN_BITS, TAIL_BITS, STATES, ROUNDS = 15, 13, 8, 5
SEGMENT, CONTEXT = 256, 16
TOKENS_AT_ONCE = 1 << 19
ADDED, PRIOR, HELD_OUT = 0.1, 10.0, 10
TAIL = 1 << OWN_BITS
END = TAIL + (1 << TAIL_BITS)


@dataclass
class Model:
    """start, inside (a state's share of all tokens), move: probabilities; emit: (END + 1,
    states). ``own``: sorted hashes of the words with own symbols."""

    start: np.ndarray
    inside: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    own: np.ndarray | None = None


def held_out(ids: np.ndarray, present: np.ndarray, modulus: int = HELD_OUT) -> np.ndarray:
    """crc32 of the id as text (null: empty text) modulo ``modulus`` is 0."""
    return np.array([zlib.crc32(str(i).encode() if p else b"") % modulus == 0 for i, p in zip(ids.tolist(), present, strict=True)], dtype=bool)


def symbols_of(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    tail = TAIL + (hashes >> np.uint64(64 - TAIL_BITS)).astype(np.int32)
    if not len(own):
        return tail
    at = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
    return np.where(own[at] == hashes, at.astype(np.int32), tail)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _texts(payload: bytes):
    block = unpack(payload)
    hashes, bounds = many_word_hashes([t.lower() for t in block.texts])
    return block, hashes, bounds, held_out(block.ids, block.present)


def word_counts(blocks: DataFrame) -> tuple[DataFrame, dict]:
    """Per block the training count of each of its distinct words (in hash order,
    packed by range); and the own words with the totals per symbol, of bounded size."""
    every = blocks.agg(F.sum("n_words")).first()[0] or 0
    frequent = max(2, -(-every >> OWN_BITS))  # words as frequent as this are 2^15 at most
    n = key_ranges(blocks)

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                _, hashes, bounds, held = _texts(payload.as_py())
                train = np.repeat(~held, np.diff(bounds))
                words, inverse = np.unique(hashes, return_inverse=True)
                counts = np.bincount(inverse[train], minlength=len(words)).astype(np.uint32)
                parts, at = parts_of(_ranges(words, n))
                at = at.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b] * len(parts), pa.int64()), pa.array(parts.astype(np.int32)),
                        pa.array([words[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                        pa.array([counts[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    ],
                    names=["block", "part", "words", "counts"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)]
        if not held:
            return
        words, inverse = np.unique(np.concatenate([np.frombuffer(r[2], np.uint64) for r in held]), return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, inverse, np.concatenate([np.frombuffer(r[3], np.uint32) for r in held]).astype(np.int64))
        press, at = zstandard.ZstdCompressor(level=1), 0
        for b, p, w, _ in held:
            own = total[inverse[at : at + len(w) // 8]]
            at += len(w) // 8
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([p], pa.int32()), pa.array([press.compress(own.tobytes())], pa.binary())], names=["block", "part", "answer"])
        often = total >= frequent
        symbol = symbols_of(words, words[:0])
        seen = np.unique(symbol)
        c = np.bincount(symbol, weights=np.where(often, 0, total), minlength=END)[seen].astype(np.int64)
        v = np.bincount(symbol, weights=(total > 0) & ~often, minlength=END)[seen].astype(np.int64)
        stats = [np.concatenate(x).astype("<i8").tobytes() for x in ([seen, c, v], [words[often].view(np.int64), total[often]])]
        yield pa.RecordBatch.from_arrays([pa.array([None, None], pa.int64()), pa.array([-1, -2], pa.int32()), pa.array(stats, pa.binary())], names=["block", "part", "answer"])

    def columns(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in np.frombuffer(x.as_py(), "<i8").reshape(len(names), -1)], names=names)

    said = blocks.select("block", "payload").mapInArrow(announce, "block bigint, part int, words binary, counts binary")
    told = written(said.repartition(n, "part").mapInArrow(answer, "block bigint, part int, answer binary"), "counts", "none")
    of_kind = lambda part, *names: told.where(F.col("part") == part).select("answer").mapInArrow(lambda x: columns(x, list(names)), ", ".join(f"{x} bigint" for x in names))
    rows = of_kind(-1, "symbol", "c", "v").groupBy("symbol").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect()  # END rows at most
    c, v = np.zeros(END + 1, np.int64), np.zeros(END + 1, np.int64)
    for r in rows:
        c[r.symbol], v[r.symbol] = r.c, r.v
    often = of_kind(-2, "word", "c").collect()  # 2^OWN_BITS rows at most
    own = np.array([r.word for r in often], dtype=np.int64).view(np.uint64)
    order = np.argsort(own)
    c[: len(own)] = np.array([r.c for r in often], dtype=np.int64)[order]
    v[: len(own)] = 1
    c[END] = _training_texts(blocks)
    v[END] = int(c[END] > 0)
    return answers_by_block(told.where("block IS NOT NULL")), {"c": c, "v": v, "own": own[order]}


def _training_texts(blocks: DataFrame) -> int:
    def run(batches):
        for batch in batches:
            for payload in batch.column(0):
                block = unpack(payload.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([int((~held_out(block.ids, block.present)).sum())], pa.int64())], names=["n"])

    return blocks.select("payload").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def first_model(totals: dict, states: int) -> Model:
    """Symbols by their share, shifted a little differently for each state."""
    share = symbol_share(totals)
    noise = (mix(np.arange(len(share) * states, dtype=np.uint64) + np.uint64(11)) >> np.uint64(11)).astype(float) / 2**53
    emit = share[:, None] * np.exp(1.0 * (noise.reshape(len(share), states) - 0.5))
    own = totals.get("own", np.empty(0, np.uint64))
    return Model(np.full(states, 1 / states), np.full(states, 1 / states), np.eye(states) * 0.8 + 0.2 / states, emit / emit.sum(0), own)


def next_model(counted: np.ndarray, share: np.ndarray, own: np.ndarray | None = None) -> Model:
    """The model that expected counts (see ``expected_counts``) lead to."""
    emit, move, start = counted[: END + 1], counted[END + 1 : -1] + 0.1, counted[-1] + 0.1
    inside = emit.sum(0) + 1e-9
    inside = inside / inside.sum()
    of_state = (emit + PRIOR * inside) / (emit.sum(1, keepdims=True) + PRIOR)
    weighted = share[:, None] * of_state
    return Model(start / start.sum(), inside, move / move.sum(1, keepdims=True), weighted / weighted.sum(0), own)


def symbol_share(totals: dict) -> np.ndarray:
    weight = np.where((np.arange(END + 1) < TAIL) & (totals["v"] == 0), 0.0, room_of(totals))
    return weight / weight.sum()


def room_of(totals: dict) -> np.ndarray:
    """What the words of each symbol share: their counts and the added parts, with one
    unseen word for symbols of several words and for ``end`` none."""
    alone = (np.arange(END + 1) < TAIL) | (np.arange(END + 1) == END)
    return totals["c"] + ADDED * np.maximum(totals["v"] + ~alone, 1)


def _columns(symbols: np.ndarray, starts: np.ndarray, lens: np.ndarray):
    """For each step the symbols of all sequences still running; longest first."""
    order = np.argsort(-lens, kind="stable")
    starts, lens = starts[order], lens[order]
    running = len(lens) - np.searchsorted(lens[::-1], np.arange(1, int(lens.max(initial=0)) + 1), side="left")
    return order, [(symbols[starts[:m] + t], m) for t, m in enumerate(running.tolist())]


def expected_counts(model: Model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Expected counts of all sequences, by rows: emissions, transitions, starts.
    Segments are taken ``TOKENS_AT_ONCE`` tokens at a time, so that memory does not
    follow the block."""
    k = model.emit.shape[1]
    total = np.zeros((END + 1 + k + 1, k))
    lens = np.diff(bounds)
    pieces = -(-lens // SEGMENT)
    owner = np.repeat(np.arange(len(lens)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = bounds[:-1][owner] + nth * SEGMENT
    stops = np.minimum(starts + SEGMENT, bounds[1:][owner])
    before, after = np.maximum(starts - CONTEXT, bounds[:-1][owner]), np.minimum(stops + CONTEXT, bounds[1:][owner])
    step = TOKENS_AT_ONCE // SEGMENT
    for at in range(0, len(owner), step):
        part = slice(at, at + step)
        first, move, emit = _forward_backward(model, symbols, before[part], (after - before)[part], (starts - before)[part], (stops - before)[part], nth[part] == 0)
        total += np.concatenate([emit, move, [first]])
    return total


def _forward_backward(model: Model, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, since: np.ndarray, until: np.ndarray, opens: np.ndarray):
    """(start, move, emit) counts of the tokens ``since`` to ``until`` of the given
    sequences, and of the transitions into them; ``opens`` begin a text."""
    order, steps = _columns(symbols, starts, sizes)
    k = model.emit.shape[1]
    # Single precision is enough for counts that are summed in double precision.
    start, inside, move_, emit_ = (x.astype(np.float32) for x in (model.start, model.inside, model.move, model.emit))
    is_first, since, until = opens[order], since[order], until[order]
    alphas, scales, emits = [], [], []
    for t, (sym, m) in enumerate(steps):
        e = emit_[sym]
        a = (np.where(is_first[:, None], start, inside) if t == 0 else alphas[-1][:m] @ move_) * e
        s = a.sum(1, keepdims=True)
        alphas.append(a / s)
        scales.append(s)
        emits.append(e)
    emit, move = np.zeros((END + 1, k)), np.zeros((k, k))
    beta = np.ones((0, k), np.float32)
    gammas = [None] * len(steps)
    for t in range(len(steps) - 1, -1, -1):
        m = steps[t][1]
        full = np.ones((m, k), np.float32)
        if len(beta):
            ahead = emits[t + 1] * beta / scales[t + 1]
            full[: len(beta)] = ahead @ move_.T
            own = (since[: len(beta)] <= t + 1) & (t + 1 < until[: len(beta)])
            move += (alphas[t][: len(beta)].T @ (ahead * own[:, None])) * move_
        beta = full
        g = alphas[t] * beta
        own = (since[:m] <= t) & (t < until[:m])
        gammas[t] = g * (own[:, None] / g.sum(1, keepdims=True))
    if steps:
        sym, gamma = np.concatenate([s for s, _ in steps]), np.concatenate(gammas)
        for j in range(k):
            emit[:, j] = np.bincount(sym, weights=gamma[:, j], minlength=END + 1)
    return (gammas[0][is_first].sum(0) if steps else np.zeros(k)), move, emit


def train(blocks: DataFrame, totals: dict, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Symbols of the training texts are written once and read in every round."""
    model, share = first_model(totals, states), symbol_share(totals)
    names = [f"s{j}" for j in range(states)]
    schema = "row bigint, " + ", ".join(f"{x} double" for x in names)
    context = blocks.sparkSession.sparkContext
    own = context.broadcast(model.own)

    def symbolised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for payload in batch.column(0):
                _, hashes, bounds, held = _texts(payload.as_py())
                symbols, ends = with_ends(hashes, bounds, own.value)
                keep = np.repeat(~held, np.diff(ends))
                yield pa.RecordBatch.from_arrays([pa.array([press.compress(x.tobytes())], pa.binary()) for x in (symbols[keep].astype("<u2"), np.diff(ends)[~held].astype("<i8"))], names=["symbols", "lens"])

    read = written(blocks.select("payload").mapInArrow(symbolised, "symbols binary, lens binary"), "symbols", "none")
    for _ in range(rounds):
        sent = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros((END + 1 + states + 1, states))
            unpress = zstandard.ZstdDecompressor()
            for batch in batches:
                for symbols, lens in zip(batch.column(0), batch.column(1), strict=True):
                    bounds = np.concatenate([[0], np.cumsum(np.frombuffer(unpress.decompress(lens.as_py()), "<i8"))])
                    total += expected_counts(sent.value, np.frombuffer(unpress.decompress(symbols.as_py()), "<u2").astype(np.int32), bounds)
            rows = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(total[rows, j]) for j in range(states)]], names=["row", *names])

        counted = read.mapInArrow(run, schema).groupBy("row").agg(*[F.sum(x).alias(x) for x in names]).collect()
        sent.unpersist()
        total = np.zeros((END + 1 + states + 1, states))
        for r in counted:  # END + states + 2 rows at most
            total[r.row] = r[1:]
        model = next_model(total, share, model.own)
    discard(read)
    return model


def with_ends(hashes: np.ndarray, bounds: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each closed by END, and their bounds."""
    lens = np.diff(bounds)
    ends = np.concatenate([[0], np.cumsum(lens + 1)])
    out = np.full(int(ends[-1]), END, dtype=np.int32)
    out[np.arange(len(hashes)) + np.repeat(np.arange(len(lens)), lens)] = symbols_of(hashes, own)
    return out, ends


def log10_likelihood(model: Model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scaled forward recursion over each whole sequence."""
    order, steps = _columns(symbols, bounds[:-1], np.diff(bounds))
    total = np.zeros(len(order))
    alpha = None
    for sym, m in steps:
        alpha = (model.start if alpha is None else alpha[:m] @ model.move) * model.emit[sym]
        s = alpha.sum(1)
        total[:m] += np.log10(s)
        alpha /= s[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``.

    Null texts are empty: one ``end`` token. A null id counts as an empty id text.
    Repeated rows count each time. Without training texts every count is 0 and the
    scores follow from the added 0.1. Extra columns are ignored.
    """
    blocks = text_blocks(df, id_col, text_col)
    counts, totals = word_counts(blocks)
    model = train(blocks, totals, states, rounds)
    n, v = int(totals["c"].sum()), int(totals["v"].sum())
    n_ranges = key_ranges(blocks)
    sent = df.sparkSession.sparkContext.broadcast((model, totals))  # a few MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, totals = sent.value
        room = np.log10(np.maximum(room_of(totals), 1e-300))
        for batch in batches:
            for payload, answers in zip(batch["payload"], batch["answers"], strict=True):
                block, hashes, bounds, held = _texts(payload.as_py())
                words, inverse = np.unique(hashes, return_inverse=True)
                parts, at = parts_of(_ranges(words, n_ranges))
                place = {p: i for i, p in enumerate(parts.tolist())}
                known = np.zeros(len(words), np.int64)
                for x in answers.as_py() or []:
                    known[at[place[x["part"]]] : at[place[x["part"]] + 1]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(x["answer"]), np.int64)
                c = known[inverse]
                symbols, ends = with_ends(hashes, bounds, model.own)
                is_end = symbols == END
                full = np.empty(len(symbols), np.int64)
                full[~is_end], full[is_end] = c, totals["c"][END]
                word = np.log10(full + ADDED)
                within = np.where(is_end, 0.0, word - room[symbols])
                first = ends[:-1]
                base = np.add.reduceat(word - np.log10(n + ADDED * (v + 1)), first)
                score = log10_likelihood(model, symbols, ends) + np.add.reduceat(within, first)
                ids = pa.array(block.ids, pa.int64(), mask=~block.present)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(held), pa.array(np.diff(ends)), pa.array(np.add.reduceat((full > 0).astype(np.int64), first)),
                        pa.array(np.full(len(first), n)), pa.array(base), pa.array(score),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return blocks.select("block", "payload").join(counts, "block", "left").select("payload", "answers").mapInArrow(run, schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
