"""Byte-level BPE: backtracking encoder over Aho-Corasick matches, offset-table decoder.

Encoding takes, from left to right, the longest token that starts at the current
byte (all of them come from one Aho-Corasick pass) and accepts it if it is
compatible with the token before it: the two, encoded together, must come out as
exactly these two. Otherwise the next shorter token is tried, and if none is left
the previous token is withdrawn and its end marked as a dead end. Each byte position
fails at most once, so the work is linear, and the result is the one that applying
the merges in rank order gives. Decoding gathers bytes from one table of all tokens'
bytes through their offsets.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and digits that came after Unicode 16, whose tables split texts
#: for these vocabularies; there they are symbols, whatever newer tables say.
NEWER = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb "
    "\U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 "
    "\U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 "
    "\U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de "
    "\U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).split()
CACHE_ENTRIES, CACHE_CHARS = 60_000, 40
CHUNK_CHARS, BATCH_TEXTS, PAIR_BITS, STEP_BYTES = 1 << 21, 512, 18, 48
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BpeCodec:
    """``spec`` is the text of a tokenizer file with a byte-level BPE model.

    Inside, a token is its rank: bytes 0-255, then one number per merge in order.
    """

    def __init__(self, spec: str):
        spec = json.loads(spec)
        vocab, merges, letters = spec["model"]["vocab"], spec["model"]["merges"], byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.bytes_of = [bytes([b]) for b in range(256)]
        rank_of = {t: i for i, t in enumerate(self.bytes_of)}
        self.left, self.right, self.merge = list(range(256)), list(range(256)), {}
        named = {raw(s): i for s, i in vocab.items()}
        for pair in merges:
            a, b = (raw(s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            rank = len(self.bytes_of)
            self.left.append(rank_of[a])
            self.right.append(rank_of[b])
            self.merge[rank_of[a], rank_of[b]] = rank
            self.bytes_of.append(a + b)
            rank_of.setdefault(a + b, rank)
        self.ids = [named.get(t, -1) for t in self.bytes_of]
        reached = [True] * 256
        for t in range(256, len(self.bytes_of)):
            a, b = self.left[t], self.right[t]
            reached.append(rank_of[self.bytes_of[t]] == t and reached[a] and reached[b] and self.compatible(a, b, t))
        self.rank_of = {t: i for t, i in rank_of.items() if reached[i]}
        self.shorter = [next((self.rank_of[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.rank_of), -1) for t in self.bytes_of]
        self.automaton = ahocorasick.Automaton()
        for t, i in self.rank_of.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or ()}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.newer = regex.compile("[" + "".join(NEWER) + "]")
        table = {i: t for i, t in zip(self.ids, self.bytes_of, strict=True) if i >= 0} | {i: s.encode() for s, i in self.special.items()}
        sizes = np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.blob = np.frombuffer(b"".join(table.get(i, b"") for i in range(max(table) + 1)), dtype=np.uint8)
        self.id_of = np.array(self.ids, dtype=np.int32)
        self.size_of = np.array([len(t) for t in self.bytes_of], dtype=np.int64)
        self.units, self.tokens = Remembered(), Remembered()
        n = len(self.bytes_of)
        self.parents = np.array([self.left, self.right], dtype=np.int64)
        self.next_shorter = np.array(self.shorter, dtype=np.int64)
        keys = np.array([a * n + b for a, b in self.merge], dtype=np.int64)
        order = np.argsort(keys)
        self.merge_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merge_ranks = np.append(np.fromiter(self.merge.values(), np.int64, len(keys))[order], _NEVER)
        self.pair_keys, self.pair_fits = np.full(1 << PAIR_BITS, -1, dtype=np.int64), np.zeros(1 << PAIR_BITS, dtype=bool)

    def forget(self) -> None:
        """Let go of what has been remembered."""
        self.units, self.tokens = Remembered(), Remembered()

    def compatible(self, a: int, b: int, limit: int = _NEVER) -> bool:
        """Whether no merge of rank below ``limit`` joins the end of a to the start of b.

        Walks back through the younger token's merges: before it existed, its part
        next to the boundary stood there.
        """
        while True:
            joined = self.merge.get((a, b))
            if joined is not None and joined < limit:
                return False
            if a >= b and a >= 256:
                limit, a = min(limit, a), self.right[a]
            elif b >= 256:
                limit, b = min(limit, b + 1), self.left[b]
            elif a >= 256:
                limit, a = min(limit, a), self.right[a]
            else:
                return True

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays of pairs, remembered in a table of fixed size."""
        keys = a * len(self.bytes_of) + b
        slots = (keys * 0x9E3779B1 >> 12) & ((1 << PAIR_BITS) - 1)
        out = self.pair_fits[slots]
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        if len(new):
            out[new] = self._compatible_all(a[new], b[new])
            self.pair_keys[slots[new]], self.pair_fits[slots[new]] = keys[new], out[new]
            # Two of the new pairs may have met in one slot, so what it says must be the last one's.
            clash = self.pair_keys[slots[new]] != keys[new]
            self.pair_keys[slots[new][clash]] = -1
        return out

    def _compatible_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, at, limit = np.ones(len(a), dtype=bool), np.arange(len(a)), np.full(len(a), _NEVER)
        while len(at):
            key = a * len(self.bytes_of) + b
            place = np.searchsorted(self.merge_keys, key)
            bad = (self.merge_keys[place] == key) & (self.merge_ranks[place] < limit)
            out[at[bad]] = False
            go = ~bad & (np.maximum(a, b) >= 256)
            a, b, limit, at = a[go], b[go], limit[go], at[go]
            older = a >= b
            limit = np.minimum(limit, np.where(older, a, b + 1))
            a, b = np.where(older, self.parents[1, a], a), np.where(older, b, self.parents[0, b])
        return out

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ranks of one pre-token, by backtracking."""
        whole = self.rank_of.get(piece)
        if whole is not None:
            return [whole]
        longest = [0] * len(piece)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end - len(self.bytes_of[rank]) + 1] = rank
        out, pos, live, bytes_of = [], 0, [True] * (len(piece) + 1), self.bytes_of
        token = longest[0]
        while pos < len(piece):
            while token >= 0:
                end = pos + len(bytes_of[token])
                if live[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                pos = end
                token = longest[pos] if pos < len(piece) else -1
            else:
                live[pos] = False
                token = out.pop()
                pos -= len(self.bytes_of[token])
                token = self.shorter[token]
        return out

    def _matches(self, raw: list[bytes], method) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ranks of the automaton's matches in the pre-tokens, put end to end,
        each followed by a letter that no token has."""
        text = "Ā".join([r.decode("latin-1") for r in raw])
        found = np.fromiter(chain.from_iterable(method(text)), np.int64).reshape(-1, 2)
        return found[:, 0] + 1 - self.size_of[found[:, 1]], found[:, 1]

    def backtracked(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ranks of many pre-tokens: ``encode_bytes`` with all of them in step."""
        sizes = np.array([len(r) for r in raw])
        begin = np.cumsum(sizes + 1) - sizes - 1
        stop = begin + sizes
        longest = np.zeros(int(stop[-1]) + 1, dtype=np.int64)
        starts, ranks = self._matches(raw, self.automaton.iter)
        longest[starts] = ranks  # in order of their ends, so the longest comes last
        live = np.ones(len(longest), dtype=bool)
        stack = np.zeros(len(longest), dtype=np.int64)
        place, top = begin.copy(), begin.copy()  # of the next byte, and of the next free place of the stack
        token, on = longest[begin], np.arange(len(raw))
        while len(on):
            t = token[on]
            ends = place[on] + self.size_of[t]
            good = np.flatnonzero((t >= 0) & live[np.minimum(ends, len(live) - 1)])
            follows = good[top[on[good]] > begin[on[good]]]
            fit = np.zeros(len(on), dtype=bool)
            fit[good] = True
            fit[follows] = self.fits(stack[top[on[follows]] - 1], t[follows])
            push, pop = on[fit], on[t < 0]
            token[on] = self.next_shorter[t]
            stack[top[push]] = t[fit]
            top[push] += 1
            place[push] = ends[fit]
            token[push] = longest[ends[fit]]
            if len(pop):
                live[place[pop]] = False
                top[pop] -= 1
                last = stack[top[pop]]
                place[pop] -= self.size_of[last]
                token[pop] = self.next_shorter[last]
            on = on[place[on] < stop[on]]
        return [stack[a:b] for a, b in zip(begin.tolist(), top.tolist(), strict=True)]

    def encode_tokens(self, tokens: list[str]) -> list[bytes]:
        """Ids, as int32 bytes, of each pre-token.

        One pass of the automaton takes the longest matches of all of them. Where all
        neighbours are compatible, these are the answer, as only one sequence of
        compatible tokens exists; the others are backtracked.
        """
        raw = [t.encode() for t in tokens]
        ends = np.cumsum([len(r) + 1 for r in raw])
        starts, ranks = self._matches(raw, self.automaton.iter_long)
        stops = starts + self.size_of[ranks]
        owner = np.searchsorted(ends, stops, side="left")
        first = np.searchsorted(owner, np.arange(len(raw) + 1))
        begins = ends - np.diff(ends, prepend=0)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        wrong = np.diff(first) == 0
        some = ~wrong
        wrong[some] = (starts[first[:-1][some]] != begins[some]) | (stops[first[1:][some] - 1] != ends[some] - 1)
        wrong[owner[inner[(stops[inner] != starts[inner + 1]) | ~self.fits(ranks[inner], ranks[inner + 1])]]] = True
        blob, cut = self.id_of[ranks].tobytes(), (first * 4).tolist()
        out = [blob[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        again = np.flatnonzero(wrong).tolist()
        short = [i for i in again if len(raw[i]) <= STEP_BYTES]
        for i, found in zip(short, self.backtracked([raw[i] for i in short]) if short else (), strict=True):
            out[i] = self.id_of[found].tobytes()
        for i in again:
            if len(raw[i]) > STEP_BYTES:
                out[i] = self.id_of[self.encode_bytes(raw[i])].tobytes()
        return out

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a stretch of text."""
        if text.isascii() or not self.newer.search(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(self.newer.sub("\uffff", text))]

    def encode_units(self, joined: list[str], alone: list[str]) -> list[bytes]:
        """Ids, as int32 bytes, of stretches of text that no pre-token leaves: ``joined``
        start with a space and end without one, so that they can be split end to end."""
        tokens = self.split("".join(joined))
        for unit in alone:
            tokens += self.split(unit)
        known = self.tokens.get_all(tokens)
        new = list({t: None for t, k in zip(tokens, known, strict=True) if k is None})
        if new:
            made = dict(zip(new, self.encode_tokens(new), strict=True))
            known = [made[t] if k is None else k for t, k in zip(tokens, known, strict=True)]
            self.tokens.add(made)
        cut = np.searchsorted(np.cumsum(list(map(len, tokens))), np.cumsum([len(u) for us in (joined, alone) for u in us])).tolist()
        out, at = [], 0
        for c in cut:
            out.append(known[at] if c == at else b"".join(known[at : c + 1]))
            at = c + 1
        return out

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special tokens, end to end, and each text's bounds.

        A unit is a run of space-separated pieces up to the first that ends in a
        character other than white space: no pre-token reaches past such an end, as
        the space after it opens the next one. Each distinct unit is encoded once.
        """
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        number, pieces = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        bounds = bounds - bounds[0]
        is_open = np.array([not p or p[-1].isspace() for p in pieces], dtype=bool)
        heads = np.zeros(len(number), dtype=bool)
        heads[bounds[:-1]] = True
        # Runs that are no single piece after a space: starts of texts, and white space.
        joined, alone, runs, nothing, done = {}, {}, [], len(pieces), -1
        nth, text_ends = number.tolist() if is_open.any() else number, bounds[1:].tolist()
        starts = np.flatnonzero(heads | is_open[number])
        owners = np.searchsorted(bounds, starts, side="right") - 1
        for start, owner, is_head in zip(starts.tolist(), owners.tolist(), heads[starts].tolist(), strict=True):
            if start <= done:
                continue
            end, last = start, text_ends[owner] - 1
            if is_head and not pieces[nth[start]]:  # the text starts with a space, or is empty
                number[start] = nothing
                continue
            while end < last and is_open[nth[end]]:
                end += 1
            parts = [pieces[n] for n in nth[start : end + 1]]
            unit = " ".join(parts if is_head else ["", *parts])
            number[start : end + 1] = nothing
            (alone if is_head or unit[-1].isspace() else joined)[unit] = None
            runs.append((start, unit))
            done = end
        used = np.zeros(len(pieces) + 1, dtype=bool)
        used[number] = True
        known = self.units.get_all(pieces)
        new = [i for i, k in enumerate(known) if k is None and used[i]]
        if new or runs:
            made = self.encode_units([" " + pieces[i] for i in new] + list(joined), list(alone))
            for i, ids in zip(new, made, strict=False):
                known[i] = ids
            self.units.add({pieces[i]: known[i] for i in new})
            place = {u: len(pieces) + 1 + i for i, u in enumerate([*joined, *alone])}
            for start, unit in runs:
                number[start] = place[unit]
            known = [k or b"" for k in known] + [b""] + made[len(new) :]
        else:
            known = [k or b"" for k in known] + [b""]
        sizes = np.array([len(k) for k in known], dtype=np.int64) // 4
        blob = np.frombuffer(b"".join(known), dtype=np.int32)
        at = np.cumsum(sizes) - sizes
        lens = sizes[number]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return blob[np.repeat(at[number] - ends[:-1], lens) + np.arange(ends[-1])], ends[bounds]

    def pieces_of(self, text: str) -> Iterator[str | np.ndarray]:
        """Special tokens as their id, and the stretches between them, cut to about
        ``CHUNK_CHARS`` at ends of units."""
        at = 0
        for m in [*(self.special_pattern.finditer(text) if self.special_pattern else ()), None]:
            stop = m.start() if m else len(text)
            while at < stop:
                end = min(at + CHUNK_CHARS, stop)
                while end < stop and not (text[end] == " " and not text[end - 1].isspace()):
                    end += 1
                yield text[at:end]
                at = end
            if m:
                yield np.array([self.special[m[0]]], dtype=np.int32)
                at = m.end()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text; special tokens in it become their own ids."""
        out = [[] for _ in texts]
        plain, owners, held = [], [], 0

        def flush():
            if plain:
                ids, bounds = self._plain(plain)
                cut = bounds.tolist()
                for (i, at), a, b in zip(owners, cut[:-1], cut[1:], strict=True):
                    out[i][at] = ids[a:b]

        for i, text in enumerate(texts):
            for piece in self.pieces_of(text):
                if isinstance(piece, str):
                    plain.append(piece)
                    owners.append((i, len(out[i])))
                    held += len(piece)
                out[i].append(piece)
                if held >= CHUNK_CHARS:
                    flush()
                    plain, owners, held = [], [], 0
        flush()
        none = np.empty(0, dtype=np.int32)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else none for x in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, lists: list[np.ndarray]) -> list[str]:
        """Texts of lists of ids: the bytes are gathered through the offset table for as
        many lists at a time as make about ``CHUNK_CHARS`` tokens."""
        out, at = [], 0
        while at < len(lists):
            end, held = at, 0
            while end < len(lists) and (end == at or held + len(lists[end]) <= CHUNK_CHARS // 8):
                held += len(lists[end])
                end += 1
            ids = np.concatenate(lists[at:end])
            starts = self.offsets[ids]
            sizes = self.offsets[ids + 1] - starts
            ends = np.concatenate([[0], np.cumsum(sizes)])
            data = self.blob[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
            cut = ends[np.cumsum([0, *(len(x) for x in lists[at:end])])].tolist()
            out += [data[a:b].decode("utf-8", errors="replace") for a, b in zip(cut[:-1], cut[1:], strict=True)]
            at = end
        return out


class Remembered:
    """The entries used last, in two generations of bounded size."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.young, self.old = entries, {}, {}

    def get_all(self, keys: list[str]) -> list[bytes | None]:
        """Values of the keys, None where unknown; old entries that are used become young."""
        out = list(map(self.young.get, keys))
        if self.old:
            for i in [i for i, k in enumerate(out) if k is None]:
                known = self.old.get(keys[i])
                if known is not None:
                    out[i] = self.young[keys[i]] = known
        return out

    def add(self, made: dict[str, bytes]) -> None:
        self.young.update((k, v) for k, v in made.items() if len(k) <= CACHE_CHARS)
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}


_codecs: dict[int, BpeCodec] = {}


def codec_of(spec: str) -> BpeCodec:
    """One codec per worker process and specification."""
    key = hash(spec)
    if key not in _codecs:
        _codecs[key] = BpeCodec(spec)
    return _codecs[key]


def bpe_columns(df: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids`` (token ids of the whole text) and ``decoded``.

    ``path`` names a tokenizer file readable by the driver; its text, a few MB that
    do not depend on the data, is broadcast. A null text is an empty one: no ids, an
    empty decoded text. Distinct stretches of some hundred texts are encoded once;
    memory follows the longest text.
    """
    with open(path, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_TEXTS):
                batch = whole.slice(at, BATCH_TEXTS)
                ids = codec.encode_all(batch.column(batch.num_columns - 1).to_pylist())
                bounds = np.cumsum([0, *map(len, ids)])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(codec.decode_all(ids), pa.string())], names=[*batch.schema.names[:-1], "ids", "decoded"])
        codec.forget()  # the worker process goes on to other work

    return source.mapInArrow(run, schema)


def digests(df: DataFrame) -> DataFrame:
    """``n_tokens, ids_sha256, decoded_sha256`` in place of ``ids`` and ``decoded``."""
    return df.select(
        *[c for c in df.columns if c not in ("ids", "decoded")], F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark, sf_dir: str) -> DataFrame:
    return digests(bpe_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path()))
