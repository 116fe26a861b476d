"""Operators on single texts and corpora, against brute force or exact round trips."""

import hashlib
import itertools
import math
import random
import re
import threading
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyflow.llm import blocks, bpe, chat, langid, lm, media, mixing, quality, substrings, words
from keyflow.llm.store import shared_dir

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
fold = lambda i, n: zlib.crc32(b"" if i is None else str(i).encode()) % n


@given(st.lists(st.text("ab \t\n\x0b\x1cé中", max_size=30), max_size=6))
def test_word_hashes(texts):
    hashes, bounds = words.many_word_hashes([t.encode() for t in texts])
    lists = [WORDS.findall(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(x) for x in lists]
    flat = [w for x in lists for w in x]
    assert len({*zip(flat, hashes.tolist(), strict=True)}) == len(set(flat)) == len(set(hashes.tolist()))


def test_word_hashes_in_pieces(monkeypatch):
    data = b" ".join([b"word%d" % (i % 50) for i in range(3000)] + [b"x" * 700])
    whole = words.word_hashes(data)
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    assert all((a == b).all() for a, b in zip(whole, words.word_hashes(data), strict=True))


def test_blocks(docs):
    found = blocks.text_blocks(docs, carry=("source", "n_chars"), block_bytes=2000)
    rows = []
    for r in found.collect():
        b = blocks.unpack(bytes(r.payload))
        rows += zip(np.where(b.present, b.ids, -1).tolist(), [t.decode() for t in b.texts], b.carried.column(0).to_pylist(), b.carried.column(1).to_pylist(), strict=True)
    key = lambda r: tuple(map(str, r))
    assert sorted(rows, key=key) == sorted([(r.doc_id, r.text or "", r.source, r.n_chars) for r in docs.collect()], key=key)


def removed(rows):
    """Words that stay, by definition."""
    lists = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in lists:
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    out = []
    for i, w in lists:
        gone = {k + d for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for d in range(13)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_duplicate_spans(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = removed(rows)
    assert sorted(tuple(r) for r in substrings.duplicate_spans(docs).collect()) == want and sum(r[2] for r in want) > 100
    assert substrings.duplicate_spans(no_docs).count() == 0


def test_factors(docs):
    """Each factor is a run of words that an earlier document has where the factor says,
    a window long at least, and as long as it can be or as what it was lent; all windows
    of earlier documents lie in factors."""
    texts = {r.doc_id: WORDS.findall(r.text or "") for r in docs.collect()}
    first = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - 12):
            first.setdefault(tuple(texts[i][k : k + 13]), i)
    factors = {}
    for f in substrings.duplicate_factors(docs).collect():
        assert f.length >= 13 and f.source_id < f.doc_id
        run = texts[f.doc_id][f.start : f.start + f.length]
        assert run == texts[f.source_id][f.source_start : f.source_start + f.length]
        assert first[tuple(run[:13])] == f.source_id
        factors.setdefault(f.doc_id, set()).update(range(f.start, f.start + f.length - 12))
    want = {i: {k for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i} for i, w in texts.items()}
    assert factors == {i: w for i, w in want.items() if w}


def test_agreement_reads_words():
    """Equal hashes of other words do not count."""
    a, b = substrings.Laid.of([b"x y z q"]), substrings.Laid.of([b"x  y w q"])
    assert substrings.agreement(a, 0, 4, b, 0, 4) == 2
    b.words = a.words
    assert substrings.agreement(a, 0, 4, b, 0, 4) == 2


def test_long_texts_in_substrings(spark):
    """Texts above a block's size, which hold each other's passages."""
    rnd = random.Random(8)
    one = [f"w{rnd.randrange(10**6)}" for _ in range(30_000)]
    rows = [(1, " ".join(one)), (2, " ".join([*one[20_000:], *one[:100]])), (3, " ".join(one[5_000:5_040]))]
    found = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert blocks.text_blocks(found, block_bytes=50_000).count() >= 2
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.duplicate_spans(found).collect()) == [(1, 30_000, 0), (2, 10_100, 10_100), (3, 40, 40)]


def test_substring_stage(docs, no_docs):
    out = substrings.without_duplicates(docs)
    got = sorted((r.doc_id, " ".join(WORDS.findall(r.text or ""))) for r in out.collect())
    assert got == sorted((i, kept) for i, n, gone, kept in removed([(r.doc_id, r.text) for r in docs.collect()]) if kept or not n)
    assert out.columns == docs.columns and all(r.text is None or r.n_chars == len(r.text) for r in out.collect())
    untouched = {r.doc_id: r.text for r in docs.collect()}
    assert any(r.text == untouched[r.doc_id] and "\x0b" in r.text for r in out.where("text IS NOT NULL").collect())
    assert substrings.without_duplicates(no_docs).count() == 0


def test_null_ids_in_substrings(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = spark.createDataFrame([(None, text), (2, text), (3, text + " x"), (None, text)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substrings.duplicate_spans(rows).collect()) == [(0, 0), (0, 0), (2, 0), (3, 20)]


@pytest.fixture(scope="module")
def codec():
    with open(bpe.default_path(), encoding="utf-8") as f:
        return bpe.BpeCodec(f.read())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(" \n\t\x0b\x1c\x85\xa0abctheing'sd09é中.,!<|>", max_size=80), st.text("aeit hn", max_size=200)))
def test_bpe_equals_the_library(codec, library, text):
    ids = codec.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert codec.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_bpe_characters(codec, library):
    """Every character beside letters, digits, symbols, spaces, itself and a character
    whose bytes merge with others': the split classes are the library's for all of Unicode."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{x}b{x}{x}1{x}2 {x}!{x}\u6962" for x in chars[at : at + 256]) for at in range(0, len(chars), 256)]
    theirs = library.encode_batch(texts, add_special_tokens=False)
    assert not [t[:20] for t, mine, their in zip(texts, codec.encode_all(texts), theirs, strict=True) if mine.tolist() != their.ids]
    assert codec.encode("\U00013fb6\u6962").tolist() == [172, 241, 122, 35050, 98, 95]


def test_bpe_white_space_and_cuts(codec, library, monkeypatch):
    """Random texts of pieces that join and part units, also cut into short stretches."""
    rng = random.Random(4)
    pieces = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "a", "\u00e9", "1", "!", "'s", "'", "<|endoftext|>", "the", "ing", "x" * 60]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 25))) for _ in range(4000)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in codec.encode_all(texts)] == want
    assert codec.decode_all(codec.encode_all(texts)) == texts
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 16)
    assert [x.tolist() for x in codec.encode_all(texts[:1000])] == want[:1000]


def test_bpe_query(docs, library, no_docs):
    got = bpe.digests(bpe.bpe_columns(docs, bpe.default_path())).collect()
    for r, d in zip(sorted(got, key=lambda r: r.doc_id), sorted(docs.collect(), key=lambda r: r.doc_id), strict=True):
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens, r.ids_sha256) == (d.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert bpe.bpe_columns(no_docs, bpe.default_path()).count() == 0


def test_media(spark, docs, no_docs, tmp_path):
    uri = f"file://{tmp_path}/a"
    media.write_archives(docs.repartition(3), uri).collect()
    got = sorted(media.features(media.read_archives(spark, uri, splitBytes=512)).collect(), key=lambda r: r.doc_id)
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    for r, d in zip(got, rows, strict=True):
        raw = (d.text or "").encode()
        payload = raw + b"\0" * ((-len(raw)) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        png = media.to_png(payload)
        assert (r.media_bytes, r.media_sha256) == (len(png), hashlib.sha256(png).hexdigest()) and media.from_png(png).tobytes() == payload
    media.write_archives(no_docs, f"file://{tmp_path}/b").collect()
    assert media.read_archives(spark, f"file://{tmp_path}/b").count() == 0 and media.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_members_are_retried_alone(tmp_path):
    reader = media.MediaArchiveReader({"path": f"file://{tmp_path}", "retries": "2"})
    tries = Counter()

    def flaky(name, fails):
        tries[name] += 1
        if tries[name] <= fails:
            raise OSError(name)
        return name

    assert reader._retried(lambda: flaky("a", 2)) == "a" and tries["a"] == 3
    with pytest.raises(OSError):
        reader._retried(lambda: flaky("b", 3))
    with pytest.raises(ValueError):
        media.from_png(media.to_png(bytes(64))[:-20] + b"\0" * 20)
    with pytest.raises(ValueError):
        media.from_png(b"no image")


def test_damaged_members_are_read_again(spark, docs, tmp_path):
    """One byte of one member is wrong when Spark's tasks read it, and right a little later."""
    uri = f"file://{tmp_path}/a"
    media.write_archives(docs.coalesce(1), uri).collect()
    (path,) = (tmp_path / "a").glob("*.kfm")
    good = path.read_bytes()
    at = good.index(b"IDAT", len(good) // 3) + 20
    path.write_bytes(good[:at] + bytes([good[at] ^ 255]) + good[at + 1 :])
    with pytest.raises(Exception, match="damaged PNG chunk"):
        media.read_archives(spark, uri, retries=0).count()
    timer = threading.Timer(3.0, lambda: path.write_bytes(good))
    timer.start()
    assert media.read_archives(spark, uri, retries=7).count() == docs.count()
    timer.join()


def test_media_features(spark):
    """The summary of the samples, recomputed from the text's bytes."""
    texts = ["", "a", "zero \x00 bytes", "x" * 200]
    found = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    directory = f"{shared_dir(spark)}/features-{random.random()}"
    media.write_archives(found, directory).collect()
    for r in media.features(media.read_archives(spark, directory)).collect():
        raw = texts[r.doc_id].encode()
        samples = np.frombuffer(raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0"), np.uint8)
        mean = sum(map(int, samples)) / len(samples)
        deviation = math.sqrt(sum((int(x) - mean) ** 2 for x in samples) / len(samples))
        assert r.feature == f"{len(samples) // 64}x64 {mean:.4f} {deviation:.4f} {list(samples).count(0)}"


def test_chat(spark):
    rows = [
        (1, 2, "assistant", "<|end|>\\1"), (1, 0, "user", "a\\0<|part|>"), (1, 1, "assistant", "b|"), (1, 1, "assistant", "b|"), (2, None, None, None), (2, 5, "as|>sis", "<"), (None, 1, "assistant", "é中🙂"),
        (3, 0, "system", ""), (3, 1, "assistant", ""), (3, 2, "assistant", "|>x<|"), *[(4, i, "user" if i % 3 else "assistant", f"t{i}<|") for i in range(60)],
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, blocks string")
    out = chat.format_conversations(table)
    back = chat.with_loss_text(out).select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), "loss", "loss_spans").collect()
    assert len(back) == 5
    for r in back:
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(x.role, x.text) for x in r.turns] == [x[1:] for x in own]
        assert r.loss == "".join(x[2] for x in own if x[1] == "assistant")
        assert len(r.loss_spans) == sum(x[1] == "assistant" for x in own)
    one = next(r for r in back if r.conv_id == 3)
    assert one.formatted == "<|turn system|><|end|><|turn assistant|><|part|>\\2x\\1<|end|>"
    assert chat.format_conversations(table.limit(0)).count() == 0


def plan_of(rows, share=1.5, weights=(5, 2, 1), most=2):
    """Targets by repeated resharing."""
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, full = share * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: most * sizes[s] if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in order}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return sizes, target
        full |= over


@pytest.mark.parametrize("bucket", [4096, 3])
def test_mixture(docs, no_docs, bucket):
    rows = [(r.source, len(WORDS.findall(r.text or ""))) for r in docs.collect()]
    sizes, target = plan_of(rows)
    got = mixing.mixture(docs, rows_per_bucket=bucket).collect()
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target) and len(got) == len(rows)
    again = mixing.mixture(docs.repartition(5), rows_per_bucket=bucket).collect()
    assert sorted((r.id, r.taken) for r in got) == sorted((r.id, r.taken) for r in again)
    assert mixing.mixture(no_docs).count() == 0


def test_mixing_stage(docs, no_docs):
    plan = {}
    for r in mixing.mixture(docs, whole=True).collect():
        plan.setdefault(r.id, []).append((r.source, r.epochs + (r.part > 0), r.size))
    out = mixing.mixed_documents(docs)
    got = Counter(r.doc_id for r in out.collect())
    for i, rows in plan.items():
        if all(size for _, _, size in rows) and len(rows) == 1:
            assert got[i] == rows[0][1]
    assert out.columns == docs.columns and mixing.mixed_documents(no_docs).count() == 0


def test_targets_with_nothing(spark):
    rows = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id bigint, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mixture(rows).collect()] == [(0.0, 0)] * 2


def test_lm_counts(docs, no_docs):
    rows = docs.collect()
    split = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORDS.findall(t or "")] + [None]
    counts = Counter(w for r in rows if fold(r.doc_id, 10) for w in split(r.text))
    n, v = sum(counts.values()), len(counts)
    got = sorted(lm.lm_scores(docs, states=3, rounds=1).collect(), key=lambda r: r.doc_id)
    for r, d in zip(got, sorted(rows, key=lambda r: r.doc_id), strict=True):
        tokens = split(d.text)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(counts[w] > 0 for w in tokens), n, fold(d.doc_id, 10) == 0)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), rel_tol=1e-9)
        assert r.score < 0
    assert lm.lm_scores(no_docs, rounds=1).count() == 0
    assert lm.lm_scores(docs.where("doc_id = 999999"), rounds=1).count() == 0
    alone = docs.where("doc_id IS NOT NULL").collect()
    held = [r.doc_id for r in alone if not fold(r.doc_id, 10)]
    untrained = lm.lm_scores(docs.where(F.col("doc_id").isin(held)), rounds=1).collect()
    assert untrained and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) and math.isfinite(r.base_score) for r in untrained)


def test_lm_score_is_the_sum_over_paths(spark, monkeypatch):
    """Scores of short texts against all state paths, word by word, with frequent words of
    their own symbol and rare words in shared ones."""
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(["a", "b", "c", f"r{rnd.randrange(40)}"]) for _ in range(rnd.randrange(0, 5))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(lm, "OWN_BITS", 4)  # words with a sixteenth of all have their own symbol
    found = blocks.text_blocks(df)
    _, totals = lm.word_counts(found)
    assert 2 <= len(totals["own"]) <= 16
    model = lm.train(found, totals, 2, 2)
    room, counts = lm.room_of(totals), Counter(w for i, t in enumerate(texts) if fold(i, 10) for w in t.split())
    got = {r.doc_id: r.score for r in lm.lm_scores(df, states=2, rounds=2).collect()}
    for i, t in enumerate(texts):
        hashes, _ = words.many_word_hashes([t.encode()])
        symbols = [*lm.symbols_of(hashes, totals["own"]).tolist(), lm.END]
        within = math.prod((counts[w] + 0.1) / room[x] for w, x in zip(t.split(), symbols, strict=False))
        total = 0.0
        for path in itertools.product(range(2), repeat=len(symbols)):
            p = model.start[path[0]] * model.emit[symbols[0], path[0]]
            for a, b, x in zip(path[:-1], path[1:], symbols[1:], strict=True):
                p *= model.move[a, b] * model.emit[x, b]
            total += p
        assert math.isclose(got[i], math.log10(total * within), rel_tol=1e-6)


def test_segments_count_every_transition(monkeypatch):
    """Counts of segments with their context are nearly those of whole texts."""
    rng = np.random.default_rng(3)
    symbols = np.append(np.where(rng.random(999) < 0.5, rng.integers(0, 20, 999), rng.integers(20, 40, 999)), lm.END).astype(np.int32)
    bounds, model = np.array([0, 400, 401, 1000]), tiny_model(2, 5)
    whole = lm.expected_counts(model, symbols, bounds)
    monkeypatch.setattr(lm, "SEGMENT", 32)
    cut = lm.expected_counts(model, symbols, bounds)
    assert np.allclose(whole, cut, atol=0.02) and math.isclose(cut[lm.END + 1 : -1].sum(), 1000 - 3, rel_tol=1e-4)


def tiny_model(k=3, seed=0):
    rng = np.random.default_rng(seed)
    emit = rng.random((lm.END + 1, k))
    move = rng.random((k, k))
    return lm.Model(np.full(k, 1 / k), np.full(k, 1 / k), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_is_exact():
    model, rng = tiny_model(), np.random.default_rng(1)
    sequences = [rng.integers(0, lm.END, n).tolist() + [lm.END] for n in (0, 1, 4, 4, 6)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    got = lm.log10_likelihood(model, np.array([x for s in sequences for x in s], dtype=np.int32), bounds)
    for s, g in zip(sequences, got, strict=True):
        alpha = model.start * model.emit[s[0]]
        for x in s[1:]:
            alpha = (alpha @ model.move) * model.emit[x]
        assert math.isclose(g, math.log10(alpha.sum()), rel_tol=1e-9)


def test_baum_welch_raises_the_likelihood(monkeypatch):
    monkeypatch.setattr(lm, "TOKENS_AT_ONCE", 512)
    rng = np.random.default_rng(2)
    sequences = [np.append(rng.integers(0, 40, 30) + (500 if i % 2 else 0), lm.END) for i in range(60)]
    symbols, bounds = np.concatenate(sequences).astype(np.int32), np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    totals = {"c": np.bincount(symbols, minlength=lm.END + 1), "v": np.ones(lm.END + 1, dtype=int)}
    model, last = lm.first_model(totals, 2), -math.inf
    for _ in range(5):
        now = lm.log10_likelihood(model, symbols, bounds).sum()
        assert now > last
        last, total = now, lm.expected_counts(model, symbols, bounds)
        assert math.isclose(total[: lm.END + 1].sum(), len(symbols), rel_tol=1e-4)
        emit = total[: lm.END + 1] + 1e-6
        move, start = total[lm.END + 1 : -1] + 1e-3, total[-1] + 1e-3
        model = lm.Model(start / start.sum(), model.inside, move / move.sum(1, keepdims=True), emit / emit.sum(0))


def language_rows():
    rnd = np.random.default_rng(4)
    parts = {"en": ["th", "ing", "er", "and", "wh"], "de": ["sch", "ein", "ung", "ü", "ber"], "fr": ["eau", "que", "é", "oi", "ê"]}
    return [(i, " ".join("".join(rnd.choice(parts[lang], 3)) for _ in range(25)), lang) for i, lang in enumerate(rnd.choice(list(parts), 300))]


def test_language_id(spark):
    rows = language_rows()
    odd = [(1000, None, "en"), (1001, "123 !?", "de"), (1002, "", "fr"), (1003, "schein ungüber", None), (None, "the and whing", "en"), (1004, "the ander wher " * 90000, None)]
    table = spark.createDataFrame([(*r, "x") for r in [*rows, *odd]], "doc_id bigint, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.detect(table).collect()}
    held = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert len(held) > 20 and sum(got[i].lang_pred == str(lang) for i, lang in held) >= 0.98 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "de" and got[1004].lang_pred == "en" and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (fold(i, 5) == 0) for i, r in got.items())
    assert langid.detect(table.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.detect(table.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def plain_grams(text):
    """Features by definition: each run of one to three characters, hashed by integers."""
    chars = [c if ord(c) >= 128 or "a" <= c <= "z" else " " for c in text.lower()]
    out = Counter()
    for n in (1, 2, 3):
        for at in range(len(chars) - n + 1):
            gram = 0
            for c in chars[at : at + n]:
                gram = (gram * 0x100000001B3 + ord(c) + 1) % 2**64
            hashed = gram * langid._SALTS[n - 1] % 2**64 ^ gram >> 29
            out[(hashed * 0xD6E8FEB86659FD93 % 2**64) >> (64 - langid.FEATURE_BITS)] += 1
    return out


def test_language_scores_by_hand(spark):
    """Every prediction again, from the model's numbers, in plain Python; ties too."""
    rows = language_rows()[:120] + [(500, "1a", "en"), (501, "é " * 300, "fr")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(table.where("doc_id % 5 != 0"), 50)
    training = [t for i, t, _ in rows if i % 5]
    seen = Counter(f for t in training for f in plain_grams(t))
    for r in langid.predict(table, model).collect():
        counts = plain_grams(dict((i, t) for i, t, _ in rows)[r.doc_id])
        values = {f: (1 + math.log(c)) * (math.log((1 + len(training)) / (1 + seen[f])) + 1) for f, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in values.values()))
        logits = [sum(v / norm * model.weights[f][k] for f, v in values.items()) + model.bias[k] for k in range(len(model.languages))]
        powers = [math.exp((x - max(logits)) / model.temperature) for x in logits]
        assert r.lang_pred == model.languages[logits.index(max(logits))] and math.isclose(r.score, max(powers) / sum(powers), rel_tol=1e-6)
    even = langid.LanguageModel(["aa", "bb"], model.idf, np.zeros((langid.FEATURES, 2)), np.zeros(2), 1.0)
    assert {(r.lang_pred, r.score) for r in langid.predict(table, even).collect()} == {("aa", 0.5)}


def test_grams_of_long_texts(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(500)) + " ÀÉ, x"
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_WINDOW", 37)
    assert all((a == b).all() for a, b in zip(whole, langid.gram_counts(text), strict=True))


def quality_rows():
    rnd = np.random.default_rng(6)
    out = []
    for i in range(400):
        w = ["".join(rnd.choice(list("abcdefgh"), rnd.integers(2, 8))) for _ in range(rnd.integers(20, 60))]
        bad = i % 4 == 0
        out.append((i, ". ".join(f"{x}!!".upper() if bad else x for x in w), 0 if bad else 1))
    return out


def test_quality(spark):
    rows = quality_rows()
    odd = [(1000, None, 1), (1001, "", None), (1002, "word " * 100000, None), (None, "a b", 0)]
    table = spark.createDataFrame([(i, t, "x") for i, t, _ in [*rows, *odd]], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in [*rows, *odd]] + [(5000, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score_documents(table, labels).collect()}
    assert len(got) == 404 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(i, q) for i, _, q in rows if got[i].held_out]
    assert sum(got[i].predicted == q for i, q in held) >= 0.97 * len(held)
    kept = quality.good_documents(table, labels)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    assert {r.score for r in quality.score_documents(table, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(table.limit(0), labels).count() == 0
    one = quality.score_documents(table, labels.where("quality = 1"))
    assert {r.predicted for r in one.collect()} == {1}


def test_quality_scores_by_hand(spark):
    """Scores again from the texts, in plain Python: statistics, rules, weights."""
    rows = [*quality_rows()[:200], (900, "", 1), (901, None, 0), (902, "A a a\nA a a\n\n1.5 x! y? #", 1), (903, "Ünï ß Ǆ ٣ " * 30, 0), (904, "one\u00a0two\x1cthree. ", 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, n int").drop("n")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    model = quality.fit(table, labels)
    assert model.rules
    got = {r.doc_id: r for r in quality.score_documents(table, labels).collect()}
    for i, text, _ in rows:
        text = text or ""
        w, lines = WORDS.findall(text), text.split("\n")
        n, chars = len(w), len(text)
        marked = lambda pattern: len(regex.findall(pattern, text))  # noqa: B023, E731
        share = lambda a, b: a / max(b, 1)
        stats = {
            "chars": chars, "n": n, "word_length": share(chars, n), "upper_share": share(marked(r"\p{Lu}"), chars), "digit_share": share(marked(r"\p{Nd}"), chars),
            "stop_share": share(marked(r"[.?!](?=[ \t\n\x0b\f\r]|$)"), n), "symbol_share": share(marked(r"[#$%&*@^~<>{}\[\]|\\]"), n), "mark_share": share(text.count("!"), n),
            "own_share": share(len(set(w)), n), "twice_share": share(sum(a == b for a, b in zip(w[:-1], w[1:], strict=True)), n), "line_words": share(n, len(lines)), "own_line_share": share(len(set(lines)), len(lines)),
        }
        total = model.bias + sum(weight for rule, weight in zip(model.rules, model.weights, strict=True) if all((stats[name] > bound) == above for name, above, bound in rule))
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-total)), rel_tol=1e-9) and got[i].predicted == (got[i].score >= 0.3)


def test_compiled_rules_equal_the_fitted_ones(spark):
    rng = np.random.default_rng(8)
    x = rng.random((300, len(quality.FEATURES))).round(3)
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.7)).astype(float)
    rules = quality.grow_rules(x, y)
    weights, bias = quality.fit_lasso(np.stack([quality.holds(r, x) for r in rules], 1), y)
    model = quality.RuleModel([tuple((quality.FEATURES[j], a, b) for j, a, b in r) for r in rules], weights.tolist(), bias)
    want = 1 / (1 + np.exp(-(np.stack([quality.holds(r, x) for r in rules], 1) @ weights + bias)))
    table = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "i int, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    got = table.select("i", F.struct(*quality.FEATURES).alias("__stats")).select("i", quality.compiled(model).alias("p")).collect()
    assert max(abs(r.p - want[r.i]) for r in got) < 1e-9
    assert ((want >= 0.5) == (y > 0)).mean() > 0.97 and (np.abs(weights) < 1e-4).any()
