"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters, hashed to 2**15 features; document frequencies
from all training documents; weights by follow-the-regularised-leader with L1 and L2
penalties on a bounded sample of ``per_language`` documents a language; one
temperature, fitted on sampled documents kept out of the training, calibrates the
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURE_BITS, ORDERS = 15, 3
FEATURES = 1 << FEATURE_BITS
PER_LANGUAGE, EPOCHS = 1500, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.5, 0.5
UNKNOWN, FOLDS = "und", 5
LETTER = r"\p{L}"
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_WINDOW = 1 << 20


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (FEATURES, languages)
    bias: np.ndarray
    temperature: float


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the whole text and their counts; ASCII non-letters read as spaces."""
    total = np.zeros(FEATURES, dtype=np.int64)
    for at in range(0, max(len(text), 1), _WINDOW):
        part = text[at : at + _WINDOW + ORDERS - 1].lower()
        points = np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        points = np.where((points < 128) & ~((points >= 97) & (points <= 122)), np.uint64(32), points)
        last = at + _WINDOW >= len(text)
        gram = np.zeros(len(points), dtype=np.uint64)
        for n in range(1, ORDERS + 1):
            if len(points) < n:
                break
            gram = gram[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(1)
            own = gram if last else gram[:_WINDOW]
            hashed = (own * np.uint64(_SALTS[n - 1])) ^ (own >> np.uint64(29))
            total += np.bincount((hashed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), minlength=FEATURES)
    found = np.flatnonzero(total)
    return found, total[found]


def tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], k: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; ``rows``: (class, features, values). The bias is feature -1."""
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for label, found, values in rows:
            at = np.append(found, FEATURES)
            x = np.append(values, 1.0)[:, None]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax((w * x).sum(0))
            p[label] -= 1
            g = x * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[at] = zi + g - sigma * w
            n[at] = ni + g * g
    w = weights(z, n)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least negative log-likelihood, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        return -np.log(softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels] + 1e-300).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fold(ident: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def fit(training: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """``training``: ``doc_id, text, lang``, none null. Frequencies use every row, the
    weights a hash sample of about ``per_language`` rows of each language."""

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total[gram_counts(text.as_py())[0]] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["feature", "n"])

    sizes = {r.lang: r.n for r in training.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.ones(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    df = np.zeros(FEATURES)
    for r in training.select("text").mapInArrow(frequencies, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        df[r.feature] = r.n  # FEATURES rows at most
    idf = np.log((1 + sum(sizes.values())) / (1 + df)) + 1

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lang, text in zip(*batch.columns, strict=True):
                found, counts = gram_counts(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()], pa.int64()), pa.array([lang.as_py()]), pa.array([found.astype("<i4").tobytes()]), pa.array([counts.astype("<i4").tobytes()])],
                    names=["key", "lang", "found", "counts"],
                )

    scale = 1 << 30
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(scale, per_language * scale // sizes[lang]))])
    key = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(scale))
    chosen = training.select(key.alias("key"), "lang", "text").where(F.col("key") < share[F.col("lang")])
    rows = chosen.mapInArrow(sampled, "key bigint, lang string, found binary, counts binary").collect()
    rows.sort(key=lambda r: (r.key * 0x9E3779B97F4A7C15 % 2**61, r.key, bytes(r.found)))
    number = {lang: i for i, lang in enumerate(languages)}
    vectors = []
    for r in rows:
        found = np.frombuffer(r.found, "<i4").astype(np.int64)
        vectors.append((number[r.lang], found, tf_idf(found, np.frombuffer(r.counts, "<i4"), idf)))
    aside = len(vectors) // 5
    weights, bias = fit_ftrl(vectors[aside:], len(languages))
    logits = np.array([v @ weights[f] + bias for _, f, v in vectors[:aside]]).reshape(aside, len(languages))
    return LanguageModel(languages, idf, weights, bias, fit_temperature(logits, np.array([c for c, _, _ in vectors[:aside]], dtype=np.int64)))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; see ``detect``."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), (fold(F.col(f"`{id_col}`")) == 0).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, letter = sent.value, regex.compile(LETTER)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2):
                text = text.as_py()
                if not model.languages or text is None or not letter.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                found, counts = gram_counts(text)
                p = softmax((tf_idf(found, counts, model.idf) @ model.weights[found] + model.bias) / model.temperature)
                langs.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def detect(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Language of every row, learned from the rows outside fold 0.

    ``und`` with score 0 for null texts, texts without a letter, and all texts if
    there is nothing to learn from. Rows with a null lang are predicted, not learned
    from; repeated rows count each time; ties go to the first language by name.
    """
    training = docs.where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    return predict(docs, fit(training, per_language))


def op8(spark, sf_dir: str) -> DataFrame:
    return detect(spark.read.parquet(f"{sf_dir}/documents.parquet"))
