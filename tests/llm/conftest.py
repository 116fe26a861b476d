import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rep bigint, class_id string, size int, key string, __text string"


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randint(0, vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, junk, nulls, empties, one very
    long text and repeated rows."""
    rnd = random.Random(5)
    texts = [words(rnd, rnd.randint(1, 80)) for _ in range(60)]
    passage = words(rnd, 30, 10**6)
    for _ in range(8):
        parts = rnd.choice(texts).split()
        parts[rnd.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [rnd.choice(texts) for _ in range(6)] + [f"{words(rnd, 9)}\n{passage}\t {words(rnd, 7)}" for _ in range(5)]
    texts += ["one two", "one two", "é\x0bü  ", " \n ", "", None, None, "same " * 40, "same " * 41, words(rnd, 3000, 900), "a" * 5000, "<|endoftext|> \\0<|x|> 中文"]
    long = words(rnd, 200, 10**6).split()
    texts += [" ".join([*long[:i], "x", *long[i:]]) for i in (0, 50, 120, 199)]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """With extra columns whose names operators might use, and repeated rows."""
    rows = [(i, t, "en" if i % 2 else "fr", None if i % 7 == 0 else f"s{i % 4}", None if t is None else len(t), i, "x", 1, "k", "y") for i, t in corpus]
    return spark.createDataFrame([*rows, rows[0], rows[3]], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
