"""Quality classifier: a sparse rule ensemble, applied as Spark column expressions.

Statistics of a text are column expressions. Shallow boosted trees, grown on the
statistics of a bounded sample of labelled documents, give rules: the path to each
node is a conjunction of comparisons. A lasso logistic regression over the rules
keeps a few of them; these become columns, so scoring a corpus runs no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.langid import fold
from keyflow.llm.words import WORD_PATTERN

SAMPLE_ROWS, THRESHOLD = 12_000, 0.3
TREES, DEPTH, BINS, LEAF_ROWS, SHRINK = 40, 3, 32, 10, 0.3
LASSO, STEPS = 5e-4, 600


@dataclass
class RuleModel:
    """``rules``: conjunctions of (statistic, is_above, bound), with their weights."""

    rules: list[tuple[tuple[str, bool, float], ...]]
    weights: list[float]
    bias: float


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, in two layers: counts, then shares of them. None is null,
    whatever the text (a null one is empty)."""
    text = F.coalesce(text, F.lit(""))
    words = F.col("words")
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: a == b)
    lines = F.split(text, "\n")
    return {
        "words": F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1)),
        "chars": F.length(text).cast("double"),
        "upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("double"),
        "digits": F.regexp_count(text, F.lit(r"\p{Nd}")).cast("double"),
        "stops": F.regexp_count(text, F.lit(r"[.?!](?=\s|$)")).cast("double"),
        "symbols": F.regexp_count(text, F.lit(r"[#$%&*@^~<>{}\[\]|\\]")).cast("double"),
        "marks": F.regexp_count(text, F.lit(r"!")).cast("double"),
        "lines": F.size(lines).cast("double"),
        "own_lines": F.size(F.array_distinct(lines)).cast("double"),
    } | {"#n": F.size(words).cast("double"), "#own": F.size(F.array_distinct(words)).cast("double"), "#twice": F.size(F.filter(pairs, lambda x: x)).cast("double")}


SHARES = {
    "word_length": ("chars", "n"), "upper_share": ("upper", "chars"), "digit_share": ("digits", "chars"), "stop_share": ("stops", "n"),
    "symbol_share": ("symbols", "n"), "mark_share": ("marks", "n"), "own_share": ("own", "n"), "twice_share": ("twice", "n"),
    "line_words": ("n", "lines"), "own_line_share": ("own_lines", "lines"),
}
FEATURES = ["chars", "n", *SHARES]


def with_statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns as they are and a struct ``__stats`` of ``FEATURES``.

    The struct goes through a generator, so no later filter is moved below it and
    evaluated together with another copy of its expressions.
    """
    layers = statistics(F.col("__text"))
    first = {k: c for k, c in layers.items() if k[0] != "#"}
    second = {k[1:]: c for k, c in layers.items() if k[0] == "#"}
    df = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__kept"), F.col(f"`{text_col}`").alias("__text"))
    df = df.select("__kept", *[c.alias(k) for k, c in first.items()])
    df = df.select("__kept", *[k for k in first if k != "words"], *[c.alias(k) for k, c in second.items()])
    stats = F.struct("chars", "n", *[(F.col(a) / F.greatest(F.col(b), F.lit(1.0))).alias(k) for k, (a, b) in SHARES.items()])
    return df.select("__kept", F.explode(F.array(stats)).alias("__stats"))


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> list[tuple]:
    """Paths of boosted regression trees on logistic residuals, without repeats."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    score, rules = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}

    def split(rows, gradient, features):
        best = (1e-9, None, None)
        total, n = gradient[rows].sum(), len(rows)
        for j in features:
            sums = np.bincount(codes[rows, j], weights=gradient[rows], minlength=len(edges[j]) + 1).cumsum()[:-1]
            counts = np.bincount(codes[rows, j], minlength=len(edges[j]) + 1).cumsum()[:-1]
            ok = (counts >= LEAF_ROWS) & (n - counts >= LEAF_ROWS)
            if ok.any():
                gain = np.where(ok, sums**2 / np.maximum(counts, 1) + (total - sums) ** 2 / np.maximum(n - counts, 1) - total**2 / n, -1)
                if gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
        return best[1:]

    def grow(rows, gradient, hess, path, left):
        features = rng.choice(x.shape[1], max(2, x.shape[1] * 2 // 3), replace=False)
        j, cut = split(rows, gradient, features) if left and len(rows) >= 2 * LEAF_ROWS else (None, None)
        if j is None:
            score[rows] += SHRINK * gradient[rows].sum() / (hess[rows].sum() + 1.0)
            return
        for above in (False, True):
            own = rows[(codes[rows, j] > cut) == above]
            deeper = (*path, (j, above, float(edges[j][cut])))
            rules[tuple(sorted(deeper))] = None
            grow(own, gradient, hess, deeper, left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grow(np.arange(len(y)), y - p, p * (1 - p), (), depth)
    return list(rules)


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for j, above, bound in rule:
        out &= (x[:, j] > bound) == above
    return out


def fit_lasso(r: np.ndarray, y: np.ndarray, lasso: float = LASSO, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient steps."""
    n = len(y)
    full = np.hstack([r, np.ones((n, 1))]).astype(np.float64)
    v = np.ones(full.shape[1])
    for _ in range(20):  # largest eigenvalue, for the step
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * np.linalg.norm(full @ v) ** 2 / n * 1.05 + 1e-12)
    w = np.zeros(full.shape[1])
    w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    look, momentum = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(full @ look)))
        new = look - step * (full.T @ (p - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * lasso, 0)
        ahead = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, w, momentum = new + (momentum - 1) / ahead * (new - w), new, ahead
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Model from a hash sample of about ``sample_rows`` labelled documents outside
    fold 0. With no labels the score is 0.5, with one class only nearly that class."""
    marked = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0)).select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y"))
    n = marked.count()
    if not n:
        return RuleModel([], [], 0.0)
    scale = 1 << 30
    sample = marked.where(F.pmod(F.xxhash64(F.lit("quality"), "__id"), F.lit(scale)) < min(scale, sample_rows * scale // n)).distinct()
    # About sample_rows rows at most, a label of an id once however often it is repeated.
    joined = docs.select(F.col("doc_id").alias("__id"), "text").join(F.broadcast(sample), "__id")
    rows = with_statistics(joined, keep=("__id", "__y")).select("__kept.*", "__stats.*").orderBy("__id", *FEATURES).collect()
    if not rows:
        return RuleModel([], [], 0.0)
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    y = np.array([float(r["__y"] == 1) for r in rows])
    rules = grow_rules(x, y)
    if not rules:
        return RuleModel([], [], float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))))
    weights, bias = fit_lasso(np.stack([holds(r, x) for r in rules], 1), y)
    used = np.flatnonzero(np.abs(weights) > 1e-4).tolist()
    return RuleModel([tuple((FEATURES[j], above, bound) for j, above, bound in rules[i]) for i in used], [float(weights[i]) for i in used], bias)


def compiled(model: RuleModel, stats: str = "__stats") -> Column:
    """The model as one column: probability of label 1."""
    total = F.lit(model.bias)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        every = F.lit(True)
        for name, above, bound in rule:
            column = F.col(f"{stats}.{name}")
            every = every & (column > bound if above else column <= bound)
        total = total + F.when(every, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``held_out``, ``score`` and ``predicted`` for every row.

    Null and empty texts are scored like any other (all statistics 0). Repeated rows
    count each time, repeated labels once; a label without a document has no effect. Extra
    columns are ignored.
    """
    model = fit(docs, labels, sample_rows)
    scored = with_statistics(docs, keep=keep).select("__kept", compiled(model).alias("__score"))
    return scored.select(
        "__kept.*", (fold(F.col("__kept.doc_id")) == 0).alias("held_out"),
        F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, as they are, that the classifier does not reject."""
    model = fit(docs, labels, sample_rows)
    scored = with_statistics(docs, keep=tuple(docs.columns)).where(compiled(model) >= THRESHOLD)
    return scored.select("__kept.*")


def op9(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
