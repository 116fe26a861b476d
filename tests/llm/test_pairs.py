"""Near duplicates of texts and vectors, against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from keyflow.llm import near, vectors
from keyflow.llm.store import connected_components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def roots_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def shingle_set(text):
    w = WORDS.findall(text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("limit", [256, 3])
def test_jaccard_classes(spark, docs, limit):
    rows = [(r.doc_id, shingle_set(r.text), r.text) for r in docs.collect()]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][1] and rows[j][1] and len(rows[i][1] & rows[j][1]) >= 0.8 * len(rows[i][1] | rows[j][1])]
    links = Counter(x for p in pairs for x in p)
    roots = roots_of({r[0] for r in rows}, [(rows[i][0], rows[j][0]) for i, j in pairs])
    got = near.jaccard_classes(docs, limit=limit).collect()
    assert sorted((r.id, r.n_links, r.class_id) for r in got) == sorted((r[0], links[i], roots[r[0]]) for i, r in enumerate(rows))
    assert len(pairs) > 20


def test_first_of_class(spark, docs):
    kept = near.first_of_class(docs)
    found = {r.id: r.class_id for r in near.jaccard_classes(docs).collect()}
    want = Counter({i: 1 for i, c in found.items() if i == c})
    got = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns and set(got) == set(want) and all(n == 1 for n in got.values())


def test_null_ids_and_empty_tables(spark, no_docs):
    rows = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id bigint, text string")
    assert sorted((r.id or -1, r.n_links, r.class_id) for r in near.jaccard_classes(rows).collect()) == [(-1, 0, None), (1, 1, 1), (2, 1, 1)]
    assert near.first_of_class(rows).count() == 2
    assert near.jaccard_classes(no_docs).count() == 0 and near.first_of_class(no_docs).columns == no_docs.columns


def test_runs_meet_the_recall():
    n = near.runs_for(0.8, 0.9999)
    once = 0.8 * (1 - 0.2**near.BRANCHES) ** (near.LEVELS - 1)
    assert 1 - (1 - once) ** n >= 0.9999 > 1 - (1 - once) ** (n - 1)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 30)], "u bigint, v bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{i: 200 for i in range(200, 230)}}
    assert connected_components(edges.limit(0)).count() == 0


def test_leaves_bounded_in_bytes(docs, monkeypatch):
    """Nodes cut into blocks of a few hundred bytes, long texts included, find the same."""
    rows = lambda: sorted((str(r.id), r.n_copies, r.n_links, str(r.class_id)) for r in near.jaccard_classes(docs).collect())
    whole = rows()
    monkeypatch.setattr(near, "LEAF_BYTES", 400)
    assert rows() == whole


def test_sketches_keep_pairs_at_the_threshold():
    """The cut misses a pair at the threshold as seldom as it says, and parts others."""
    cut = near.sketch_cut(42, 0.8)
    below = lambda p: sum(math.comb(42, k) * p**k * (1 - p) ** (42 - k) for k in range(cut))
    assert below(0.8) <= near.SKETCH_MISS < below(0.8) + math.comb(42, cut) * 0.8**cut * 0.2 ** (42 - cut) and below(0.2) > 0.99
    rng = np.random.default_rng(2)
    one = rng.integers(0, 128, 42)
    near_one, far = np.where(np.arange(42) < 42 - cut, rng.integers(0, 128, 42), one), rng.integers(0, 128, 42)
    some = np.array([one, far, near_one], dtype=np.int8)
    assert near.maybe_linked(some, np.array([0, 0, 1]), False, cut).tolist() == [True, False, True]
    assert near.maybe_linked(some, np.array([0, 0, 0]), True, cut).tolist() == [False] * 3


@pytest.mark.parametrize("tile_rows", [4096, 16])
def test_near_vectors(spark, tile_rows):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 12))
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[i % 9] + rng.normal(size=12) * 0.15) for i in range(60)]
    rows += [(200 + i, base[3]) for i in range(20)] + [(300, base[4] * 7), (301, -base[4])]
    data = [(int(i), [float(np.float32(x)) for x in v], "extra") for i, v in rows]
    odd = [(400, None), (401, []), (402, [0.0] * 12), (403, [float("nan")] + [1.0] * 11), (404, [float("inf")] + [1.0] * 11), (405, [None] + [1.0] * 11), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (None, data[0][1]), (0, data[0][1])]
    table = spark.createDataFrame([*data, *[(i, v, "x") for i, v in odd]], "vec_id bigint, embedding array<float>, rep string")
    usable = [(k, i, np.array(v, dtype=np.float64)) for k, (i, v) in enumerate([(i, v) for i, v, _ in data] + odd) if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    pairs = [(a, b) for n, a in enumerate(usable) for b in usable[:n] if len(a[2]) == len(b[2]) and a[2] @ b[2] / (np.linalg.norm(a[2]) * np.linalg.norm(b[2])) >= 0.95]
    links = Counter(x[0] for p in pairs for x in p)
    ids = {i for i, _, _ in data} | {i for i, _ in odd if i is not None}
    roots = roots_of(ids, [(a[1], b[1]) for a, b in pairs])
    want = sorted((i if i is not None else -1, links[k], roots.get(i)) for k, (i, _) in enumerate([(i, v) for i, v, _ in data] + odd))
    got = vectors.near_vectors(table, tile_rows=tile_rows).collect()
    assert sorted((r.id if r.id is not None else -1, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.id is None or r.id == r.component_id) for r in got) and len(pairs) > 300
    assert vectors.near_vectors(table.limit(0)).count() == 0
    assert vectors.near_vectors(table.where("vec_id > 399")).count() == 8


def test_candidates_lose_nothing():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 40))
    x = np.vstack([x, x[:30] + rng.normal(size=(30, 40)) * 0.1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    left, right = vectors.candidates(x, x, 0.9)
    assert set(zip(*np.nonzero(x @ x.T >= 0.9), strict=True)) <= set(zip(left, right, strict=True))
