"""The pipeline: stages chained over written tables, each held against brute force."""

import hashlib
import inspect
import re
from collections import Counter

from keyflow.llm import bpe, quality
from keyflow.llm.store import shared_dir

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "substring_dedup", "source_mixing", "bpe_codec"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{shared_dir(spark)}/test-{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        assert name == "bpe_codec" or docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] == sizes[5] > 0
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "ids_sha256").collect()))
    assert rows(corpus_pipeline.run(spark, SF)) == rows(docs)


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_by_brute_force(spark):
    """What each stage keeps of its own input, recomputed in plain Python."""
    import tokenizers

    read = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: r[0])
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def step(name, given):
        path = f"{shared_dir(spark)}/brute-{name}"
        stages[name](spark, given, SF).write.parquet(path)
        return spark.read.parquet(path)

    good = step("quality_classifier", docs)
    scored = {r.doc_id for r in quality.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert read(good) == [r for r in read(docs) if r[0] in scored]

    # One document of each group that links of similarity 0.8 hold together.
    single, rows = step("jaccard_join", good), read(good)
    sets = {}
    for i, t in rows:
        w = WORDS.findall(t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                root[max(top(a), top(b))] = min(top(a), top(b))
    assert read(single) == [r for r in rows if top(r[0]) == r[0]]

    # Words that no window of 13 covers which an earlier document has.
    cut, rows = step("substring_dedup", single), read(single)
    first, want = {}, {}
    lists = {i: WORDS.findall(t or "") for i, t in rows}
    for i, w in lists.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, w in lists.items():
        gone = {k + d for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for d in range(13)}
        want[i] = [x for k, x in enumerate(w) if k not in gone]
    assert {i: WORDS.findall(t or "") for i, t in read(cut)} == {i: w for i, w in want.items() if w or not lists[i]}

    # Copies: at most two of a document, none of its text changed.
    mixed, texts = step("source_mixing", cut), dict(read(cut))
    taken = Counter(i for i, _ in read(mixed))
    assert max(taken.values()) <= 2 and all(texts[i] == t for i, t in read(mixed))

    # The library's ids of each copy.
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in step("bpe_codec", mixed).collect())
    assert got == sorted((i, digest(",".join(map(str, library.encode(t or "", add_special_tokens=False).ids))), digest(t or "")) for i, t in read(mixed))
