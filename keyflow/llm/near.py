"""N-gram Jaccard join by chosen paths.

Texts are sets of ``width``-word shingles. In each run, a text goes to the node of one
minimum-hash token of its set (a token that it shares with a text of similarity s with
probability s). Nodes of more than ``limit`` texts are split again: each text goes on
to one child for each of ``BRANCHES`` further sampled tokens, so that similar texts
keep meeting while others part. A node of which half or more stay together in a child,
and any that is still large at the last level, is compared in blocks, bounded in texts
and in bytes. Small nodes are compared by brute force, in two steps: minimum-hash
sketches of a few bytes first, which tell the texts that may have a partner in their
node, then the shingles themselves of those texts alone. The number of runs follows from
the target recall at the threshold. Equal texts are one set from the start, and a pair
counts only in the smallest of its common nodes, so links are counted without listing
pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.store import connected_components, discard, written
from keyflow.llm.words import gram_hashes, many_word_hashes, stream

WIDTH, THRESHOLD, RECALL = 5, 0.8, 0.9999
BRANCHES, LEVELS, LIMIT, ALIKE = 3, 3, 256, 0.5
LEAF_BYTES, SKETCH_MISS = 4 << 20, 1e-7
CHUNK_BYTES, CHUNK_COLUMNS = 2 << 20, 4096


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``,
    even if its nodes are split at every level."""
    kept = 1 - (1 - threshold) ** BRANCHES
    once = threshold * kept ** (LEVELS - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - once))


def coordinates(runs: int) -> int:
    return runs * (1 + BRANCHES * (LEVELS - 1))


def coordinate(run, level: int, branch: int, runs: int):
    """Signature position that ``run`` uses at a level (0: first) and branch."""
    return run if level == 0 else runs + (run * (LEVELS - 1) + level - 1) * BRANCHES + branch


def sketch_cut(size: int, threshold: float, miss: float = SKETCH_MISS) -> int:
    """Equal coordinates of ``size`` that a pair at the threshold has, but for ``miss``."""
    below, cut = 0.0, 0
    while cut < size:
        below += math.comb(size, cut) * threshold**cut * (1 - threshold) ** (size - cut)
        if below > miss:
            break
        cut += 1
    return cut


def maybe_linked(sketches: np.ndarray, sides: np.ndarray, across: bool, cut: int) -> np.ndarray:
    """Which rows of (texts, size) sketches agree with another in ``cut`` places or more,
    of the other side if ``across``."""
    agree = np.zeros((len(sketches), len(sketches)), dtype=np.int16)
    for column in sketches.T:
        agree += column[:, None] == column[None, :]
    near = agree >= cut
    np.fill_diagonal(near, False)
    if across:
        near &= sides[:, None] != sides[None, :]
    return near.any(1)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of a text's shingles; a text of fewer words is one shingle."""
    return gram_hashes(words, min(width, len(words))) if len(words) else np.empty(0, np.uint64)


def signatures(texts: list[bytes], width: int, size: int) -> np.ndarray:
    """(texts, size) minimum of each of ``size`` hash orders; texts have words."""
    words, bounds = many_word_hashes(texts)
    sets = [shingles(words[a:b], width) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    turns, factors = stream(size, 21), stream(size, 22)
    return np.stack([np.minimum.reduceat((every ^ t) * f, starts) for t, f in zip(turns, factors, strict=True)], 1)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of 0..n-1 by the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, over the tokens that two sets or more hold."""
    g = len(sets)
    owner = np.repeat(np.arange(g), [len(s) for s in sets])
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    use = counts[inverse] > 1
    rows, columns = owner[use], shared[inverse[use]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    out = np.zeros((g, g), dtype=np.float32)
    last = int(columns[-1]) + 1 if len(columns) else 0
    for at in range(0, last, CHUNK_COLUMNS):
        a, b = np.searchsorted(columns, [at, at + CHUNK_COLUMNS])
        part = np.zeros((g, min(CHUNK_COLUMNS, last - at)), dtype=np.float32)
        part[rows[a:b], columns[a:b] - at] = 1
        out += part @ part.T
    return out


def compare_leaf(reps, copies, sides, homes, texts, node: int, low: int, high: int, width: int, threshold: float):
    """Links of one leaf: (rep, links, root) for each text with any.

    ``sides`` is each text's block in the node, ``homes`` the nodes that it is in.
    """
    order = np.argsort(reps, kind="stable")
    reps, copies, sides = reps[order], copies[order], sides[order]
    homes, texts = [homes[i] for i in order], [texts[i] for i in order]
    words, bounds = many_word_hashes(texts)
    sets = [np.unique(shingles(words[a:b], width)) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    both = overlaps(sets).astype(np.float64)
    left, right = np.nonzero(np.triu(both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9, 1))
    if low != high:
        cross = sides[left] != sides[right]
        left, right = left[cross], right[cross]
    if len(left):
        ids, inverse = np.unique(np.concatenate(homes), return_inverse=True)
        member = np.zeros((len(reps), len(ids)), dtype=bool)
        member[np.repeat(np.arange(len(reps)), [len(h) for h in homes]), inverse] = True
        own = int(np.searchsorted(ids, node))
        if own:  # ids are sorted: a common node before this one is the pair's home
            earlier = member[:, :own].astype(np.float32)
            first = (earlier @ earlier.T)[left, right] == 0
            left, right = left[first], right[first]
    if not len(left):
        return None
    links = np.bincount(left, copies[right], len(reps)) + np.bincount(right, copies[left], len(reps))
    roots = local_roots(len(reps), left, right)
    some = np.flatnonzero(links)
    return reps[some], links[some].astype(np.int64), reps[roots[some]]


def jaccard_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: ``id, h, n_copies, n_links, class_id`` (h: the text's md5).

    ``n_copies``: rows with exactly this text, ``n_links``: other rows whose text has
    similarity of at least ``threshold`` to this one, copies included; ``class_id``: the
    smallest id that links lead to. Texts without words (null, empty, white space) link
    with nothing, nor do rows with a null id, whose class is null. Repeated rows are
    copies. A text of fewer than ``width`` words is one shingle. Extra columns are ignored.
    """
    runs = runs_for(threshold, recall)
    size = coordinates(runs)
    base = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    base = base.withColumn("h", F.unhex(F.md5(F.col("text").cast("binary"))))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(2)]
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held < CHUNK_BYTES):
                    held += len(texts[end])
                    end += 1
                some = [i for i in range(at, end) if texts[i].split(None, 1)]
                lists = [None] * (end - at)
                if some:
                    for i, row in zip(some, signatures([texts[i] for i in some], width, size).view(np.int64), strict=True):
                        lists[i - at] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at), pa.array(lists, pa.list_(pa.int64())),
                        pa.array([len(t) for t in texts[at:end]], pa.int64()),
                    ],
                    names=["id", "h", "sig", "bytes"],
                )
                at = end

    signed = written(base.select("id", "h", "text").mapInArrow(sign, "id bigint, h binary, sig array<bigint>, bytes bigint"), "signatures", "none")
    able = signed.where("id IS NOT NULL AND sig IS NOT NULL")
    classes = written(able.groupBy("h").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"), F.max("bytes").alias("bytes")), "classes", "none")

    member = ("rep", "h", "copies", "bytes")
    used, nodes = [], classes.select(
        *member,
        F.posexplode(F.transform(F.slice("sig", 1, runs), lambda v, i: F.xxhash64(i, v))).alias("run", "node"),
    )
    leaves = None
    for level in range(1, LEVELS + 1):
        sizes = nodes.groupBy("node").agg(F.count("*").alias("members"), F.sum("bytes").alias("held")).where("members > 1")
        nodes = written(nodes.join(sizes, "node"), "nodes")
        used.append(nodes)
        done = nodes if level == LEVELS else nodes.where(F.col("members") <= limit)
        leaves = done if leaves is None else leaves.unionByName(done)
        if level == LEVELS:
            break
        steps = F.array(*[F.lit(b) for b in range(BRANCHES)])
        place = coordinate(F.col("run"), level, F.col("branch"), runs)
        large = nodes.where(F.col("members") > limit)
        children = written(
            large.select(*member, "run", F.col("node").alias("parent"), F.col("members").alias("of"))
            .join(classes.select("rep", "h", "sig"), ["rep", "h"])
            .withColumn("branch", F.explode(steps))
            .select(*member, "run", "parent", "of", F.xxhash64("parent", "branch", F.element_at("sig", (place + 1).cast("int"))).alias("node")),
            "children",
        )
        used.append(children)
        # Texts that stay together are alike: their node is compared as it is.
        kept = children.groupBy("parent", "of", "node").agg(F.count("*").alias("n")).groupBy("parent", "of").agg(F.max("n").alias("n"))
        alike = kept.where(F.col("n") >= ALIKE * F.col("of")).select("parent")
        leaves = leaves.unionByName(large.join(alike.withColumnRenamed("parent", "node"), "node", "left_semi"))
        nodes = children.join(alike, "parent", "left_anti").select(*member, "run", "node")

    blocks = F.greatest(F.ceil(F.col("members") / limit), F.ceil(F.col("held") / LEAF_BYTES)).cast("int")
    side = F.when(blocks > 1, F.pmod(F.xxhash64("rep", "h", "node"), blocks)).otherwise(0).cast("int")
    places = leaves.groupBy("rep", "h", "copies").agg(F.collect_list(F.struct("node", blocks.alias("blocks"), side.alias("side"))).alias("places"))
    leaf = F.xxhash64("node", "low", "high").alias("leaf")
    spread = (
        places.join(classes.select("rep", "h", F.transform("sig", lambda v: v.bitwiseAND(F.lit(127).cast("bigint")).cast("tinyint")).alias("sketch")), ["rep", "h"])
        .withColumn("homes", F.array_sort(F.transform("places", lambda p: p["node"])))
        .select("rep", "h", "copies", "homes", "sketch", F.explode("places").alias("p"))
        .select("rep", "h", "copies", "homes", "sketch", "p.*")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
        .select(leaf, "node", "low", "high", "side", "rep", "h", "copies", "homes", "sketch")
    )
    cut = sketch_cut(size, threshold)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen(rows: pa.Table) -> pa.RecordBatch | None:
            if rows.num_rows < 2:
                return None
            rows = rows.combine_chunks()
            sketches = rows.column(9).chunk(0).flatten().to_numpy().reshape(rows.num_rows, size)
            across = rows.column(2)[0].as_py() != rows.column(3)[0].as_py()
            some = np.flatnonzero(maybe_linked(sketches, rows.column(4).to_numpy(), across, cut))
            return rows.select(list(range(1, 9))).take(some) if len(some) else None

        def out(found):
            return pa.concat_tables(found).combine_chunks().to_batches()

        key, held, found = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = np.stack([batch.column(i).to_numpy() for i in range(4)])
            edges = np.flatnonzero((numbers[:, 1:] != numbers[:, :-1]).any(0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                own = tuple(numbers[:, a].tolist())
                if own != key:
                    if held and (r := chosen(pa.Table.from_batches(held))) is not None:
                        found.append(r)
                    key, held = own, []
                    if len(found) >= 500:
                        yield from out(found)
                        found = []
                held.append(batch.slice(a, b - a))
        if held and (r := chosen(pa.Table.from_batches(held))) is not None:
            found.append(r)
        if found:
            yield from out(found)

    at = "node bigint, low int, high int, side int, rep bigint, h binary, copies bigint, homes array<bigint>"
    hits = spread.repartition("leaf").sortWithinPartitions("leaf", "node", "low", "high").mapInArrow(sketched, at)
    # Texts travel to the leaves where the sketches leave them a partner, and only there.
    wanted = hits.groupBy("rep", "h", "copies", "homes").agg(F.collect_list(F.struct("node", "low", "high", "side")).alias("places"))
    wanted = written(wanted, "wanted")
    used.append(wanted)
    spread = (
        base.select(F.col("id").alias("rep"), "h", "text").join(wanted, ["rep", "h"])
        .select("rep", "copies", "homes", "text", F.explode("places").alias("p")).select("rep", "copies", "homes", "text", "p.*")
        .select(leaf, "node", "low", "high", "side", "rep", "copies", "homes", "text")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(key, rows):
            rows = list({r[1]: r for r in rows}.values())  # repeated rows of one text
            if len(rows) < 2:
                return None
            return compare_leaf(
                np.array([r[1] for r in rows]), np.array([r[2] for r in rows], dtype=np.float64), np.array([r[0] for r in rows]),
                [np.array(r[3], dtype=np.int64) for r in rows], [r[4] for r in rows], *key, width, threshold,
            )

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["rep", "links", "root"])

        key, rows, found = None, [], []
        for batch in batches:
            columns = [batch.column(i) for i in range(1, 9)]
            fixed = [c.to_pylist() for c in columns[:7]]
            for i, text in enumerate(columns[7]):
                own = (fixed[0][i], fixed[1][i], fixed[2][i])
                if own != key:
                    if (r := result(key, rows) if rows else None) is not None:
                        found.append(r)
                    key, rows = own, []
                    if len(found) >= 500:
                        yield out(found)
                        found = []
                rows.append((fixed[3][i], fixed[4][i], fixed[5][i], fixed[6][i], text.as_py().encode()))
        if (r := result(key, rows) if rows else None) is not None:
            found.append(r)
        if found:
            yield out(found)

    grouped = spread.repartition("leaf").sortWithinPartitions("leaf", "node", "low", "high")
    linked = written(grouped.mapInArrow(compare, "rep bigint, links bigint, root bigint"), "links")
    discard(*used)
    roots = connected_components(linked.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    about = (
        classes.select("h", "rep", "copies").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("h", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("class_id"))
    )
    alone = F.col("id").isNull() | F.col("sig").isNull()
    none = signed.where(alone).select("id", "h", F.lit(1).cast("bigint").alias("n_copies"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("class_id"))
    found = signed.where(~alone).select("id", "h").join(about, "h").select("id", "h", F.col("copies").cast("bigint").alias("n_copies"), F.col("n_links").cast("bigint").alias("n_links"), "class_id")
    return found.unionByName(none)


def first_of_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the one with the smallest id.

    Rows without words or id stay; of rows equal in id and text, one stays.
    """
    found = written(jaccard_classes(docs, **options).where("id IS NOT NULL").select(F.col("id").alias("__id"), F.col("h").alias("__h"), "class_id", "n_copies"), "classes")
    drop = found.where("class_id != __id").select("__id", "__h").distinct()
    same = (F.col("doc_id") == F.col("__id")) & (F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))) == F.col("__h"))
    kept = docs.join(drop, same, "left_anti")
    again = found.where("class_id = __id AND n_copies > 1").groupBy("__id", "__h").count().where("count > 1").select("__id", "__h")
    if again.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    single = kept.join(again, same).groupBy("__id", "__h").agg(F.min(row).alias("__row")).select("__row.*")
    return kept.join(again, same, "left_anti").unionByName(single)


def op4(spark, sf_dir: str) -> DataFrame:
    found = jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "n_copies", "n_links", "class_id", (F.col("id") == F.col("class_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT rid, doc_id, unnest(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(1, len(w) - 4) + 1)])) AS s
  FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
common AS (SELECT a.rid, b.rid AS other, a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL),
pairs AS (SELECT c.rid, i, j FROM common c JOIN sizes x ON x.rid = c.rid JOIN sizes y ON y.rid = c.other WHERE 5 * c >= 4 * (x.n + y.n - c)),
links AS (SELECT rid, count(*) AS n_links FROM pairs GROUP BY rid),
copies AS (SELECT text, count(*) AS n_copies FROM d WHERE len(w) > 0 AND doc_id IS NOT NULL GROUP BY text),
steps AS (SELECT DISTINCT i, j FROM pairs),
reach AS (SELECT i, j FROM steps UNION SELECT r.i, s.j FROM reach r JOIN steps s ON s.i = r.j),
roots AS (SELECT i, min(least(i, j)) AS root FROM reach GROUP BY i)
SELECT d.doc_id, CASE WHEN d.doc_id IS NULL THEN 1 ELSE coalesce(k.n_copies, 1) END AS n_copies, coalesce(l.n_links, 0) AS n_links,
       coalesce(r.root, d.doc_id) AS class_id, d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM d LEFT JOIN links l USING (rid) LEFT JOIN copies k ON k.text = d.text LEFT JOIN roots r ON r.i = d.doc_id
"""
