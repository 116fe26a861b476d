"""Embedding near-dedup by PCA-ordered tiled comparison.

Unit vectors are rotated to their principal axes, which keeps every cosine, and dealt
into tiles by median cuts along the leading axes, each cut where a part is widest. Two
vectors of cosine c lie sqrt(2 - 2c) apart, so only tiles whose boxes in the leading
axes come that near are compared. Neighbouring tiles form groups, and a tile travels
once to each group that it meets, not once to each tile. A pair of tiles sums products
over the leading axes first; what the others can add is at most the product of the two
suffix norms, and pairs that cannot reach the threshold are dropped after each step.
The rest is decided by the full cosine in double precision. Equal vectors are one from
the start, and links are counted inside tile pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.near import local_roots
from keyflow.llm.store import connected_components, discard, written

THRESHOLD = 0.95
TILE_ROWS, BOX_AXES, STRIP_ROWS, GROUP_TILES = 4096, 8, 512, 8
MAX_DEPTH, SAMPLE_ROWS = 12, 1 << 16
STEPS, DENSE_SHARE, SLACK = (8, 16, 32), 0.05, 1e-9


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    return F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )


def candidates(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the rotated unit vectors a and b that may reach the threshold."""
    dims = a.shape[1]
    stops = [s for s in STEPS if s < dims] + [dims]
    tails = [[np.sqrt((x[:, s:] ** 2).sum(1)) for s in stops] for x in (a, b)]
    total, left, right, done = None, None, None, 0
    for stop, tail_a, tail_b in zip(stops, *tails, strict=True):
        need = threshold - SLACK
        if left is None:
            part = a[:, done:stop] @ b[:, done:stop].T
            total = part if total is None else total + part
            alive = total + tail_a[:, None] * tail_b[None, :] >= need
            if stop == dims or alive.mean() <= DENSE_SHARE:
                left, right = np.nonzero(alive)
                total = total[left, right]
        else:
            total = total + np.einsum("ij,ij->i", a[left, done:stop], b[right, done:stop])
            alive = total + tail_a[left] * tail_b[right] >= need
            left, right, total = left[alive], right[alive], total[alive]
        done = stop
    return left, right


class Tile:
    """Vectors of a tile with what every comparison needs: lengths and rotated units."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.x, self.length = x, np.linalg.norm(x, axis=1)
        self.unit = x / self.length[:, None] @ turn


def linked_pairs(a: Tile, b: Tile, threshold: float, same: bool):
    """Pairs (i, j) of rows of a and b with cosine >= threshold; i < j if ``same``."""
    lefts, rights = [], []
    for at in range(0, len(a.x), STRIP_ROWS):
        left, right = candidates(a.unit[at : at + STRIP_ROWS], b.unit, threshold)
        left = left + at
        if same:
            left, right = left[left < right], right[left < right]
        for s in range(0, len(left), 1 << 16):
            i, j = left[s : s + (1 << 16)], right[s : s + (1 << 16)]
            ok = np.einsum("ij,ij->i", a.x[i], b.x[j]) / (a.length[i] * b.length[j]) >= threshold
            lefts.append(i[ok])
            rights.append(j[ok])
    none = np.empty(0, np.int64)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (none, none)


def median_cuts(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and bound of each inner node of a binary tree in heap order: every part is
    cut at its median along the axis in which it is widest."""
    axis, bound = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: points}
    for node in range(len(axis)):
        own = parts.pop(node)
        if len(own):
            axis[node] = int(np.argmax(own.std(0)))
            bound[node] = float(np.median(own[:, axis[node]]))
        above = own[:, axis[node]] > bound[node] if len(own) else np.empty(0, bool)
        parts[2 * node + 1], parts[2 * node + 2] = own[~above], own[above]
    return axis, bound


def leaf_of(points: np.ndarray, axis: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Number of the leaf that each point falls into; neighbours have near numbers."""
    node = np.zeros(len(points), np.int64)
    for _ in range((len(axis) + 1).bit_length() - 1):
        node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] > bound[node])
    return node - len(axis)


def _matrix(column) -> np.ndarray:
    """Rows of a list column as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _links_of(classes: DataFrame, dims: int, rows: int, threshold: float, tile_rows: int) -> DataFrame:
    """``rep, links, root`` per tile pair, for the vectors of one dimension."""
    spark = classes.sparkSession

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["k", "v"])

    second = np.zeros(dims * dims)
    for r in classes.select("vector").mapInArrow(moments, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        second[r.k] = r.v  # dims squared numbers
    turn = np.linalg.eigh(second.reshape(dims, dims))[1][:, ::-1].copy()

    kind = dict(classes.dtypes)["vector"]
    axes = min(BOX_AXES, dims)

    def leads(x: np.ndarray) -> np.ndarray:
        return x / np.linalg.norm(x, axis=1, keepdims=True) @ turn[:, :axes] if len(x) else np.empty((0, axes))

    n_tiles = -(-rows // tile_rows)
    depth = min(MAX_DEPTH, (n_tiles - 1).bit_length())
    axis, bound = np.empty(0, np.int64), np.empty(0)
    if depth:
        # The cuts come from a hash sample of about SAMPLE_ROWS vectors, whatever their number.
        some = classes.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE_ROWS << 30) // rows)).select("rep", "vector").orderBy("rep")
        points = np.array([r.vector for r in some.collect()], dtype=np.float64)
        if len(points):
            axis, bound = median_cuts(leads(points), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf_of(leads(_matrix(batch.column(2))), axis, bound))], names=["rep", "copies", "vector", "leaf"])

    dealt = written(classes.select("rep", "copies", "vector").mapInArrow(deal, f"rep bigint, copies bigint, vector {kind}, leaf bigint"), "dealt")
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / tile_rows).alias("shares"))
    tiled = dealt.join(sizes, "leaf").withColumn("tile", F.shiftleft("leaf", 32) + F.pmod(F.xxhash64("rep"), F.col("shares")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(tile, reps, copies, parts):
            reps, copies, x = np.concatenate(reps), np.concatenate(copies), np.concatenate(parts)
            lead = leads(x)
            order = np.argsort(reps, kind="stable")
            narrow = x.astype(np.float32) if kind == "array<float>" else x
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([tile], pa.int64()), pa.array([reps[order].tobytes()], pa.binary()), pa.array([copies[order].tobytes()], pa.binary()),
                    pa.array([narrow[order].tobytes()], pa.binary()), pa.array([lead.min(0)], pa.list_(pa.float64())), pa.array([lead.max(0)], pa.list_(pa.float64())),
                ],
                names=["tile", "reps", "copies", "vectors", "low", "high"],
            )

        key, held = None, ([], [], [])
        for batch in batches:
            tiles = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(tiles)) + 1
            for s, e in zip([0, *edges], [*edges, len(tiles)], strict=True):
                if e == s:
                    continue
                if tiles[s] != key:
                    if key is not None:
                        yield row(key, *held)
                    key, held = int(tiles[s]), ([], [], [])
                part = batch.slice(int(s), int(e - s))
                for into, what in zip(held, (part.column(1).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3))), strict=True):
                    into.append(what)
        if key is not None:
            yield row(key, *held)

    tiles = written(
        tiled.select("tile", "rep", "copies", "vector").repartition("tile").sortWithinPartitions("tile")
        .mapInArrow(pack, "tile bigint, reps binary, copies binary, vectors binary, low array<double>, high array<double>"),
        "tiles", "none",
    )
    reach = 2 - 2 * threshold + SLACK
    width = float(np.sqrt(reach))
    boxes = tiles.select("tile", "low", "high")
    one = boxes.select(F.col("tile").alias("i"), F.col("low").alias("li"), F.col("high").alias("hi"), F.explode(F.sequence(F.floor(F.col("low")[0] / width) - 1, F.floor(F.col("high")[0] / width) + 1)).alias("band"))
    two = boxes.select(F.col("tile").alias("j"), F.col("low").alias("lj"), F.col("high").alias("hj"), F.explode(F.sequence(F.floor(F.col("low")[0] / width), F.floor(F.col("high")[0] / width))).alias("band"))
    gap = F.aggregate(
        F.zip_with(F.zip_with("li", "hj", lambda a, b: a - b), F.zip_with("lj", "hi", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))),
        F.lit(0.0), lambda acc, x: acc + x * x,
    )
    pairs = one.join(two, "band").where((F.col("i") <= F.col("j")) & (gap <= reach)).select("i", "j").distinct()
    # Tiles travel to pairs of groups. Groups are larger the more tiles there are, as long
    # as that leaves several pairs of groups for each of the session's shuffle partitions.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    size = max(1, min(GROUP_TILES, int(n_tiles / (2 * parts) ** 0.5)))
    leaves, shares = (size, 1) if n_tiles <= 1 << MAX_DEPTH else (1, size)
    group = lambda c: F.shiftleft(F.floor(F.shiftright(c, 32) / leaves).cast("bigint"), 32) + F.floor(c.bitwiseAND(F.lit((1 << 32) - 1)) / shares).cast("bigint")
    met = written(pairs.groupBy(group(F.col("i")).alias("gi"), group(F.col("j")).alias("gj")).agg(F.collect_list(F.struct("i", "j")).alias("pairs")), "pairs")
    wanted = met.select("gi", "gj", F.explode(F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["i"], p["j"]))))).alias("tile"))
    work = wanted.join(tiles.select("tile", "reps", "copies", "vectors"), "tile").unionByName(met.select("gi", "gj", F.lit(None).cast("bigint").alias("tile"), "pairs"), allowMissingColumns=True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.float32 if kind == "array<float>" else np.float64
        key, todo, held = None, [], {}

        def links_of(i: int, j: int) -> pa.RecordBatch | None:
            (reps, copies, a), (reps_b, copies_b, b) = held[i], held[j]
            left, right = linked_pairs(a, b, threshold, i == j)
            if not len(left):
                return None
            if i != j:
                right = right + len(reps)
                reps, copies = np.concatenate([reps, reps_b]), np.concatenate([copies, copies_b])
            links = np.bincount(left, copies[right], len(reps)) + np.bincount(right, copies[left], len(reps))
            place = np.argsort(np.argsort(reps, kind="stable"), kind="stable")
            ordered = np.sort(reps)
            roots = ordered[local_roots(len(reps), place[left], place[right])][place]
            some = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(links[some].astype(np.int64)), pa.array(roots[some])], names=["rep", "links", "root"])

        def done() -> Iterator[pa.RecordBatch]:
            for p in todo:
                if (found := links_of(p["i"], p["j"])) is not None:
                    yield found

        # Sorted, the row with a group pair's tile pairs comes before its tiles.
        for batch in batches:
            for gi, gj, tile, reps, copies, vectors, pairs in zip(*batch.columns, strict=True):
                if (own := (gi.as_py(), gj.as_py())) != key:
                    yield from done()
                    key, todo, held = own, [], {}
                if tile.as_py() is None:
                    todo = pairs.as_py()
                    continue
                x = np.frombuffer(vectors.as_py(), number).reshape(-1, dims).astype(np.float64)
                held[tile.as_py()] = (np.frombuffer(reps.as_py(), np.int64), np.frombuffer(copies.as_py(), np.int64), Tile(x, turn))
        yield from done()

    work = work.select("gi", "gj", "tile", "reps", "copies", "vectors", "pairs")
    tasks = max(parts, met.count())
    found = written(work.repartition(tasks, "gi", "gj").sortWithinPartitions("gi", "gj", "tile").mapInArrow(compare, "rep bigint, links bigint, root bigint"), "links")
    discard(dealt, tiles, met)
    return found


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    ``n_links`` counts the other rows with cosine >= ``threshold`` (> 0), copies
    included; ``component_id`` is the smallest id that links lead to. Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing, nor do
    vectors of different dimension or rows with a null id (component null, kept true).
    Repeated rows are other rows. Extra columns are ignored.
    """
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    rows = rows.withColumn("fit", usable(F.col("vector")) & F.col("id").isNotNull())
    classes = written(rows.where("fit").groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vectors")
    dims = classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()  # one row per dimension in use
    found = None
    for r in sorted(dims):
        part = _links_of(classes.where(F.size("vector") == r.d), r.d, r.n, threshold, tile_rows)
        found = part if found is None else found.union(part)
    if found is None:
        found = df.sparkSession.range(0).select(*[F.col("id").alias(c) for c in ("rep", "links", "root")])
    linked = found
    roots = connected_components(linked.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    about = classes.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("vector").alias("same"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "rep").alias("c")
    )
    fit = rows.where("fit").join(about, F.col("vector") == F.col("same")).select("id", "n", "c")
    alone = rows.where("NOT fit").select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("c"))
    return fit.unionByName(alone).select("id", F.col("n").cast("bigint").alias("n_links"), F.col("c").alias("component_id"), F.coalesce(F.col("id") == F.col("c"), F.lit(True)).alias("kept"))


def op1(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


ORACLE = r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (
  SELECT rid, vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.rid, a.vec_id AS i, b.vec_id AS j FROM n a JOIN n b ON a.rid <> b.rid
  AND CASE WHEN len(a.e) = len(b.e) THEN list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95 ELSE false END),
links AS (SELECT rid, count(*) AS n_links FROM pairs GROUP BY rid),
steps AS (SELECT DISTINCT i, j FROM pairs),
reach AS (SELECT i, j FROM steps UNION SELECT r.i, s.j FROM reach r JOIN steps s ON s.i = r.j),
roots AS (SELECT i, min(least(i, j)) AS root FROM reach GROUP BY i)
SELECT v.vec_id, coalesce(l.n_links, 0) AS n_links, coalesce(r.root, v.vec_id) AS component_id,
       coalesce(v.vec_id = coalesce(r.root, v.vec_id), true) AS kept
FROM v LEFT JOIN links l USING (rid) LEFT JOIN roots r ON r.i = v.vec_id
"""
