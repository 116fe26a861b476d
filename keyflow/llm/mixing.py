"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. Within its source, keys are cut into equal
ranges of about ``rows_per_bucket`` documents; bucket sums and their running totals
per source, joined back, turn each bucket's own running sum into the source's
prefix sum. So no task sorts a whole source, however large one source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.store import written
from keyflow.llm.words import WORD_PATTERN

ROWS_PER_BUCKET = 4096
KEY_BITS, RANGE_BITS = 60, 31


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def random_key(ident: Column, seed: str) -> Column:
    """60 bits of md5: the same on every run and in any SQL engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share_percent: int, max_repeats: int) -> DataFrame:
    """One row per source: ``source, source_rank, source_size, source_rows, target``.

    ``sizes`` has ``source, source_size, source_rows``, one row per source. Sources
    in code-point order, null last, weigh ``weights`` in turn. The total of
    ``share_percent`` of all sizes is shared by weight; a target stops at
    ``max_repeats`` times its source's size and the excess goes to the others. Taking
    sources by the size they have per unit of weight, the first one that its share
    does not exceed fixes the share per unit of weight for itself and all after it.
    Integer arithmetic up to one last division.
    """
    everyone = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source_rank"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(int(x)).cast("bigint") for x in weights]), (F.pmod(F.col("source_rank"), F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * max_repeats
    ranked = sizes.withColumn("source_rank", F.row_number().over(by_name).cast("bigint") - 1).withColumn("w", weight)
    open_rows = (
        ranked.withColumn("total", F.sum("source_size").over(everyone))
        .withColumn("capped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(onward))
        .withColumn("pos", F.row_number().over(by_room))
        .withColumn("num", F.col("total") * share_percent - F.col("capped") * 100)
        .withColumn("den", F.col("w_left") * 100)
    )
    fits = F.col("num") * F.col("w") <= cap * F.col("den")
    cut = F.min(F.when(fits, F.struct("pos", "num", "den"))).over(everyone)
    return open_rows.withColumn("cut", cut).select(
        "source", "source_rank", "source_size", "source_rows",
        F.when(F.col("cut").isNull() | (F.col("pos") < F.col("cut.pos")), cap.cast("double"))
        .otherwise((F.col("w") * F.col("cut.num")).cast("double") / F.col("cut.den").cast("double")).alias("target"),
    )


def mixture(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = (5, 2, 1),
    share_percent: int = 150,
    max_repeats: int = 2,
    whole: bool = False,
    seed: str = "mix",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Plan of the mix: one row per input row.

    Returns ``id, source, key, size, source_size, target, epochs, part, taken``. Every
    document is taken ``epochs`` times in full; documents in
    key order are then taken once more until the source's budget (its rounded target)
    is met. ``part`` is what that last pass takes: the whole size, 0, or, for the one
    document at the cut, the words still missing. With ``whole`` that document is
    taken whole if at least half of it fits and left out otherwise.

    ``size`` defaults to the number of words of ``text``. Null sizes and texts count 0,
    a null source is a source of its own, null ids share one key. Rows equal in id and
    size are interchangeable. No rows give no rows.
    """
    size = word_count(F.col("text")) if size is None else F.coalesce(size.cast("bigint"), F.lit(0))
    base = written(
        df.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
            random_key(F.col(id_col), seed).alias("key"),
        ),
        "sizes",
    )
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    targets = written(source_targets(sizes, weights, share_percent, max_repeats), "targets")
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(max_repeats), F.expr("budget div source_size"))).otherwise(0)
    plan = (
        targets.withColumn("budget", budget).withColumn("epochs", epochs.cast("bigint"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .withColumn("buckets", F.ceil(F.col("source_rows") / rows_per_bucket).cast("bigint"))
        .withColumnRenamed("source", "target_source")
    )
    rows = base.join(plan, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source").withColumn(
        "bucket", F.shiftright(F.shiftright(F.col("key"), KEY_BITS - RANGE_BITS) * F.col("buckets"), RANGE_BITS)
    )
    sums = rows.groupBy("source_rank", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source_rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_rank", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    running = Window.partitionBy("source_rank", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = F.col("rest") - (F.col("offset") + F.col("upto") - F.col("size"))
    part = F.when((room > 0) & (room * 2 >= F.col("size")), F.col("size")).otherwise(0) if whole else F.greatest(F.lit(0), F.least(F.col("size"), room))
    return (
        rows.withColumn("upto", F.sum("size").over(running)).join(offsets, ["source_rank", "bucket"])
        .withColumn("part", part.cast("bigint"))
        .select("id", "source", "key", "size", "source_size", "target", "epochs", "part", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it whole.

    Same columns as ``docs``. What the plan says of a row follows from its source's
    full passes and the key at which the last pass ends, so that the texts need no
    shuffle: they meet one small row per source. Rows equal in id and size are taken
    alike; documents without words come along with their neighbours.
    """
    plan = mixture(docs, whole=True, seed=seed, **options)
    place = F.struct("key", "id", "size")
    ends = written(
        plan.groupBy("source").agg(F.max("epochs").alias("__epochs"), F.max(F.when(F.col("part") > 0, place)).alias("__end")).withColumnRenamed("source", "__source"),
        "ends",
    )
    own = F.struct(random_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id").alias("id"), word_count(F.col("text")).alias("size"))
    copies = F.col("__epochs") + F.when(own <= F.col("__end"), 1).otherwise(0)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    mixed = docs.join(ends, F.col("source").eqNullSafe(F.col("__source")))
    return mixed.select(F.explode(F.array_repeat(row, copies.cast("int"))).alias("__row")).select("__row.*")


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixture(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLE = r"""
WITH base AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM sizes),
weighed AS (SELECT *, CASE source_rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM ranked),
opened AS (
  SELECT *, row_number() OVER room AS pos,
         CAST(sum(source_size) OVER () AS BIGINT) * 150
           - CAST(coalesce(sum(2 * source_size) OVER (room ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) * 100 AS num,
         CAST(sum(w) OVER (room ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) * 100 AS den
  FROM weighed WINDOW room AS (ORDER BY source_size / w, source_rank)),
cut AS (SELECT min(pos) AS pos, arg_min(num, pos) AS num, arg_min(den, pos) AS den
        FROM opened WHERE num * w <= 2 * source_size * den),
targets AS (
  SELECT o.source, o.source_size,
         CASE WHEN c.pos IS NULL OR o.pos < c.pos THEN CAST(2 * o.source_size AS DOUBLE)
              ELSE CAST(o.w * c.num AS DOUBLE) / CAST(c.den AS DOUBLE) END AS target
  FROM opened o CROSS JOIN cut c),
budgets AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN least(2, CAST(floor(target + 0.5) AS BIGINT) // source_size) ELSE 0 END AS epochs
  FROM targets),
runs AS (
  SELECT b.doc_id, b.size, t.source_size, t.target, t.epochs, t.budget - t.epochs * t.source_size AS rest,
         CAST(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.key, b.doc_id, b.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM base b JOIN budgets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken
FROM runs
"""
