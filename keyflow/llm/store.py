"""Shared storage, written tables and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor shares, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting (a test) gets a folder of its own; on a
    cluster a machine's own folder would lose what other machines write to it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="keyflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    if base.startswith("/"):  # in the default file system, which other readers do not know
        default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        base = default.rstrip("/").replace("file:", "file://") + base if default.startswith("file:") else default.rstrip("/") + base
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/keyflow-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again, with their folders."""
    for df in tables:
        files = df.inputFiles()
        if not files:
            continue
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        for place in (folder, folder.getParent()):
            if "keyflow-" not in place.toString():
                break
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Smallest reachable id for every id that has an edge.

    ``edges`` has bigint columns ``u`` and ``v``; the result has ``node`` and
    ``root`` (root <= node, roots included). Alternates large-star and small-star
    contractions, each a grouped minimum (combined map-side) joined back to the
    edges; every round is written to the shared folder. The driver sees only a
    count and a checksum per round.
    """
    cur = written(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        before, cur = cur, written(small, "edges")
        discard(before)
        now = cur.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (now.n, now.x) == seen:
            break
        seen = (now.n, now.x)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
