"""Snapshot scan: typed key states as full-image commands, in scan order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.functions.envelope import to_events
from keyflow.sources.shared import shared_dir, written

#: Fixed order of the stages, and the prefix of keys that never leave the source.
STAGES = ("string", "list", "hash", "set", "zset")
INTERNAL_PREFIX = "_internal:slotkey:4migrate:"
CHUNK = 512
#: Command that writes a chunk of each collection.
WRITERS = {"list": "RPUSH", "hash": "HMSET", "set": "SADD", "zset": "ZADD"}


def stage_of(typ: Column) -> Column:
    out = F.lit(None).cast("int")
    for i, t in enumerate(STAGES):
        out = F.when(typ == t, i).otherwise(out)
    return out


def glob_regex(pattern: str) -> str:
    """A key glob (``*``, ``?``) as a regular expression."""
    quoted = "".join({"*": r"[\s\S]*", "?": r"[\s\S]"}.get(c, r"\Q" + c + r"\E") for c in pattern)
    return rf"\A{quoted}\z"


def scan(
    state: DataFrame, pattern: str = "*", types: tuple[str, ...] = STAGES, list_tail: int = -1,
    chunk: int = CHUNK, resume: tuple[str, str] | None = None, lifetimes: bool = True,
) -> DataFrame:
    """Commands of a full scan: ``stage, key, part, argv`` (argv as text).

    ``state`` is STATE plus ``ttl`` (seconds, null or <= 0: none): ``key, typ, s, h, l,
    st, z, ttl``. Strings give ``SET k v [EX ttl]``; collections one command per
    ``chunk`` elements, then ``EXPIRE k ttl``; without ``lifetimes`` neither. A
    positive ``list_tail`` keeps that many last elements of lists. ``resume`` (type,
    key) starts at that key, included. Empty collections give nothing.
    """
    rows = state.where(F.col("typ").isin(*types) & ~F.col("key").startswith(INTERNAL_PREFIX)).withColumn("stage", stage_of(F.col("typ")))
    if pattern != "*":
        rows = rows.where(F.col("key").rlike(glob_regex(pattern)))
    if resume:
        at = STAGES.index(resume[0])
        rows = rows.where((F.col("stage") > at) | ((F.col("stage") == at) & (F.col("key") >= resume[1])))
    tail = F.slice("l", -list_tail, list_tail) if list_tail > 0 else F.col("l")
    members = F.when(F.size("l") > list_tail, tail).otherwise(F.col("l")) if list_tail > 0 else tail
    flat = lambda m, swap: F.transform(
        F.array_sort(F.map_entries(m)), lambda e: F.array(e["value"].cast("string"), e["key"]) if swap else F.array(e["key"], e["value"])
    )
    items = (
        F.when(F.col("typ") == "list", F.transform(members, lambda x: F.array(x))).when(F.col("typ") == "set", F.transform(F.array_sort("st"), lambda x: F.array(x)))
        .when(F.col("typ") == "hash", flat(F.col("h"), False)).when(F.col("typ") == "zset", flat(F.col("z"), True))
    )
    writer = F.create_map(*[F.lit(x) for pair in WRITERS.items() for x in pair])[F.col("typ")]
    alive = (F.col("ttl") > 0) & F.lit(lifetimes)
    expiry = F.col("ttl").cast("string")
    text = F.when(alive, F.array(F.lit("SET"), "key", "s", F.lit("EX"), expiry)).otherwise(F.array(F.lit("SET"), "key", "s"))
    parts = F.transform(
        F.slice(F.sequence(F.lit(0), F.ceil(F.size(items) / chunk).cast("int")), F.lit(1), F.ceil(F.size(items) / chunk).cast("int")),
        lambda i: F.concat(F.array(writer, F.col("key")), F.flatten(F.slice(items, i * chunk + 1, F.lit(chunk)))),
    )
    companion = F.when(alive & (F.size(items) > 0), F.array(F.array(F.lit("EXPIRE"), "key", expiry))).otherwise(F.array().cast("array<array<string>>"))
    commands = F.when(F.col("typ") == "string", F.array(text)).otherwise(F.concat(parts, companion))
    return rows.select("stage", "key", F.posexplode(commands).alias("part", "argv"))


def snapshot_events(commands: DataFrame, anchor: tuple[int, int], source_id: str, db: str = "db0") -> DataFrame:
    """Events of a scan at its anchor, numbered from 1 in scan order.

    The scan is dealt into ranges of (stage, key, part) by Spark's sampled bounds,
    sorted within them and written to the shared folder, one file a range. A row's
    number is its place in its file after the rows of the files before: one exchange,
    ranges of even size whatever keys look like, and one short row a file to sum up.
    ``stage`` stays beside the event's own columns.
    """
    place = ["stage", "key", "part"]
    spark = commands.sparkSession
    ranged = written(commands.repartitionByRange(*place).sortWithinPartitions(*place), f"{shared_dir(spark)}/keyflow-{uuid.uuid4().hex}/snapshot")
    # Files are named after their ranges' numbers, which are in order.
    at = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    ranged = ranged.select("*", at.alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = ranged.groupBy("__file").agg(F.count("*").alias("n"))
    before = sizes.select("__file", F.coalesce(F.sum("n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    log = ranged.join(before, "__file").select(
        F.col("argv").cast("array<binary>").alias("argv"), F.lit(anchor[0]).cast("bigint").alias("filenum"), F.lit(anchor[1]).cast("bigint").alias("offset"),
        (F.col("before") + F.col("__row") + 1).alias("seq"), F.lit(0).cast("bigint").alias("exec_time_s"), "stage",
    )
    return to_events(log, source_id, db, "snapshot")
