"""Deterministic workloads: key universes and command storms as log DataFrames.

All give ``filenum, offset, seq, exec_time_s, argv`` (and ``n``, the entry's number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY, PER_FILE = 64, 1 << 20


def _log(rows: DataFrame, n: Column, argv: Column) -> DataFrame:
    """Numbered commands as log entries; ``n`` orders them."""
    return rows.select(
        n.alias("n"), F.shiftright(n, 20).alias("filenum"), (F.pmod(n, F.lit(PER_FILE)) * ENTRY).alias("offset"), F.lit(0).cast("bigint").alias("seq"),
        (F.lit(1_700_000_000) + F.expr("id div 1000")).cast("bigint").alias("exec_time_s"), argv.cast("array<binary>").alias("argv"),
    )


def _s(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _array(*parts) -> Column:
    return F.array(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def preload(spark: SparkSession, keys: int, start: int = 0) -> DataFrame:
    """One key of each of the five types in turn: strings (every tenth a number), hashes
    of 4 fields, lists of 8, sets of 6 and sorted sets of 6 members."""
    rows = spark.range(keys)
    i, text = F.col("id"), F.col("id").cast("string")
    numbered = lambda name, count, value: [x for j in range(count) for x in value(f"{name}{j}", j)]
    argv = (
        F.when(i % 5 == 0, _array("SET", _s("str:", text), F.when(i % 10 == 0, (i + 1000).cast("string")).otherwise(_s("sv", text))))
        .when(i % 5 == 1, _array("HMSET", _s("hsh:", text), *numbered("f", 4, lambda n, j: (n, _s(f"hv{j}_", text)))))
        .when(i % 5 == 2, _array("RPUSH", _s("lst:", text), *numbered("e", 8, lambda n, j: (n,))))
        .when(i % 5 == 3, _array("SADD", _s("set:", text), *numbered("m", 6, lambda n, j: (n,))))
        .otherwise(_array("ZADD", _s("zst:", text), *numbered("z", 6, lambda n, j: (str(j + 1.5), n))))
    )
    return _log(rows, i + start, argv)


def net_zero_storm(spark: SparkSession, keys: int, operations: int, lag: int = 1000) -> DataFrame:
    """Pairs that cancel out, ``lag`` operations apart: new keys written and deleted,
    members added to preloaded collections and taken out again, and preloaded strings
    deleted and restored."""
    rows = spark.range(operations).withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
    i, undo = F.col("id"), F.col("part") == 1
    text, target = i.cast("string"), F.pmod(i * 7919, F.lit(max(1, keys // 5))) * 5
    argv = (
        F.when(i % 8 == 4, F.when(undo, _array("SET", _s("str:", target.cast("string")), F.when(target % 10 == 0, (target + 1000).cast("string")).otherwise(_s("sv", target.cast("string"))))).otherwise(_array("DEL", _s("str:", target.cast("string")))))
        .when(i % 4 == 0, F.when(undo, _array("DEL", _s("tmp:", text))).otherwise(_array("SET", _s("tmp:", text), "x")))
        .when(i % 4 == 1, F.when(undo, _array("HDEL", _s("hsh:", (target + 1).cast("string")), _s("n", text))).otherwise(_array("HSET", _s("hsh:", (target + 1).cast("string")), _s("n", text), "v")))
        .when(i % 4 == 2, F.when(undo, _array("SREM", _s("set:", (target + 3).cast("string")), _s("n", text))).otherwise(_array("SADD", _s("set:", (target + 3).cast("string")), _s("n", text))))
        .otherwise(F.when(undo, _array("ZREM", _s("zst:", (target + 4).cast("string")), _s("n", text))).otherwise(_array("ZADD", _s("zst:", (target + 4).cast("string")), "2.5", _s("n", text))))
    )
    place = (i + F.when(undo, lag).otherwise(0)) * 2 + F.col("part") + keys
    return _log(rows, place, argv)


def type_mix(spark: SparkSession, keys: int) -> DataFrame:
    """Each key number as five keys, with a few commands that shrink them again."""
    rows = spark.range(keys).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(9))))
    text, p = F.col("id").cast("string"), F.col("part")
    steps = [
        ("SET", "str:", ["a"]), ("HMSET", "hsh:", ["a", "1", "b", "2", "c", "3"]), ("HDEL", "hsh:", ["b"]), ("RPUSH", "lst:", ["a", "b", "c", "d"]), ("LPOP", "lst:", []),
        ("SADD", "set:", ["a", "b", "c"]), ("SREM", "set:", ["c", "x"]), ("ZADD", "zst:", ["1.5", "a", "2", "b"]), ("ZREM", "zst:", ["a"]), ("HSET", "str:", ["refused", "1"]),
    ]
    argv = None
    for at, (command, prefix, rest) in enumerate(steps):
        own = _array(command, _s(prefix, text), *rest)
        argv = F.when(p == at, own) if argv is None else argv.when(p == at, own)
    return _log(rows, F.col("id") * len(steps) + p, argv)


def striped_load(spark: SparkSession, keys: int, hash_every: int = 5, prefix: str = "k") -> DataFrame:
    """Strings, with a hash for every ``hash_every``-th key."""
    text = F.col("id").cast("string")
    argv = F.when(F.pmod(F.col("id"), F.lit(hash_every)) == 0, _array("HMSET", _s(f"{prefix}:", text), "name", _s("n", text), "age", F.pmod("id", F.lit(100)).cast("string"))).otherwise(
        _array("SET", _s(f"{prefix}:", text), _s("v", text))
    )
    return _log(spark.range(keys), F.col("id"), argv)


#: Shares of the commands in a churn storm, in hundredths.
CHURN_MIX = (("SET", 25), ("HSET", 20), ("HDEL", 5), ("RPUSH", 10), ("LPOP", 5), ("SADD", 10), ("SREM", 5), ("ZADD", 10), ("DEL", 5), ("EXPIRE", 5))


def churn(spark: SparkSession, operations: int, keys: int, seed: int = 42) -> DataFrame:
    """Random commands on random keys, the same for the same seed (by md5, so that any
    store can make the same storm)."""
    text = F.col("id").cast("string")
    drawn = lambda n, below: F.conv(F.substring(F.md5(_s(f"{seed + n}:", text)), 1, 8), 16, 10).cast("bigint") % below
    roll, key, member = drawn(0, 100), drawn(1, keys).cast("string"), _s("m", drawn(2, 8).cast("string"))
    forms = {
        "SET": _array("SET", _s("str:", key), text), "HSET": _array("HSET", _s("hsh:", key), member, text), "HDEL": _array("HDEL", _s("hsh:", key), member),
        "RPUSH": _array("RPUSH", _s("lst:", key), text), "LPOP": _array("LPOP", _s("lst:", key)), "SADD": _array("SADD", _s("set:", key), member),
        "SREM": _array("SREM", _s("set:", key), member), "ZADD": _array("ZADD", _s("zst:", key), F.pmod("id", F.lit(50)).cast("string"), member),
        "DEL": _array("DEL", _s("hsh:", key)), "EXPIRE": _array("EXPIRE", _s("str:", key), "60"),
    }
    argv, upto = None, 0
    for command, share in CHURN_MIX:
        upto += share
        argv = F.when(roll < upto, forms[command]) if argv is None else argv.when(roll < upto, forms[command])
    return _log(spark.range(operations), F.col("id"), argv)


def probe(spark: SparkSession) -> DataFrame:
    """A handful of commands of each delicate kind."""
    commands = [["MSET", "p:1", "a", "p:2", "b"], ["SETEX", "p:3", "60", "c"], ["HSET", "p:4", "f", "1"], ["HSET", "p:5", "f", "1"], ["DEL", "p:5"]]
    rows = spark.range(len(commands))
    argv = None
    for at, command in enumerate(commands):
        argv = F.when(F.col("id") == at, _array(*command)) if argv is None else argv.when(F.col("id") == at, _array(*command))
    return _log(rows, F.col("id"), argv)


def mutations(spark: SparkSession, operations: int, keys: int, start: int = 0) -> DataFrame:
    """A storm that is told by arithmetic alone: operation i writes key ``k:(7i mod keys)``,
    every third time as a hash field, every tenth deletes the key of ten before."""
    rows, i = spark.range(operations), F.col("id")
    key = lambda n: _s("k:", F.pmod(n * 7, F.lit(keys)).cast("string"))
    text = i.cast("string")
    argv = F.when(i % 10 == 9, _array("DEL", key(i - 9))).when(i % 3 == 0, _array("HSET", _s("h:", F.pmod(i * 7, F.lit(keys)).cast("string")), _s("f", (i % 4).cast("string")), text)).otherwise(_array("SET", key(i), text))
    return _log(rows, i + start, argv)
