"""The event envelope: classification, identity and wire format of a command."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = 1
SNAPSHOT, INCREMENTAL, HEARTBEAT = "snapshot", "incremental", "heartbeat"

#: The data type that each command writes.
COMMANDS_OF_TYPE = {
    "string": ("set", "setex", "psetex", "setnx", "append", "incr", "decr", "mset", "msetnx", "incrby", "decrby", "getset"),
    "hash": ("hset", "hmset", "hdel", "hincrby", "hincrbyfloat"),
    "list": ("lpush", "rpush", "lpop", "rpop", "ltrim", "lset", "linsert", "rpoplpush"),
    "set": ("sadd", "srem", "spop", "sinterstore", "sunionstore", "sdiffstore"),
    "zset": ("zadd", "zrem", "zincrby", "zremrangebyrank", "zremrangebyscore"),
}
#: Commands that delete, and those that only set a lifetime.
DELETING = ("DEL", "UNLINK", "FLUSHDB", "FLUSHALL")
EXPIRING = ("EXPIRE", "PEXPIRE")

SOURCE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("db", T.StringType()), T.StructField("filenum", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("exec_time_s", T.LongType()),
])
EVENT = T.StructType([
    T.StructField("schema_version", T.IntegerType()), T.StructField("phase", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("db", T.StringType()), T.StructField("data_type", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("command", T.StringType()), T.StructField("args", T.ArrayType(T.StringType())), T.StructField("args_encoding", T.StringType()),
    T.StructField("event_id", T.StringType()), T.StructField("source", SOURCE),
])


def data_type(command: Column) -> Column:
    pairs = chain.from_iterable((F.lit(c), F.lit(t)) for t, names in COMMANDS_OF_TYPE.items() for c in names)
    return F.coalesce(F.create_map(*pairs)[F.lower(command)], F.lit("unknown"))


def incremental_op(command: Column) -> Column:
    return F.when(F.upper(command).isin(*DELETING), "d").otherwise("u")


def snapshot_op(command: Column) -> Column:
    return F.when(F.upper(command).isin(*EXPIRING), "u").otherwise("r")


def partition_key(db: Column, key: Column) -> Column:
    """Without the data type, so that a key's deletion and re-creation stay together."""
    return F.concat_ws(":", db, key)


def event_identity(phase: Column, source_id: Column, filenum: Column, offset: Column, seq: Column, db: Column, kind: Column, key: Column, command: Column) -> Column:
    """Snapshot events of one chunked key share an id: dedupe those by position and seq too."""
    return F.when(phase == INCREMENTAL, F.concat_ws(":", F.lit("inc"), source_id, filenum.cast("string"), offset.cast("string"), seq.cast("string"))).otherwise(
        F.concat_ws(":", phase, source_id, db, kind, key, command)
    )


def args_encoding(args: Column) -> Column:
    """``utf8`` if every argument is valid UTF-8, else ``base64`` for all of them."""
    return F.when(F.forall(args, lambda a: F.is_valid_utf8(a.cast("string"))), "utf8").otherwise("base64")


def wire_args(args: Column) -> Column:
    return F.when(args_encoding(args) == "utf8", F.transform(args, lambda a: a.cast("string"))).otherwise(F.transform(args, F.base64))


def decoded_args(args: Column, encoding: Column) -> Column:
    """Arguments as bytes, from the wire form."""
    return F.when(encoding == "base64", F.transform(args, F.unbase64)).otherwise(F.transform(args, lambda a: a.cast("binary")))


def to_events(log: DataFrame, source_id: str, db: str = "db0", phase: str = INCREMENTAL) -> DataFrame:
    """Events of a decoded log: ``argv`` (array of binary), ``filenum, offset, seq,
    exec_time_s``. Other columns are kept.

    The key is the second argument, or empty. A null ``exec_time_s`` or 0 stays off
    the wire. Empty argument lists give null commands of type unknown.
    """
    command = F.try_element_at("argv", F.lit(1)).cast("string")
    key = F.coalesce(F.try_element_at("argv", F.lit(2)).cast("string"), F.lit(""))
    kind, op = data_type(command), (incremental_op if phase == INCREMENTAL else snapshot_op)(command)
    seq = F.col("seq").cast("bigint")
    source = F.struct(
        F.lit(source_id).alias("id"), F.lit(db).alias("db"), F.col("filenum").cast("bigint").alias("filenum"), F.col("offset").cast("bigint").alias("offset"),
        seq.alias("seq"), F.when(F.col("exec_time_s") != 0, F.col("exec_time_s").cast("bigint")).alias("exec_time_s"),
    )
    used = {"argv", "filenum", "offset", "seq", "exec_time_s"} | {f.name for f in EVENT.fields}
    return log.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(phase).alias("phase"), op.alias("op"), F.lit(db).alias("db"), kind.alias("data_type"),
        key.alias("key"), command.alias("command"), wire_args(F.col("argv")).alias("args"), args_encoding(F.col("argv")).alias("args_encoding"),
        event_identity(F.lit(phase), F.lit(source_id), F.col("filenum"), F.col("offset"), seq, F.lit(db), kind, key, command).alias("event_id"),
        source.alias("source"), F.try_element_at("argv", F.lit(2)).alias("key_bytes"),
        *[F.col(f"`{c}`") for c in log.columns if c not in used],
    )


def wire_json(events: DataFrame) -> Column:
    """The event as one JSON object; absent execution times are left out."""
    return F.to_json(F.struct(*[F.col(f.name) for f in EVENT.fields]))


def from_json_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Events from JSON lines; a line that is no event has ``malformed`` true."""
    parsed = lines.select(F.from_json(F.col(column), EVENT).alias("e"), F.col(column).alias("raw"))
    return parsed.select("e.*", "raw", (F.col("e").isNull() | F.col("e.phase").isNull()).alias("malformed"))


def heartbeat(source_id: str, db: str, filenum: Column, offset: Column, at: Column) -> Column:
    """A heartbeat event at a position: it carries progress, no command."""
    source = F.struct(F.lit(source_id).alias("id"), F.lit(db).alias("db"), filenum.cast("bigint").alias("filenum"), offset.cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("seq"), at.cast("bigint").alias("exec_time_s"))
    return F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(HEARTBEAT).alias("phase"), F.lit("h").alias("op"), F.lit(db).alias("db"), F.lit("none").alias("data_type"),
        F.lit("").alias("key"), F.lit("").alias("command"), F.array().cast("array<string>").alias("args"), F.lit("utf8").alias("args_encoding"),
        F.concat_ws(":", F.lit(HEARTBEAT), F.lit(source_id), F.lit(db), F.lit("none"), F.lit(""), F.lit("")).alias("event_id"), source.alias("source"),
    )


def described(events: DataFrame) -> Column:
    """One line of text for people."""
    return F.concat_ws(" ", "phase", "op", F.concat_ws("/", "db", "data_type", "key"), "command", F.concat(F.lit("@"), F.col("source.filenum"), F.lit(":"), F.col("source.offset"), F.lit("#"), F.col("source.seq")))


def relative_expiry(argv: Column, now_s: Column) -> Column:
    """``pksetexat key at value`` as ``setex key seconds value``; other commands as they are."""
    at = F.try_element_at(argv, F.lit(3)).cast("string").try_cast("bigint")
    applies = (F.size(argv) >= 4) & (F.try_element_at(argv, F.lit(1)).cast("string") == "pksetexat") & at.isNotNull()
    return F.when(applies, F.array(F.lit("setex").cast("binary"), F.try_element_at(argv, F.lit(2)), (at - now_s).cast("string").cast("binary"), F.try_element_at(argv, F.lit(4)))).otherwise(argv)
