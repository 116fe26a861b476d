"""The deterministic command log that the registered queries run on.

It is derived from ``events`` (and a snapshot from ``customer`` and ``nation``), the
same way in Spark (here) and in SQL (``LOG_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.envelope import to_events

SOURCE_ID, DB, FILE_ENTRIES, ENTRY_BYTES = "node-a:9221", "db0", 1000, 64
ANCHOR = (3, 12800)
BATCH = 500


def command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, filenum, offset, pb_end, seq, exec_time_s, argv`` and ``end`` (pb_end's offset)."""
    return log_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def log_of(ev: DataFrame) -> DataFrame:
    """The log of a table or stream of events."""
    k, user = F.get_json_object("props", "$.k"), F.col("user_id").cast("string")
    user_key, text = F.concat(F.lit("user:"), user), F.col("value").cast("decimal(18,2)").cast("string")
    argv = (
        F.when(F.col("event_type") == "signup", F.array(F.lit("HMSET"), user_key, F.lit("name"), F.concat(F.lit("u"), user), F.lit("tier"), F.concat(F.lit("t"), k)))
        .when(F.col("event_type") == "view", F.array(F.lit("HSET"), user_key, F.lit("last_view"), F.col("event_id").cast("string")))
        .when(F.col("event_type") == "click", F.array(F.lit("HSET"), user_key, F.lit("clicks"), k))
        .when(F.col("event_type") == "purchase", F.array(F.lit("SET"), F.concat(F.lit("acct:"), user), F.concat(F.lit('{"balance":'), text, F.lit(',"k":'), k, F.lit("}"))))
        .otherwise(F.array(F.lit("DEL"), user_key))
    )
    filenum = F.expr(f"event_id div {FILE_ENTRIES}")
    offset = F.pmod(F.col("event_id"), F.lit(FILE_ENTRIES)) * ENTRY_BYTES
    return ev.select(
        F.col("event_id").alias("id"), filenum.alias("filenum"), offset.alias("offset"), (offset + ENTRY_BYTES).alias("end"),
        F.struct(filenum.alias("filenum"), (offset + ENTRY_BYTES).alias("offset")).alias("pb_end"), F.lit(0).cast("bigint").alias("seq"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))").cast("bigint").alias("exec_time_s"),
        argv.cast("array<binary>").alias("argv"),
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the log; keeps ``id, pb_end, end``."""
    return to_events(command_log(spark, sf_dir), SOURCE_ID, DB)


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream (of the one file; a stream wants a directory)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return to_events(log_of(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)), SOURCE_ID, DB)


def snapshot_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as hashes and nations as strings, in the state layout."""
    customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
    none = {"l": "array<string>", "st": "array<string>", "z": "map<string,double>"}
    empty = [F.lit(None).cast(t).alias(c) for c, t in none.items()]
    hashes = customer.select(
        F.concat(F.lit("cust:"), F.col("c_custkey").cast("string")).alias("key"), F.lit("hash").alias("typ"), F.lit(None).cast("string").alias("s"),
        F.create_map(F.lit("name"), F.col("c_name"), F.lit("seg"), F.col("c_mktsegment")).alias("h"), *empty,
        F.when(F.col("c_custkey") % 10 == 0, 3600).otherwise(0).cast("bigint").alias("ttl"),
    )
    strings = nation.select(
        F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("key"), F.lit("string").alias("typ"), F.col("n_name").alias("s"),
        F.lit(None).cast("map<string,string>").alias("h"), *empty, F.lit(0).cast("bigint").alias("ttl"),
    )
    return hashes.unionByName(strings)


#: Common table expression of the same log.
LOG_SQL = f"""
log AS (
  SELECT event_id AS id, event_id // {FILE_ENTRIES} AS filenum, (event_id % {FILE_ENTRIES}) * {ENTRY_BYTES} AS off,
         (event_id % {FILE_ENTRIES}) * {ENTRY_BYTES} + {ENTRY_BYTES} AS pb_off, CAST(floor(epoch(ts)) AS BIGINT) AS exec_time_s,
         event_type, user_id, json_extract_string(props, '$.k') AS k, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount,
         CASE WHEN event_type = 'purchase' THEN 'acct:' ELSE 'user:' END || user_id AS key,
         CASE event_type WHEN 'signup' THEN 'HMSET' WHEN 'view' THEN 'HSET' WHEN 'click' THEN 'HSET' WHEN 'purchase' THEN 'SET' ELSE 'DEL' END AS command,
         CASE event_type WHEN 'purchase' THEN 'string' WHEN 'error' THEN 'unknown' ELSE 'hash' END AS data_type,
         CASE event_type WHEN 'error' THEN 'd' ELSE 'u' END AS op
  FROM events)"""
#: Hash fields that each event writes.
CELLS_SQL = """
cells AS (
  SELECT id, user_id, 'name' AS f, 'u' || user_id AS v FROM log WHERE event_type = 'signup'
  UNION ALL SELECT id, user_id, 'tier', 't' || k FROM log WHERE event_type = 'signup'
  UNION ALL SELECT id, user_id, 'last_view', CAST(id AS VARCHAR) FROM log WHERE event_type = 'view'
  UNION ALL SELECT id, user_id, 'clicks', k FROM log WHERE event_type = 'click')"""
