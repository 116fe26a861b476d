"""Registered queries of the command-log engine and their SQL oracles."""

from __future__ import annotations

import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyflow.functions.decode import decode_log, resp_bytes
from keyflow.functions.envelope import args_encoding, decoded_args, from_json_lines, partition_key, relative_expiry, to_events, wire_args, wire_json
from keyflow.functions.position import position, sequence_number
from keyflow.operators import verify
from keyflow.operators.coalesce import apply_to_table, coalesce_rows
from keyflow.operators.gate import after_anchor, first_seen, ordered_union
from keyflow.operators.rules import Rule, column_shape, key_of, map_events, rendered, rows_of
from keyflow.operators.snapshot import scan, snapshot_events
from keyflow.operators.state import canonical, fold_hashes, fold_states
from keyflow.plans.commandlog import ANCHOR, BATCH, CELLS_SQL, DB, LOG_SQL, SOURCE_ID, command_log, log_events, log_of, snapshot_state, streamed_events
from keyflow.sources import workload
from keyflow.sources.shared import shared_dir
from keyflow.streaming.runner import collected
from keyflow.streaming.sinks import batch_rows, load_requests
from keyflow.streaming.stateful import without_redeliveries

QUERIES: dict = {}
ORACLES: dict = {}

USERS = Rule(table="ods_user", pk=["uid"], types=["hash"], key_pattern="user:{uid}", fields={"name": "name", "tier": "tier", "last_view": "last_view", "clicks": "clicks"})
ACCOUNTS = Rule(table="ods_account", pk=["id"], types=["string"], key_pattern="acct:{id}", value_json=True, json_columns=["balance", "k"])
RULES = [USERS, ACCOUNTS]
SESSION_GAP_S = 6 * 3600


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _with(sql: str, *more: str) -> str:
    return "WITH " + ", ".join([LOG_SQL, *more]) + sql


def _rows(spark, sf_dir) -> DataFrame:
    """Mutations of the log with their event number; ``pk`` is an array of columns and values."""
    mapped = map_events(log_events(spark, sf_dir), RULES)
    return mapped.where(F.col("row.action").isin("upsert", "delete")).select("id", "row.table", key_of(F.col("row.pk")).alias("pk"), "row.cols", (F.col("row.action") == "delete").alias("del"))


def _shown(rows: DataFrame) -> DataFrame:
    """``pk`` and ``cols`` as text."""
    return rows.withColumn("pk", rendered(F.map_from_entries("pk"))).withColumn("cols", rendered(F.col("cols")))


@query(_with(f"""
SELECT id, filenum, off AS "offset", op, data_type, key, command, '{DB}:' || key AS partition_key, exec_time_s,
       'inc:{SOURCE_ID}:' || filenum || ':' || off || ':0' AS event_id FROM log"""))
def q01_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = log_events(spark, sf_dir)
    return e.select("id", "source.filenum", "source.offset", "op", "data_type", "key", "command", partition_key(F.col("db"), F.col("key")).alias("partition_key"), "source.exec_time_s", "event_id")


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'base64' ELSE 'utf8' END AS encoding, octet_length(encode(text)) AS bytes,
       md5(CASE WHEN doc_id % 3 = 0 THEN to_base64(encode(text)) ELSE text END) AS wire_md5, true AS restored
FROM documents WHERE text IS NOT NULL""")
def q02_args_encoding(spark, sf_dir):
    """Every third command also carries bytes that are no UTF-8."""
    odd = F.array(F.unhex(F.lit("fffe01")))
    text = F.col("text").cast("binary")
    argv = F.concat(F.array(F.lit("SET").cast("binary"), F.lit("doc").cast("binary"), text), F.when(F.col("doc_id") % 3 == 0, odd).otherwise(F.array().cast("array<binary>")))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").select("doc_id", text.alias("raw"), argv.alias("argv"))
    sent = docs.select("doc_id", "raw", args_encoding(F.col("argv")).alias("encoding"), wire_args(F.col("argv")).alias("args"))
    back = decoded_args(F.col("args"), F.col("encoding"))
    plain = F.when(F.col("encoding") == "base64", F.regexp_replace(F.element_at("args", 3), r"[\r\n]", "")).otherwise(F.element_at("args", 3))
    return sent.select("doc_id", "encoding", F.octet_length("raw").cast("bigint").alias("bytes"), F.md5(plain.cast("binary")).alias("wire_md5"), (F.element_at(back, 3) == F.col("raw")).alias("restored"))


@query(_with(f"""
SELECT CASE WHEN (filenum, pb_off) <= ({ANCHOR[0]}, {ANCHOR[1]}) THEN 'folded' ELSE 'emitted' END AS disposition, count(*) AS n,
       min(id) AS first_id, max(id) AS last_id FROM log GROUP BY 1"""))
def q03_gate(spark, sf_dir):
    log = command_log(spark, sf_dir)
    shown = F.when(after_anchor(F.col("pb_end"), *ANCHOR), "emitted").otherwise("folded")
    return log.groupBy(shown.alias("disposition")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


_SNAPSHOT_SQL = """
snap AS (
  SELECT 0 AS stage, 'nation:' || n_nationkey AS key, 0 AS part, 'SET' AS command FROM nation
  UNION ALL SELECT 2, 'cust:' || c_custkey, 0, 'HMSET' FROM customer
  UNION ALL SELECT 2, 'cust:' || c_custkey, 1, 'EXPIRE' FROM customer WHERE c_custkey % 10 = 0)"""


@query(_with(f"""
SELECT phase, rn, key, command, seq FROM (
  SELECT 'snapshot' AS phase, row_number() OVER (ORDER BY stage, key, part) AS rn, key, command, row_number() OVER (ORDER BY stage, key, part) AS seq FROM snap
  UNION ALL
  SELECT 'incremental', (SELECT count(*) FROM snap) + row_number() OVER (ORDER BY filenum, off), key, command, 0 FROM log
  WHERE (filenum, pb_off) > ({ANCHOR[0]}, {ANCHOR[1]}))""", _SNAPSHOT_SQL))
def q04_ordered_union(spark, sf_dir):
    """Snapshot, then the log after its anchor, numbered in delivery order."""
    snap = snapshot_events(scan(snapshot_state(spark, sf_dir)), ANCHOR, SOURCE_ID)
    log = log_events(spark, sf_dir).where(after_anchor(F.col("pb_end"), *ANCHOR))
    both = ordered_union(snap, log)
    # The snapshot is numbered already. Ranks of the log by file, shifted by what comes
    # before: files are few, rows many.
    later = both.where("phase_rank = 1").select("phase", "key", "command", "source.*")
    sizes = later.groupBy("filenum").agg(F.count("*").alias("n"))
    before = sizes.select("filenum", F.coalesce(F.sum("n").over(Window.orderBy("filenum").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("filenum").orderBy("offset", "seq"))
    dumped = snap.agg(F.count("*").alias("dumped"))
    ranked = later.withColumn("r", rank).join(before, "filenum").join(F.broadcast(dumped))  # one row
    first = both.where("phase_rank = 0").select("phase", F.col("source.seq").alias("rn"), "key", "command", "source.seq")
    return first.unionByName(ranked.select("phase", (F.col("dumped") + F.col("before") + F.col("r")).alias("rn"), "key", "command", "seq"))


@query(_with("""
SELECT data_type, count(*) AS n FROM log WHERE id % 50 <> 0 AND id % 7 <> 0 GROUP BY 1"""))
def q05_filters(spark, sf_dir):
    """Heartbeats (every 50th event) and internal keys (every 7th) stay out."""
    e = log_events(spark, sf_dir)
    e = e.withColumn("phase", F.when(F.col("id") % 50 == 0, "heartbeat").otherwise(F.col("phase")))
    e = e.withColumn("key", F.when(F.col("id") % 7 == 0, F.concat(F.lit("_internal:slotkey:4migrate:"), "key")).otherwise(F.col("key")))
    return e.where((F.col("phase") != "heartbeat") & ~F.col("key").startswith("_internal:slotkey:4migrate:")).groupBy("data_type").agg(F.count("*").alias("n"))


@query(_with("""
SELECT key, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM log GROUP BY key"""))
def q06_dedup(spark, sf_dir):
    """A third of the log delivered twice counts once."""
    e = log_events(spark, sf_dir)
    twice = e.unionByName(e.where(F.col("id") % 3 == 0))
    return first_seen(twice).groupBy("key").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


_ARRIVAL = "CASE WHEN id % 100 = 10 THEN id + 5 WHEN id % 100 = 15 THEN id - 5 ELSE id END"


@query(_with(f"""
, arrived AS (SELECT *, {_ARRIVAL} AS line_no FROM log),
checked AS (
  SELECT key, (filenum, off) <= lag((filenum, off)) OVER (ORDER BY line_no) AS late,
         (filenum, off) <= lag((filenum, off)) OVER (PARTITION BY key ORDER BY line_no) AS key_late FROM arrived)
SELECT count(*) AS n, count(*) FILTER (late) AS global_violations, count(*) FILTER (key_late) AS key_violations,
       count(DISTINCT key) FILTER (key_late) AS keys FROM checked"""))
def q07_order_violations(spark, sf_dir):
    arrived = log_events(spark, sf_dir).select("id", "key", position(F.col("source.filenum"), F.col("source.offset")).alias("pos"), F.expr(_ARRIVAL).alias("line_no"))
    late = verify.global_order_violations(arrived, "line_no").agg(F.count("*").alias("global_violations"))
    by_key = verify.order_violations(arrived, "line_no", "key").agg(F.count("*").alias("key_violations"), F.countDistinct("key").alias("keys"))
    return arrived.agg(F.count("*").alias("n")).join(F.broadcast(late)).join(F.broadcast(by_key))  # one row each


@query(_with("""
, taken AS (SELECT filenum, off, pb_off FROM log WHERE id % 97 <> 5 UNION ALL SELECT filenum, off, pb_off FROM log WHERE id % 89 = 3 AND id % 97 <> 5),
seen AS (SELECT *, lag(pb_off) OVER w AS end_before, lag(off) OVER w AS start_before FROM taken WINDOW w AS (PARTITION BY filenum ORDER BY off, pb_off))
SELECT filenum, off AS "offset", end_before, CASE WHEN off = start_before THEN 'redelivered' ELSE 'gap' END AS kind FROM seen
WHERE off = start_before OR off <> end_before"""))
def q08_capture_gaps(spark, sf_dir):
    log = command_log(spark, sf_dir).where(F.col("id") % 97 != 5).select("id", "filenum", "offset", F.col("end").alias("pb_end"))
    taken = log.unionByName(log.where(F.col("id") % 89 == 3)).drop("id")
    return verify.capture_gaps(taken).select("filenum", "offset", "end_before", "kind")


@query(_with("""SELECT id, (filenum << 40) | off AS sequence FROM log"""))
def q09_sequence(spark, sf_dir):
    return command_log(spark, sf_dir).select("id", sequence_number().alias("sequence"))


@query(_with("""SELECT 'incremental' AS phase, op, data_type, command, count(*) AS n FROM log GROUP BY op, data_type, command"""))
def q10_counts(spark, sf_dir):
    return log_events(spark, sf_dir).groupBy("phase", "op", "data_type", "command").agg(F.count("*").alias("n"))


@query(_with("""
SELECT count(*) AS entries, max(m.t - exec_time_s) AS max_lag, min(m.t - exec_time_s) AS min_lag, max((filenum << 40) | off) AS delivered
FROM log, (SELECT max(exec_time_s) AS t FROM log) m"""))
def q11_source_lag(spark, sf_dir):
    log = command_log(spark, sf_dir)
    last = log.agg(F.max("exec_time_s").alias("t"))
    lag = F.greatest(F.lit(0), F.col("t") - F.col("exec_time_s"))
    return log.join(F.broadcast(last)).agg(F.count("*").alias("entries"), F.max(lag).alias("max_lag"), F.min(lag).alias("min_lag"), F.max(sequence_number()).alias("delivered"))


@query(_with("""
SELECT l.id, 'ods_user' AS "table", 'uid=' || l.user_id AS pk, string_agg(f || '=' || v, ',' ORDER BY f) AS cols, false AS del
FROM log l JOIN cells c USING (id) GROUP BY l.id, l.user_id
UNION ALL SELECT id, 'ods_user', 'uid=' || user_id, '', true FROM log WHERE event_type = 'error'""", CELLS_SQL))
def q12_hash_mapping(spark, sf_dir):
    return _shown(_rows(spark, sf_dir).where("table = 'ods_user'"))


@query(_with("""SELECT id, 'id=' || user_id AS pk, 'balance=' || CAST(amount AS DOUBLE) || ',k=' || k AS cols FROM log WHERE event_type = 'purchase'"""))
def q13_json_mapping(spark, sf_dir):
    return _shown(_rows(spark, sf_dir).where("table = 'ods_account'")).select("id", "pk", "cols")


@query(_with("""
SELECT CASE event_type WHEN 'error' THEN 'skip' ELSE 'upsert' END AS action, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS rule, count(*) AS n
FROM log GROUP BY 1, 2"""))
def q14_delete_routing(spark, sf_dir):
    """A first rule that ignores deletions hides them from the rules after it."""
    first = Rule(table="a", pk=["uid"], types=["hash"], key_pattern="user:{uid}", delete="ignore")
    second = Rule(table="b", pk=["id"], types=["string"], key_pattern="{kind}:{id}", value_json=True)
    third = Rule(table="c", pk=["uid"], types=["hash"], key_pattern="user:{uid}")
    mapped = map_events(log_events(spark, sf_dir), [first, second, third])
    return mapped.groupBy("row.action", "row.rule").agg(F.count("*").alias("n"))


_KEYED = """
rows_ AS (
  SELECT id, id // %d AS batch, CASE WHEN event_type = 'purchase' THEN 'ods_account' ELSE 'ods_user' END AS tab,
         CASE WHEN event_type = 'purchase' THEN 'id=' ELSE 'uid=' END || user_id AS pk, event_type = 'error' AS del FROM log),
vals AS (
  SELECT id, f, v FROM cells
  UNION ALL SELECT id, 'balance', CAST(CAST(amount AS DOUBLE) AS VARCHAR) FROM log WHERE event_type = 'purchase'
  UNION ALL SELECT id, 'k', k FROM log WHERE event_type = 'purchase'),
heads AS (SELECT batch, tab, pk, min(id) AS first_id, max(id) AS last_id, max(id) FILTER (del) AS wiped FROM rows_ GROUP BY batch, tab, pk),
live AS (
  SELECT r.batch, r.tab, r.pk, f, arg_max(v, r.id) AS v FROM rows_ r JOIN vals USING (id) JOIN heads h ON (r.batch, r.tab, r.pk) = (h.batch, h.tab, h.pk)
  WHERE h.wiped IS NULL OR r.id > h.wiped GROUP BY r.batch, r.tab, r.pk, f),
texts AS (SELECT batch, tab, pk, string_agg(f || '=' || v, ',' ORDER BY f) AS cols FROM live GROUP BY batch, tab, pk)"""


@query(_with("""
SELECT h.batch, h.tab AS "table", h.pk, h.first_id AS "first", coalesce(h.wiped = h.last_id, false) AS del,
       coalesce(h.wiped < h.last_id, false) AS reset, coalesce(t.cols, '') AS cols
FROM heads h LEFT JOIN texts t USING (batch, tab, pk)""", CELLS_SQL, _KEYED % BATCH))
def q15_coalesce_batches(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("batch", F.expr(f"id div {BATCH}"))
    return _shown(coalesce_rows(rows, ("batch", "table", "pk"), "id")).drop("last")


@query(_with("""
SELECT CASE WHEN event_type = 'purchase' THEN 'ods_account' ELSE 'ods_user' END AS "table",
       CASE event_type WHEN 'purchase' THEN 'balance,id,k' WHEN 'signup' THEN 'name,tier,uid' WHEN 'view' THEN 'last_view,uid' WHEN 'click' THEN 'clicks,uid'
            ELSE '__DORIS_DELETE_SIGN__,uid' END AS shape, count(*) AS n, min(id) AS first_id FROM log GROUP BY 1, 2"""))
def q16_column_shapes(spark, sf_dir):
    mapped = map_events(log_events(spark, sf_dir), RULES).where("row IS NOT NULL")
    shape = column_shape(F.col("row.cols"), F.col("row.pk"), F.col("row.action") == "delete")
    return mapped.groupBy("row.table", shape.alias("shape")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(_with("""
SELECT h.tab AS "table", h.pk, coalesce(t.cols, '') AS cols FROM heads h LEFT JOIN texts t USING (batch, tab, pk)
WHERE h.wiped IS NULL OR h.wiped < h.last_id""", CELLS_SQL, _KEYED % 10**15))
def q17_final_table(spark, sf_dir):
    """Target rows after the whole log."""
    final = coalesce_rows(_rows(spark, sf_dir), ("table", "pk"), "id")
    return _shown(final.where("NOT del")).select("table", "pk", "cols")


@query(_with("""
SELECT substr(key, 1, 5) AS prefix, count(*) AS n, min(user_id) AS low, max(user_id) AS high FROM log GROUP BY 1"""))
def q18_tally(spark, sf_dir):
    return verify.tally(log_events(spark, sf_dir), ["user:", "acct:"])


@query(_with("""
, wanted AS (SELECT 'user:' || i AS key FROM range(0, 201) r(i) WHERE i % 4 <> 0),
counts AS (SELECT key, count(*) AS n FROM log GROUP BY key)
SELECT key, coalesce(n, 0) AS n, coalesce(n, 0) >= 40 AS ok FROM wanted LEFT JOIN counts USING (key)"""))
def q19_watch(spark, sf_dir):
    return verify.watched(spark, log_events(spark, sf_dir), verify.Watch.parse("user:0-200:4:40"))


_TARGET = "id % 97 <> 0"


@query(_with(f"""
, e AS (SELECT filenum, off, CASE WHEN id % 89 = 0 THEN key || 'x' ELSE key END AS key, command FROM log
        WHERE {_TARGET} AND id < (SELECT max(id) - 20 FROM log) UNION ALL SELECT 900000 + id, 0, key, command FROM log WHERE id % 1000 = 1),
audit AS (
  SELECT CASE WHEN l.key IS NULL THEN 'ghost' WHEN e.key IS NOT NULL AND e.key = l.key AND e.command = l.command THEN 'ok' WHEN e.key IS NOT NULL THEN 'mismatch'
         WHEN (l.filenum, l.off) <= ({ANCHOR[0]}, {ANCHOR[1]}) THEN 'folded'
         WHEN (l.filenum, l.off) > (SELECT max((filenum, off)) FROM e) THEN 'pending' ELSE 'missing' END AS kind
  FROM log l FULL JOIN e ON l.filenum = e.filenum AND l.off = e.off)
SELECT kind, count(*) AS n FROM audit GROUP BY kind"""))
def q20_audit(spark, sf_dir):
    log = log_events(spark, sf_dir).select("id", "source.filenum", "source.offset", "key", "command")
    last = log.agg((F.max("id") - 20).alias("cut"))
    e = log.join(F.broadcast(last)).where(F.expr(_TARGET) & (F.col("id") < F.col("cut"))).withColumn("key", F.when(F.col("id") % 89 == 0, F.concat("key", F.lit("x"))).otherwise(F.col("key")))
    ghosts = log.where(F.col("id") % 1000 == 1).withColumn("filenum", F.col("id") + 900000).withColumn("offset", F.lit(0).cast("bigint"))
    e = e.drop("cut").unionByName(ghosts)
    return verify.audit(log, e, ANCHOR).groupBy("kind").agg(F.count("*").alias("n"))


@query(_with(f"""
SELECT DISTINCT key FROM log WHERE (filenum, pb_off) <= ({ANCHOR[0]}, {ANCHOR[1]})
AND key NOT IN (SELECT key FROM log WHERE command = 'DEL' AND (filenum, pb_off) > ({ANCHOR[0]}, {ANCHOR[1]}))"""))
def q21_folded_without_correction(spark, sf_dir):
    """Keys folded into the snapshot that no later deletion corrects."""
    e = log_events(spark, sf_dir)
    later = after_anchor(F.col("pb_end"), *ANCHOR)
    return e.where(~later).select("key").distinct().join(e.where(later & (F.col("command") == "DEL")).select("key"), "key", "left_anti")


_STATES = """
fold_a AS (SELECT user_id, max(id) FILTER (event_type = 'error') AS wiped FROM log WHERE event_type <> 'purchase' GROUP BY user_id),
src AS (SELECT c.user_id, string_agg(f || '=' || v, ',' ORDER BY f) AS state FROM
  (SELECT c.user_id, f, arg_max(v, id) AS v FROM cells c JOIN fold_a USING (user_id) WHERE wiped IS NULL OR id > wiped GROUP BY c.user_id, f) c GROUP BY c.user_id),
fold_b AS (SELECT user_id, max(id) FILTER (event_type = 'error') AS wiped FROM log WHERE event_type <> 'purchase' AND id % 97 <> 0 GROUP BY user_id),
tgt AS (SELECT c.user_id, string_agg(f || '=' || v, ',' ORDER BY f) AS state FROM
  (SELECT c.user_id, f, arg_max(CASE WHEN id % 89 = 0 THEN v || '!' ELSE v END, id) AS v FROM cells c JOIN fold_b USING (user_id)
   WHERE (wiped IS NULL OR id > wiped) AND id % 97 <> 0 GROUP BY c.user_id, f) c GROUP BY c.user_id),
diff AS (SELECT 'user:' || coalesce(s.user_id, t.user_id) AS key, s.state AS src, t.state AS tgt,
  CASE WHEN t.state IS NULL THEN 'missing' WHEN s.state IS NULL THEN 'extra' ELSE 'value' END AS kind
  FROM src s FULL JOIN tgt t ON s.user_id = t.user_id WHERE s.state IS DISTINCT FROM t.state)"""


def _states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Hash states of the log and of a perturbed copy of it, as text."""
    e = log_events(spark, sf_dir).where(F.col("key").startswith("user:"))
    changed = F.transform("args", lambda a, i: F.when((F.col("id") % 89 == 0) & (i >= 2) & (i % 2 == 1), F.concat(a, F.lit("!"))).otherwise(a))
    other = e.where(F.col("id") % 97 != 0).withColumn("args", changed)
    text = F.array_join(F.array_sort(F.collect_list(F.concat("field", F.lit("="), "value"))), ",").alias("state")
    return tuple(fold_hashes(x).groupBy("key").agg(text) for x in (e, other))


@query(_with("SELECT key, kind, src, tgt FROM diff", CELLS_SQL, _STATES))
def q22_state_compare(spark, sf_dir):
    return verify.compare_states(*_states(spark, sf_dir)).select("key", "kind", "src", "tgt")


@query(_with("""
SELECT 'common' AS kind, count(*) AS n FROM (SELECT user_id FROM src INTERSECT SELECT user_id FROM tgt)
UNION ALL SELECT 'source_only', count(*) FROM (SELECT user_id FROM src EXCEPT SELECT user_id FROM tgt)
UNION ALL SELECT 'target_only', count(*) FROM (SELECT user_id FROM tgt EXCEPT SELECT user_id FROM src)""", CELLS_SQL, _STATES))
def q23_key_sets(spark, sf_dir):
    a, b = (s.select("key") for s in _states(spark, sf_dir))
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(a.intersect(b), "common").union(count(a.subtract(b), "source_only")).union(count(b.subtract(a), "target_only"))


@query(_with("""
SELECT kind, count(*) AS n, array_to_string(list_sort(list(key))[1:20], ' ') AS keys FROM diff GROUP BY kind""", CELLS_SQL, _STATES))
def q24_diff_samples(spark, sf_dir):
    found = verify.report(verify.compare_states(*_states(spark, sf_dir)), 20)
    return found.select("kind", "n", F.array_join("keys", " ").alias("keys"))


@query(_with("""SELECT 'user:' || user_id AS key, 'hash{' || state || '}' AS state FROM src""", CELLS_SQL, _STATES))
def q25_hash_fold(spark, sf_dir):
    """Ordered replay of all commands; the same states as the declarative fold."""
    folded = fold_states(log_events(spark, sf_dir).where(F.col("key").startswith("user:")))
    return folded.where("typ != 'none'").select("key", canonical(folded).alias("state"))


@query("""
SELECT 'hash' AS typ, count(*) AS keys, count(*) * 2 AS members FROM customer
UNION ALL SELECT 'list', count(*), count(*) * 3 FROM customer UNION ALL SELECT 'set', count(*), count(*) * 2 FROM customer
UNION ALL SELECT 'string', count(*), count(*) FROM customer UNION ALL SELECT 'zset', count(*), count(*) FROM customer""")
def q26_full_fold(spark, sf_dir):
    """All five types on a generated universe of as many keys a type as customers."""
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    folded = fold_states(to_events(workload.type_mix(spark, n), SOURCE_ID, DB))
    size = F.when(F.col("typ") == "hash", F.size("h")).when(F.col("typ") == "list", F.size("l")).when(F.col("typ") == "set", F.size("st")).when(F.col("typ") == "zset", F.size("z")).otherwise(1)
    return folded.where("typ != 'none'").groupBy("typ").agg(F.count("*").alias("keys"), F.sum(size).alias("members"))


@query("""SELECT count(*) AS keys, 0 AS changed, 0 AS left_over FROM customer""")
def q27_net_zero(spark, sf_dir):
    """A storm of operations and their opposites leaves the preloaded state as it was."""
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    preload = workload.preload(spark, n)
    storm = workload.net_zero_storm(spark, n, n * 2)
    text = lambda log: (lambda s: s.where("typ != 'none'").select("key", canonical(s).alias("state")))(fold_states(to_events(log, SOURCE_ID, DB)))
    a, b = text(preload), text(preload.unionByName(storm))
    diff = verify.compare_states(a, b).agg(F.count_if(F.col("kind") != "extra").cast("int").alias("changed"), F.count_if(F.col("kind") == "extra").cast("int").alias("left_over"))
    return a.agg(F.count("*").alias("keys")).join(F.broadcast(diff))


@query(_with("""
SELECT exec_time_s // 3600 * 3600 AS start_s, count(*) AS n, count(DISTINCT key) AS keys FROM log GROUP BY 1"""))
def q28_tumbling_windows(spark, sf_dir):
    log = log_events(spark, sf_dir)
    start = F.expr("source.exec_time_s div 3600 * 3600")
    return log.groupBy(start.alias("start_s")).agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


@query(_with("""
SELECT (exec_time_s // 1800 - i) * 1800 AS start_s, count(*) AS n FROM log, range(0, 2) r(i) GROUP BY 1"""))
def q29_sliding_windows(spark, sf_dir):
    log = log_events(spark, sf_dir).withColumn("at", F.timestamp_seconds("source.exec_time_s"))
    return log.groupBy(F.window("at", "60 minutes", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select(F.unix_timestamp("w.start").alias("start_s"), "n")


@query(_with("""
, gaps AS (SELECT user_id, exec_time_s AS t, CASE WHEN exec_time_s - lag(exec_time_s) OVER w < 21600 THEN 0 ELSE 1 END AS opens FROM log WINDOW w AS (PARTITION BY user_id ORDER BY exec_time_s)),
sessions AS (SELECT user_id, t, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS s FROM gaps)
SELECT user_id, min(t) AS start_s, max(t) + 21600 AS end_s, count(*) AS n FROM sessions GROUP BY user_id, s"""))
def q30_session_windows(spark, sf_dir):
    """A session ends once its key rests for 6 hours. (``session_window`` joins events
    exactly its gap apart and drops those without a time.)"""
    user = F.regexp_extract("key", r":(-?\d+)$", 1).try_cast("bigint")  # null for a key of no user
    times = log_events(spark, sf_dir).groupBy(user.alias("user_id"), F.col("source.exec_time_s").alias("t")).agg(F.count("*").alias("n"))
    by_time = Window.partitionBy("user_id").orderBy("t")
    opens = F.when(F.col("t") - F.lag("t").over(by_time) < SESSION_GAP_S, 0).otherwise(1)
    sessions = times.withColumn("opens", opens).withColumn("s", F.sum("opens").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    return sessions.groupBy("user_id", "s").agg(F.min("t").alias("start_s"), (F.max("t") + SESSION_GAP_S).alias("end_s"), F.sum("n").alias("n")).drop("s")


@query("""
SELECT 'cust:' || c_custkey AS key, i AS part, CASE i WHEN 2 THEN 'EXPIRE' ELSE 'HMSET' END AS command,
       CASE i WHEN 0 THEN 'name=' || c_name WHEN 1 THEN 'seg=' || c_mktsegment ELSE '3600=' END AS written
FROM customer, range(0, 3) r(i) WHERE i < 2 OR c_custkey % 10 = 0
UNION ALL SELECT 'nation:' || n_nationkey, 0, 'SET', n_name || '=' FROM nation""")
def q31_snapshot_chunks(spark, sf_dir):
    """A scan in chunks of one element, with lifetimes."""
    commands = scan(snapshot_state(spark, sf_dir), chunk=1)
    third = F.concat_ws("=", F.element_at("argv", 3), F.coalesce(F.try_element_at("argv", F.lit(4)), F.lit("")))
    return commands.select("key", F.col("part").cast("bigint").alias("part"), F.element_at("argv", 1).alias("command"), third.alias("written"))


@query("""
SELECT 'cust:' || c_custkey AS key FROM customer WHERE c_custkey % 10 = 1 AND length(CAST(c_custkey AS VARCHAR)) = 3 AND 'cust:' || c_custkey >= 'cust:4'""")
def q32_snapshot_resume(spark, sf_dir):
    """A glob and a type filter, resumed at a key."""
    return scan(snapshot_state(spark, sf_dir), pattern="cust:??1", types=("string", "hash"), resume=("hash", "cust:4")).select("key").distinct()


@query(_with("""SELECT (SELECT min(id) FROM log WHERE id % 700 = 699) - 1 AS pos"""))
def q33_contiguous_prefix(spark, sf_dir):
    """Last entry before the first that is not done."""
    log = command_log(spark, sf_dir)
    return verify.contiguous_prefix(log.select(F.col("id").alias("ord"), (F.col("id") % 700 != 699).alias("done"), F.col("id").alias("pos")))


@query("""SELECT 'cust:' || c_custkey AS key, 2 AS n FROM customer WHERE c_custkey % 40 = 3""")
def q34_repeated_snapshot(spark, sf_dir):
    """Snapshot events delivered twice; the companions of a key do not count as such."""
    snap = snapshot_events(scan(snapshot_state(spark, sf_dir)), ANCHOR, SOURCE_ID)
    again = snap.where(F.col("key").startswith("cust:") & (F.substring("key", 6, 20).try_cast("bigint") % 40 == 3))
    return verify.repeated_snapshot_keys(snap.unionByName(again)).select("key", "n")


@query(_with("""SELECT id, key FROM log WHERE id % 250 = 7 AND id > 1000"""))
def q35_late_corrections(spark, sf_dir):
    """Corrections that come after the log has begun (at entry 1000)."""
    phase = F.when(F.col("id") % 250 == 7, "correction").when(F.col("id") < 1000, "snapshot").otherwise("incremental")
    return verify.corrections_after_log(log_events(spark, sf_dir).withColumn("phase", phase), "id").select("id", "key")


@query(_with("""
SELECT id, CASE WHEN event_type = 'purchase' THEN 'setex' ELSE command END AS command,
       CASE WHEN event_type = 'purchase' THEN CAST(3600 - id % 100 AS VARCHAR) ELSE NULL END AS ttl FROM log"""))
def q36_relative_expiry(spark, sf_dir):
    log = command_log(spark, sf_dir)
    b = lambda c: c.cast("string").cast("binary")
    absolute = F.array(b(F.lit("pksetexat")), F.element_at("argv", 2), b(F.col("exec_time_s") + 3600 - F.col("id") % 100), F.try_element_at("argv", F.lit(3)))
    argv = F.when(F.element_at("argv", 1).cast("string") == "SET", absolute).otherwise(F.col("argv"))
    out = log.withColumn("argv", relative_expiry(argv, F.col("exec_time_s")))
    command = F.element_at("argv", 1).cast("string")
    return out.select("id", command.alias("command"), F.when(command == "setex", F.element_at("argv", 3).cast("string")).alias("ttl"))


def _raw_log(spark, sf_dir) -> DataFrame:
    """The log as binary entries; every 83rd is cut short and every 89th says another length."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                content = resp_bytes(r["argv"])
                entry = struct.pack("<HIIQIQI", 1, r["exec_time_s"], 1, r["id"], r["filenum"], r["offset"], len(content) + (r["id"] % 89 == 1)) + content
                out.append(entry[:40] if r["id"] % 83 == 1 else entry)
            yield pa.RecordBatch.from_arrays([batch.column("filenum"), batch.column("end"), pa.array([5] * len(out), pa.int32()), pa.array(out, pa.binary())], names=["pb_filenum", "pb_offset", "session_id", "binlog"])

    return command_log(spark, sf_dir).select("id", "filenum", "offset", "end", "exec_time_s", "argv").mapInArrow(run, "pb_filenum bigint, pb_offset bigint, session_id int, binlog binary")


@query(_with("""SELECT filenum, off AS "offset", pb_off AS end_offset, exec_time_s, command, key FROM log WHERE id % 83 <> 1 AND id % 89 <> 1"""))
def q37_binary_decode(spark, sf_dir):
    events = to_events(decode_log(_raw_log(spark, sf_dir), 5)[0], SOURCE_ID, DB)
    return events.select("source.filenum", "source.offset", F.col("pb_end.offset").alias("end_offset"), "source.exec_time_s", "command", "key")


@query(_with("""SELECT 'undecodable entry' AS reason, count(*) AS n FROM log WHERE id % 83 = 1 OR id % 89 = 1"""))
def q38_quarantine(spark, sf_dir):
    return decode_log(_raw_log(spark, sf_dir), 5)[1].groupBy("reason").agg(F.count("*").alias("n"))


@query(_with("""SELECT id // 500 AS batch, max(filenum) AS filenum, arg_max(off, id) AS "offset", count(*) AS n FROM log GROUP BY 1"""))
def q39_committed_position(spark, sf_dir):
    """Largest position of each batch."""
    log = command_log(spark, sf_dir)
    out = log.groupBy(F.expr("id div 500").alias("batch")).agg(F.max(position()).alias("p"), F.count("*").alias("n"))
    return out.select("batch", "p.filenum", "p.offset", "n")


@query(_with("""
SELECT 'user:' || user_id AS key, coalesce(arg_max(v, id) FILTER (f = 'name'), '') AS name, coalesce(arg_max(v, id) FILTER (f = 'tier'), '') AS tier
FROM cells JOIN (SELECT user_id, max(id) FILTER (event_type = 'error') AS wiped FROM log GROUP BY user_id) USING (user_id)
WHERE wiped IS NULL OR id > wiped GROUP BY user_id""", CELLS_SQL))
def q40_export_columns(spark, sf_dir):
    """Hash fields as columns, missing ones empty."""
    states = fold_states(log_events(spark, sf_dir).where(F.col("key").startswith("user:"))).where("typ = 'hash'")
    return states.select("key", *[F.coalesce(F.try_element_at("h", F.lit(f)), F.lit("")).alias(f) for f in ("name", "tier")])


@query(_with("""
, shapes AS (SELECT h.tab, h.pk, CASE WHEN h.wiped = h.last_id THEN '__DORIS_DELETE_SIGN__,uid' ELSE
    array_to_string(list_sort(list_append(list(l.f), CASE WHEN h.tab = 'ods_user' THEN 'uid' ELSE 'id' END)), ',') END AS shape
  FROM heads h LEFT JOIN live l USING (batch, tab, pk) GROUP BY h.tab, h.pk, h.wiped, h.last_id)
SELECT '/api/information_schema/' || tab || '/_stream_load' AS path, shape AS columns, 'keyflow-7-' || substr(md5('["","information_schema","' || tab || '","' || shape || '","0","0"]'), 1, 16) AS label, count(*) AS n
FROM shapes GROUP BY tab, shape""", CELLS_SQL, _KEYED % 10**15))
def q41_load_requests(spark, sf_dir):
    """Bulk-load requests of the whole log, one a table and shape."""
    requests = load_requests(batch_rows(log_events(spark, sf_dir), RULES), 7, chunk=10**9)
    return requests.select("path", "columns", "label", F.size(F.from_json("body", "array<map<string,string>>")).cast("bigint").alias("n"))


@query(_with(f"""SELECT 'inc:{SOURCE_ID}:' || filenum || ':' || off || ':0' AS event_id, key, command, exec_time_s FROM log"""))
def q42_wire_round_trip(spark, sf_dir):
    events = log_events(spark, sf_dir)
    back = from_json_lines(events.select(wire_json(events).alias("value")))
    return back.where("NOT malformed").select("event_id", "key", "command", "source.exec_time_s")


@query(ORACLES["q17_final_table"])
def q43_table_by_batches(spark, sf_dir):
    """The target after two batches applied one after the other: as after one."""
    rows = _rows(spark, sf_dir)
    none = rows.limit(0).select("table", "pk", "cols")
    middle = F.col("id") < 4321
    once = apply_to_table(none, coalesce_rows(rows.where(middle), ("table", "pk"), "id"), ("table", "pk"))
    twice = apply_to_table(once, coalesce_rows(rows.where(~middle), ("table", "pk"), "id"), ("table", "pk"))
    return _shown(twice).select("table", "pk", "cols")


@query("""
SELECT CASE WHEN c_custkey % 5 = 0 THEN 'HMSET' ELSE 'SET' END AS command, count(*) AS n, min('k:' || c_custkey) AS first_key FROM customer GROUP BY 1""")
def q44_striped_load(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    return to_events(workload.striped_load(spark, n), SOURCE_ID, DB).groupBy("command").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))


@query(_with("""SELECT key, count(*) AS n FROM log GROUP BY key HAVING count(*) >= 60"""))
def q45_busy_keys(spark, sf_dir):
    return log_events(spark, sf_dir).groupBy("key").agg(F.count("*").alias("n")).where("n >= 60")


@query(_with("""SELECT key, count(*) AS n FROM log WHERE CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 8 = 0 GROUP BY key"""))
def q47_sampled_keys(spark, sf_dir):
    """One key in eight, by hash."""
    return verify.sampled(log_events(spark, sf_dir), 8).groupBy("key").agg(F.count("*").alias("n"))


@query(_with("""SELECT exec_time_s // 3600 * 3600 AS start_s, count(*) AS n FROM log GROUP BY 1"""))
def q48_streamed_windows(spark, sf_dir):
    """Tumbling windows of the log as a stream."""
    timed = streamed_events(spark, sf_dir).withColumn("at", F.timestamp_seconds("source.exec_time_s")).withWatermark("at", "1 hour")
    counts = timed.groupBy(F.window("at", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    return collected(counts.select(F.unix_timestamp("w.start").alias("start_s"), "n"), "complete")


@query(_with("""SELECT id, key, command FROM log WHERE (filenum, pb_off) > (%d, %d)""" % ANCHOR))
def q49_streamed_gate(spark, sf_dir):
    """The stream after its anchor, each entry once although it comes twice."""
    e = streamed_events(spark, sf_dir).where(after_anchor(F.col("pb_end"), *ANCHOR))
    return collected(without_redeliveries(e.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))).select("id", "key", "command"))


@query("""
SELECT CASE WHEN user_id % 2 = 0 THEN '1,b=2' ELSE '1' END AS a, CASE user_id % 3 WHEN 0 THEN '3' WHEN 1 THEN '2,b=3' ELSE 'x=y:z' END AS b,
       CAST(max(event_id) AS VARCHAR) AS v, min(event_id) * 64 AS "first" FROM events GROUP BY ALL""")
def q50_composite_keys(spark, sf_dir):
    """Rows of two key columns whose values hold the signs that print them."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    a = F.when(F.col("user_id") % 2 == 0, "1,b=2").otherwise("1")
    b = F.when(F.col("user_id") % 3 == 0, "3").when(F.col("user_id") % 3 == 1, "2,b=3").otherwise("x=y:z")
    argv = F.array(F.lit("HSET"), F.concat(F.lit("k:"), a, F.lit(":"), b), F.lit("v"), F.col("event_id").cast("string"))
    log = ev.select(argv.cast("array<binary>").alias("argv"), F.lit(1).alias("filenum"), (F.col("event_id") * 64).alias("offset"), F.lit(0).alias("seq"), F.lit(0).alias("exec_time_s"))
    rows = batch_rows(to_events(log, SOURCE_ID, DB), [Rule("t", ["a", "b"], ["hash"], "k:{a}:{b}")])
    return rows.select(F.col("pk")["a"].alias("a"), F.col("pk")["b"].alias("b"), F.col("cols")["v"].alias("v"), F.col("first.offset").alias("first"))


@query(_with("""SELECT key, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM log GROUP BY key"""))
def q51_streamed_late_files(spark, sf_dir):
    """The log as a stream of several batches: the newest entries come first, the oldest
    last, some entries twice. Each counts once, none is too late."""
    place = f"{shared_dir(spark)}/keyflow-{uuid.uuid4().hex}/late"
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i, part in enumerate(("event_id % 3 = 2", "event_id % 3 >= 1", "event_id % 3 = 0 AND event_id >= 500", "event_id < 600")):
        ev.where(part).coalesce(1).write.parquet(f"{place}/{i}")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(place)
    once = collected(without_redeliveries(to_events(log_of(stream), SOURCE_ID, DB)).select("key", "id"))
    return once.groupBy("key").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(_with("""
, shapes AS (SELECT DISTINCT CASE WHEN event_type = 'purchase' THEN 'ods_account' ELSE 'ods_user' END AS tab, event_type FROM log)
SELECT '/api/information_schema/' || tab || '/_stream_load' AS path, 4 * count(*) AS requests, 4 * count(*) AS labels FROM shapes GROUP BY tab"""))
def q52_load_labels(spark, sf_dir):
    """The same batch number of two sources and two checkpoints: no label repeats."""
    mapped = map_events(log_events(spark, sf_dir), RULES)
    rows = rows_of(mapped).select("table", key_of(F.col("pk")).alias("pk_key"), "pk", "cols", "del", F.struct("filenum", "offset", "seq").alias("last"))
    every = None
    for source, run in (("a:1", "r1"), ("a:1", "r2"), ("b:1", "r1"), ("b:1", "r2")):
        some = load_requests(rows, -1, chunk=10**9, run=run, source_id=source).select("path", "label")
        every = some if every is None else every.unionByName(some)
    return every.groupBy("path").agg(F.count("*").alias("requests"), F.countDistinct("label").alias("labels"))
