"""More registered queries: one for each smaller part of the engine, with its oracle."""

from __future__ import annotations

import sqlite3
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from keyflow.functions.decode import decode_log, resp_bytes
from keyflow.functions.envelope import described, to_events
from keyflow.functions.info import replication_status
from keyflow.functions.position import fnv1a, route
from keyflow.operators import verify
from keyflow.operators.rules import Rule, map_events, rendered
from keyflow.operators.snapshot import scan, snapshot_events
from keyflow.operators.state import canonical, fold_states
from keyflow.plans.catalog import _STATES, ORACLES, USERS, _states, _with, query
from keyflow.plans.commandlog import ANCHOR, CELLS_SQL, DB, SOURCE_ID, command_log, log_events, snapshot_state
from keyflow.sources import files, log_source, workload
from keyflow.sources.capture import capture
from keyflow.sources.shared import shared_dir
from keyflow.streaming import runner, sinks

WATCH = "user:0-200:4:40"


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/keyflow-{uuid.uuid4().hex}/{name}"


@query(_with("""SELECT id, filenum, off AS "offset", CASE WHEN id % 3 = 2 THEN greatest(id % 7, id % 5) ELSE id % 50 END AS lag FROM log"""))
def q53_status_text(spark, sf_dir):
    """Position and lag from the three forms of a status text."""
    log = command_log(spark, sf_dir)
    n = lambda c: c.cast("string")
    f, o, i = n(F.col("filenum")), n(F.col("offset")), F.col("id")
    own = F.concat(F.lit("\r\nmaster_lag:"), n(i % 50))
    text = (
        F.when(i % 3 == 0, F.concat(F.lit("# Replication\r\nbinlog_offset:"), f, F.lit(" "), o, own))
        .when(i % 3 == 1, F.concat(F.lit("some=thing binlog_offset="), f, F.lit(","), o, F.lit(" other"), own))
        .otherwise(F.concat(F.lit("binlog_file_num: "), f, F.lit("\nbinlog_offset: "), o, F.lit("\ndb0 lag=("), n(i % 7), F.lit(", "), n(i % 5), F.lit(")")))
    )
    return log.select("id", replication_status(text).alias("s")).select("id", "s.filenum", "s.offset", "s.lag")


@query(_with("""SELECT filenum, max(CASE WHEN id % 3 = 2 THEN greatest(id % 7, id % 5) ELSE id % 50 END) AS max_lag FROM log GROUP BY filenum"""))
def q54_max_lag(spark, sf_dir):
    """The largest lag of each file's statuses."""
    return q53_status_text(spark, sf_dir).groupBy("filenum").agg(F.max("lag").alias("max_lag"))


@query(_with("""
SELECT id, CASE event_type WHEN 'signup' THEN 'upsert' ELSE 'error' END AS action, CASE event_type WHEN 'signup' THEN 'u' || user_id END AS name,
       CASE event_type WHEN 'signup' THEN NULL ELSE 'no value for key column name' END AS error FROM log WHERE event_type <> 'purchase'"""))
def q55_key_from_fields(spark, sf_dir):
    """Without a pattern, key columns come from the hash's fields; without one, an error."""
    mapped = map_events(log_events(spark, sf_dir), [Rule("t", ["name"], ["hash"])]).where("row IS NOT NULL")
    return mapped.select("id", "row.action", F.col("row.pk")["name"].alias("name"), "row.error")


@query(_with("""SELECT id, CAST(user_id AS VARCHAR) AS uid, 'clicks=\\N,tier=\\N' AS cols FROM log WHERE event_type = 'click'"""))
def q56_removed_fields(spark, sf_dir):
    """HDEL clears its columns."""
    log = command_log(spark, sf_dir)
    hdel = F.array(F.lit("HDEL").cast("binary"), F.element_at("argv", 2), F.lit("clicks").cast("binary"), F.lit("tier").cast("binary"))
    is_click = (F.size("argv") == 4) & (F.try_element_at("argv", F.lit(3)).cast("string") == "clicks")
    mapped = map_events(to_events(log.where(is_click).withColumn("argv", hdel), SOURCE_ID, DB), [USERS])
    return mapped.select("id", F.col("row.pk")["uid"].alias("uid"), rendered(F.col("row.cols")).alias("cols"))


@query(_with("""
SELECT id, CASE WHEN id % 3 = 0 THEN 'skip' ELSE 'upsert' END AS action,
       CASE WHEN id % 3 = 0 THEN NULL ELSE '{"balance":' || amount || ',"k":' || k || '}' END AS v FROM log WHERE event_type = 'purchase'"""))
def q57_string_values(spark, sf_dir):
    """The value of SET and SETEX; other string commands have none."""
    log = command_log(spark, sf_dir).where(F.element_at("argv", 1).cast("string") == "SET")
    b = lambda s: F.lit(s).cast("binary")
    key, value = F.element_at("argv", 2), F.element_at("argv", 3)
    argv = F.when(F.col("id") % 3 == 0, F.array(b("APPEND"), key, value)).when(F.col("id") % 3 == 1, F.array(b("SETEX"), key, b("60"), value)).otherwise(F.col("argv"))
    mapped = map_events(to_events(log.withColumn("argv", argv), SOURCE_ID, DB), [Rule("t", ["id"], ["string"], "acct:{id}", value_column="v")])
    return mapped.select("id", "row.action", F.col("row.cols")["v"].alias("v"))


@query("""
SELECT 'SET' AS command, 'r' AS op, count(*) AS n, min('snapshot:node-a:9221:db0:string:nation:' || n_nationkey || ':SET') AS first_id FROM nation
UNION ALL SELECT 'HMSET', 'r', count(*), min('snapshot:node-a:9221:db0:hash:cust:' || c_custkey || ':HMSET') FROM customer
UNION ALL SELECT 'EXPIRE', 'u', count(*), min('snapshot:node-a:9221:db0:unknown:cust:' || c_custkey || ':EXPIRE') FROM customer WHERE c_custkey % 10 = 0""")
def q58_snapshot_ops(spark, sf_dir):
    """Operations and identities of snapshot events."""
    events = snapshot_events(scan(snapshot_state(spark, sf_dir)), ANCHOR, SOURCE_ID)
    return events.groupBy("command", "op").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(_with("""
SELECT false AS kept, 'incremental' AS phase, count(*) AS n FROM log UNION ALL SELECT true, 'incremental', count(*) FROM log UNION ALL SELECT true, 'heartbeat', 1"""))
def q59_heartbeats(spark, sf_dir):
    """A batch with a heartbeat, as sinks deliver it without and with heartbeats."""
    batch = runner.with_heartbeat(log_events(spark, sf_dir), runner.Control("", SOURCE_ID), (1, 2))
    out = [sinks.deliverable(batch, kept).groupBy("phase").agg(F.count("*").alias("n")).select(F.lit(kept).alias("kept"), "phase", "n") for kept in (False, True)]
    return out[0].unionByName(out[1])


@query(_with(f"""SELECT id, 'incremental ' || op || ' {DB}/' || data_type || '/' || key || ' ' || command || ' @' || filenum || ':' || off || '#0' AS line FROM log"""))
def q60_described(spark, sf_dir):
    events = log_events(spark, sf_dir)
    return events.select("id", described(events).alias("line"))


@query(_with("""SELECT filenum, off AS "offset", pb_off AS end_offset, command, key FROM log WHERE id % 41 <> 0"""))
def q61_truth_scan(spark, sf_dir):
    """An independent capture, written as its lines and read again."""
    place = _place(spark, "truth")
    rows = log_events(spark, sf_dir).select(
        F.col("source.filenum").alias("f"), F.col("source.offset").alias("o"), F.col("source.filenum").alias("pef"), F.col("end").alias("peo"), F.lower("command").alias("cmd"), "key",
        F.size("args").alias("argc"), F.when(F.col("id") % 41 == 0, "torn").alias("bad"),
    )
    rows.write.json(place)
    return files.read_truth(spark, place).select("filenum", "offset", "end_offset", "command", "key")


@query(_with("""
, keys AS (SELECT DISTINCT key FROM log),
hashed AS (SELECT key, list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda h, b: (xor(h, b) * 16777619) % 4294967296) AS h FROM keys)
SELECT key, h AS hash, CAST(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 16 AS INTEGER) AS part FROM hashed"""))
def q62_routes(spark, sf_dir):
    """The topic partition of each key, by FNV-1a."""
    keys = log_events(spark, sf_dir).select("key").distinct()
    return keys.select("key", fnv1a(F.col("key")).alias("hash"), route(F.col("key"), 16).alias("part"))


@query(_with("""SELECT key, count(*) AS n, min(id) AS first_id FROM log GROUP BY key"""))
def q63_written_lines(spark, sf_dir):
    """Events through the file sink and back."""
    place = _place(spark, "lines")
    sinks.write_lines(log_events(spark, sf_dir), place)
    back = files.read_events(spark, place).where("NOT malformed")
    ident = F.col("source.filenum") * 1000 + F.expr("source.offset div 64")
    return back.groupBy("key").agg(F.count("*").alias("n"), F.min(ident).alias("first_id"))


@query(_with("""
, heads AS (SELECT user_id, max(id) AS last_id, max(id) FILTER (event_type = 'error') AS wiped FROM log WHERE event_type <> 'purchase' GROUP BY user_id)
SELECT CAST(h.user_id AS VARCHAR) AS uid, arg_max(v, id) FILTER (f = 'name') AS name, arg_max(v, id) FILTER (f = 'tier') AS tier,
       arg_max(v, id) FILTER (f = 'last_view') AS last_view, arg_max(v, id) FILTER (f = 'clicks') AS clicks
FROM heads h JOIN cells c USING (user_id) WHERE wiped IS NULL OR id > wiped GROUP BY h.user_id""", CELLS_SQL))
def q64_sql_rows(spark, sf_dir):
    """The log in two batches through the SQL sink into a database, and its table."""
    names = ("uid", "name", "tier", "last_view", "clicks")
    fs, path = pafs.FileSystem.from_uri(_place(spark, "sql"))
    fs.create_dir(path, recursive=True)
    db = f"{path}/t.db"
    with sqlite3.connect(db) as c:
        c.execute(f"CREATE TABLE ods_user ({', '.join(f'{n} TEXT' for n in names)}, PRIMARY KEY (uid))")
    events = log_events(spark, sf_dir)
    for part in ("id < 4321", "id >= 4321"):
        # One writer at a time is what this database takes.
        sinks.write_sql(sinks.batch_rows(events.where(part), [USERS]).coalesce(1), sinks.Connector("sqlite3", db), "sqlite")
    with sqlite3.connect(db) as c:
        rows = c.execute(f"SELECT {', '.join(names)} FROM ods_user").fetchall()
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


@query(_with("""
SELECT 'left' AS side, 1 AS n, 'user:' || s.user_id AS key, s.state FROM src s LEFT JOIN tgt t USING (user_id) WHERE s.state IS DISTINCT FROM t.state
UNION ALL SELECT 'right', 1, 'user:' || t.user_id, t.state FROM tgt t LEFT JOIN src s USING (user_id) WHERE s.state IS DISTINCT FROM t.state""", CELLS_SQL, _STATES))
def q65_export_difference(spark, sf_dir):
    return verify.export_difference(*_states(spark, sf_dir)).select("side", F.col("n").cast("int").alias("n"), "key", "state")


@query(_with(f"""
SELECT filenum, count(*) AS entries, min(off) AS "first", max(off) AS "last" FROM log WHERE (filenum, off) > ({ANCHOR[0]}, {ANCHOR[1]}) GROUP BY filenum"""))
def q66_backlog_tail(spark, sf_dir):
    return verify.backlog_tail(command_log(spark, sf_dir), ANCHOR)


@query(_with("""
, wanted AS (SELECT i, 'user:' || i AS key FROM range(0, 201) r(i) WHERE i % 4 <> 0),
counts AS (SELECT key, count(*) AS n FROM log GROUP BY key)
SELECT w.key, coalesce(n, 0) AS n, coalesce(n, 0) >= 40 AS ok, 'hash{' || s.state || '}' AS model, 'hash{' || t.state || '}' AS live, s.state IS NOT DISTINCT FROM t.state AS agrees
FROM wanted w LEFT JOIN counts c ON c.key = w.key LEFT JOIN src s ON s.user_id = w.i LEFT JOIN tgt t ON t.user_id = w.i""", CELLS_SQL, _STATES))
def q67_three_way(spark, sf_dir):
    """Watched keys against the replayed model and against what another store holds."""
    live = _states(spark, sf_dir)[1].select("key", F.concat(F.lit("hash{"), "state", F.lit("}")).alias("state"))
    return verify.three_way(spark, log_events(spark, sf_dir), verify.Watch.parse(WATCH), live).select("key", "n", "ok", "model", "live", "agrees")


@query(ORACLES["q40_export_columns"])
def q68_exported_text(spark, sf_dir):
    """Hash fields through the text export and back."""
    place = _place(spark, "tsv")
    sinks.export_tsv(fold_states(log_events(spark, sf_dir)), place, "user:", ["name", "tier"])
    return spark.read.schema("key string, name string, tier string").option("sep", "\t").csv(place).na.fill("")


@query("""
SELECT CASE WHEN i % 10 = 9 THEN 'DEL' WHEN i % 3 = 0 THEN 'HSET' ELSE 'SET' END AS command, count(*) AS n,
       count(DISTINCT CASE WHEN i % 10 = 9 THEN 'k:' || (((i - 9) * 7) % m) WHEN i % 3 = 0 THEN 'h:' || ((i * 7) % m) ELSE 'k:' || ((i * 7) % m) END) AS keys, min(i * 64 % 67108864) AS first_offset
FROM (SELECT unnest(range(0, count(*) * 10)) AS i, count(*) AS m FROM customer) GROUP BY 1""")
def q69_mutations(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    events = to_events(workload.mutations(spark, n * 10, n), SOURCE_ID, DB)
    return events.groupBy("command").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"), F.min("source.offset").alias("first_offset"))


def _captured(spark, sf_dir) -> str:
    """The log as a directory of binary files, as a capture leaves it."""
    place = _place(spark, "log")

    def run(batches):
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                fs, root = pafs.FileSystem.from_uri(place)
                fs.create_dir(root, recursive=True)
                with fs.open_output_stream(f"{root}/{r['filenum']}") as out:
                    for e in r["entries"]:
                        content = resp_bytes(e["argv"])
                        entry = struct.pack("<HIIQIQI", 1, e["exec_time_s"], 1, e["id"], r["filenum"], e["offset"], len(content)) + content
                        # Every tenth frame is followed by a keepalive, which carries nothing.
                        out.write(log_source.frame(r["filenum"], e["end"], 5, entry) + (log_source.frame(r["filenum"], e["end"], 5, b"") if e["id"] % 10 == 0 else b""))
                done.append(r["filenum"])
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["filenum"])

    # A file of the log holds a thousand entries.
    entries = F.array_sort(F.collect_list(F.struct("offset", "id", "end", "exec_time_s", "argv"))).alias("entries")
    command_log(spark, sf_dir).groupBy("filenum").agg(entries).mapInArrow(run, "filenum bigint").agg(F.count("*")).collect()
    return place


@query(_with(f"""SELECT 'inc:{SOURCE_ID}:' || filenum || ':' || off || ':0' AS event_id, key, command, pb_off AS end_offset, exec_time_s FROM log"""))
def q70_captured_log(spark, sf_dir):
    """Binary files of a capture, through the log source and the decoder."""
    log_source.register(spark)
    raw = spark.read.format("keyflow_log").load(_captured(spark, sf_dir))
    events = to_events(decode_log(raw, 5)[0], SOURCE_ID, DB)
    return events.select("event_id", "key", "command", F.col("pb_end.offset").alias("end_offset"), "source.exec_time_s")


@query(_with(f"""SELECT key, count(*) AS n, min(filenum) AS first_file FROM log WHERE (filenum, pb_off) > ({ANCHOR[0]}, {ANCHOR[1]}) GROUP BY key"""))
def q71_streamed_log(spark, sf_dir):
    """The same files as streams from the anchor on, in batches of bounded bytes."""
    control = runner.Control("", SOURCE_ID, ANCHOR)
    lanes = runner.log_lanes(spark, _captured(spark, sf_dir), control, DB, max_bytes=500_000, session_id=5)
    return runner.collected([events.select("key", "source.filenum") for events in lanes], bounded=True).groupBy("key").agg(F.count("*").alias("n"), F.min("filenum").alias("first_file"))


@query("""
SELECT 'reg:' || r_regionkey AS key, 'RPUSH' AS command, array_to_string(list_slice(list(n_name ORDER BY n_nationkey), -2, -1), ',') AS members
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey""")
def q72_list_tail(spark, sf_dir):
    """The last elements of lists."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    members = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    lists = nation.groupBy("n_regionkey").agg(members.alias("l")).select(
        F.concat(F.lit("reg:"), F.col("n_regionkey").cast("string")).alias("key"), F.lit("list").alias("typ"), F.lit(None).cast("string").alias("s"), F.lit(None).cast("map<string,string>").alias("h"),
        "l", F.lit(None).cast("array<string>").alias("st"), F.lit(None).cast("map<string,double>").alias("z"), F.lit(0).cast("bigint").alias("ttl"),
    )
    return scan(lists, list_tail=2).select("key", F.element_at("argv", 1).alias("command"), F.array_join(F.slice("argv", 3, 2), ",").alias("members"))


@query("""
WITH n AS (SELECT count(*) AS m FROM customer), ids AS (SELECT unnest(range(0, m * 10)) AS id, m FROM n),
h AS (SELECT id, m, CAST('0x' || substr(md5('42:' || id), 1, 8) AS BIGINT) % 100 AS roll, CAST('0x' || substr(md5('43:' || id), 1, 8) AS BIGINT) % m AS k,
             'm' || (CAST('0x' || substr(md5('44:' || id), 1, 8) AS BIGINT) % 8) AS member FROM ids),
log AS (
  SELECT id, k, member, CASE WHEN roll < 25 THEN 'SET' WHEN roll < 45 THEN 'HSET' WHEN roll < 50 THEN 'HDEL' WHEN roll < 60 THEN 'RPUSH' WHEN roll < 65 THEN 'LPOP'
    WHEN roll < 75 THEN 'SADD' WHEN roll < 80 THEN 'SREM' WHEN roll < 90 THEN 'ZADD' WHEN roll < 95 THEN 'DEL' ELSE 'EXPIRE' END AS c FROM h),
keyed AS (SELECT *, CASE WHEN c IN ('SET', 'EXPIRE') THEN 'str:' WHEN c IN ('HSET', 'HDEL', 'DEL') THEN 'hsh:' WHEN c IN ('RPUSH', 'LPOP') THEN 'lst:' WHEN c IN ('SADD', 'SREM') THEN 'set:' ELSE 'zst:' END || k AS key FROM log),
wiped AS (SELECT key, max(id) AS w FROM keyed WHERE c = 'DEL' GROUP BY key),
cells AS (SELECT key, member, arg_max(c, id) AS c, max(id) AS id FROM keyed LEFT JOIN wiped USING (key) WHERE c IN ('HSET', 'HDEL', 'SADD', 'SREM', 'ZADD') AND (w IS NULL OR id > w) GROUP BY key, member),
pushed AS (SELECT key, id, c, sum(CASE c WHEN 'RPUSH' THEN 1 ELSE -1 END) OVER (PARTITION BY key ORDER BY id) AS s FROM keyed WHERE c IN ('RPUSH', 'LPOP')),
sizes AS (SELECT key, arg_max(s, id) - least(0, min(s)) AS size FROM pushed GROUP BY key),
kept AS (SELECT key, p.id FROM (SELECT key, id, row_number() OVER (PARTITION BY key ORDER BY id DESC) AS r FROM pushed WHERE c = 'RPUSH') p JOIN sizes USING (key) WHERE r <= size),
states AS (
  SELECT key, 'string' AS typ, 'string:' || max(id) AS state FROM keyed WHERE c = 'SET' GROUP BY key
  UNION ALL SELECT key, 'hash', 'hash{' || string_agg(member || '=' || id, ',' ORDER BY member) || '}' FROM cells WHERE c = 'HSET' GROUP BY key
  UNION ALL SELECT key, 'set', 'set{' || string_agg(member, ',' ORDER BY member) || '}' FROM cells WHERE c = 'SADD' GROUP BY key
  UNION ALL SELECT key, 'zset', 'zset{' || string_agg(member || '=' || (id % 50) || '.0', ',' ORDER BY member) || '}' FROM cells WHERE c = 'ZADD' GROUP BY key
  UNION ALL SELECT key, 'list', 'list[' || string_agg(id, ',' ORDER BY id) || ']' FROM kept GROUP BY key),
counts AS (SELECT key, count(*) AS events FROM keyed GROUP BY key)
SELECT key, coalesce(typ, 'none') AS typ, coalesce(state, 'none') AS state, events FROM counts LEFT JOIN states USING (key)""")
def q46_churn_states(spark, sf_dir):
    """States after a random storm of ten commands, all five types."""
    n = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    folded = fold_states(to_events(workload.churn(spark, n * 10, n), SOURCE_ID, DB))
    return folded.select("key", "typ", canonical(folded).alias("state"), "events")


@query("""
SELECT * FROM (VALUES ('p:1', 'string', 1), ('p:3', 'string', 1), ('p:4', 'hash', 1), ('p:5', 'hash', 2)) t(key, kind, n)""")
def q73_probe(spark, sf_dir):
    """A handful of commands of each delicate kind, by key."""
    events = to_events(workload.probe(spark), SOURCE_ID, DB)
    return events.groupBy("key").agg(F.min("data_type").alias("kind"), F.count("*").cast("int").alias("n"))


@query(_with("""
SELECT id, CASE WHEN id % 83 = 1 THEN NULL ELSE off END AS "offset", pb_off AS end_offset, CASE WHEN id % 83 = 1 THEN 'short' WHEN id % 89 = 1 THEN 'length' END AS bad,
       CASE WHEN id % 83 = 1 OR id % 89 = 1 THEN NULL ELSE command END AS command FROM log"""))
def q74_independent_capture(spark, sf_dir):
    """Entries read a second time by other means, damaged ones with their reason; the
    entries' places come from the frames around them."""
    from keyflow.plans.catalog import _raw_log

    truth = capture(_raw_log(spark, sf_dir).withColumn("binlog", F.when(F.octet_length("binlog") == 40, F.substring("binlog", 1, 30)).otherwise(F.col("binlog"))))
    ident = F.col("pef") * 1000 + F.expr("peo div 64") - 1
    return truth.select(ident.alias("id"), F.col("o").alias("offset"), F.col("peo").alias("end_offset"), "bad", F.col("cmd").alias("command"))


@query(_with("""
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN id % 83 = 1 OR id % 89 = 1 THEN 'unread' ELSE 'ok' END AS kind FROM log) GROUP BY kind"""))
def q75_decoders_agree(spark, sf_dir):
    """Events of the decoder against the independent reading, by position."""
    from keyflow.plans.catalog import _raw_log

    raw = _raw_log(spark, sf_dir)
    events = to_events(decode_log(raw, 5)[0], SOURCE_ID, DB).select("source.filenum", "source.offset", "command", "key")
    truth = capture(raw)
    read = truth.where("bad IS NULL").select(F.col("f").alias("filenum"), F.col("o").alias("offset"), F.col("cmd").alias("command"), "key")
    found = verify.audit(read, events).groupBy("kind").agg(F.count("*").alias("n"))
    return found.unionByName(truth.where("bad IS NOT NULL").agg(F.count("*").alias("n")).select(F.lit("unread").alias("kind"), "n"))


@query("""
SELECT phase, command, count(*) AS n, min(b) AS first_batch FROM (
  SELECT 'snapshot' AS phase, 'SET' AS command, -1 AS b FROM nation UNION ALL SELECT 'snapshot', 'HMSET', -3 FROM customer
  UNION ALL SELECT 'snapshot', 'EXPIRE', -3 FROM customer WHERE c_custkey % 10 = 0) GROUP BY phase, command""")
def q76_resumed_snapshot(spark, sf_dir):
    """A snapshot job that fails after its first type goes on with the next."""
    place, out = _place(spark, "control"), _place(spark, "out")

    def sink(batch, number):
        if number == -3 and not failed:
            failed.append(number)
            raise RuntimeError("cut short")
        batch.select("phase", "command", F.lit(number).alias("b")).write.mode("append").parquet(out)

    failed = []
    for _ in range(2):
        control = runner.Control(place, SOURCE_ID).load()
        try:
            runner.run_snapshot(snapshot_state(spark, sf_dir), control, ANCHOR, sink)
        except RuntimeError:
            pass
    return spark.read.parquet(out).groupBy("phase", "command").agg(F.count("*").alias("n"), F.min("b").alias("first_batch"))
