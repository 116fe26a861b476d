import json
import sqlite3
import struct
import threading
import urllib.request
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from keyflow import __main__, config, tools
from keyflow.functions.decode import resp_bytes
from keyflow.functions.envelope import EVENT, to_events
from keyflow.operators.rules import Rule
from keyflow.operators.state import fold_states
from keyflow.sources import files, log_source, workload
from keyflow.streaming import runner, sinks, stateful
from keyflow.streaming.dialects import dialect, parsed_dsn

USERS = Rule("ods_user", ["uid"], ["hash"], "user:{uid}", {"name": "name", "age": "age"})


def frames(commands, filenum=1, start=0):
    out = b""
    for i, argv in enumerate(commands, start):
        content = resp_bytes([a.encode() for a in argv])
        entry = struct.pack("<HIIQIQI", 1, 1700000000 + i, 1, i, filenum, 100 * i, len(content)) + content
        out += log_source.frame(filenum, 100 * (i + 1), 5, entry)
    return out


def test_dialects():
    assert dialect("postgres").upsert("public.ods_user", ["uid"], ["name", "age", "uid"]) == (
        'INSERT INTO public.ods_user ("uid", "name", "age") VALUES ($1, $2, $3) ON CONFLICT ("uid") DO UPDATE SET "name" = EXCLUDED."name", "age" = EXCLUDED."age"'
    )
    assert dialect("mysql").upsert("t", ["a"], ["b"]) == "INSERT INTO t (`a`, `b`) VALUES (?, ?) ON DUPLICATE KEY UPDATE `b` = VALUES(`b`)"
    assert dialect("pgx").delete("t", ["a", "b"]) == 'DELETE FROM t WHERE "a" = $1 AND "b" = $2'
    with pytest.raises(ValueError):
        dialect("other")
    assert dialect("postgres", "pyformat").delete("t", ["a%", "b"]) == 'DELETE FROM t WHERE "a%%" = %s AND "b" = %s'
    assert dialect("mysql", "format").upsert("t", ["a"], ["b"]).startswith("INSERT INTO t (`a`, `b`) VALUES (%s, %s)") and dialect("sqlite", "numeric").delete("t", ["a"]).endswith('"a" = :1')
    assert parsed_dsn("u:p@s@tcp(db.host:3307)/shop?tls=true") == {"host": "db.host", "port": 3307, "user": "u", "password": "p@s", "database": "shop"}
    assert parsed_dsn("mysql://u:p%40s@h/d") == {"host": "h", "user": "u", "password": "p@s", "database": "d"} and parsed_dsn("tcp(h)/d") == {"host": "h", "database": "d"}


STUB = """
import sqlite3
paramstyle = "{style}"


class Cursor:
    def __init__(self, inner):
        self.inner = inner

    def execute(self, sql, values):
        assert "?" not in sql and "$1" not in sql and sql.count("%s") == len(values)
        self.inner.execute(sql.replace("%s", "?").replace("%%", "%"), values)


class Connection:
    def __init__(self, path):
        self.inner = sqlite3.connect(path, timeout=30)

    def cursor(self):
        return Cursor(self.inner.cursor())

    def __getattr__(self, name):
        return getattr(self.inner, name)


def connect(dsn=None, **parts):
    return Connection(dsn or "/" + parts["database"])
"""


@pytest.mark.parametrize("module, kind, style", [("pgstub", "postgres", "pyformat"), ("pymysql", "mysql", "format")])
def test_sql_sinks_speak_the_drivers_marks(spark, tmp_path, monkeypatch, module, kind, style):
    """Modules that take only their own parameter marks, one of them connection parts by
    name. (SQLite understands the upsert of one dialect, so the other only deletes.)"""
    (tmp_path / f"{module}.py").write_text(STUB.replace("{style}", style))
    monkeypatch.syspath_prepend(str(tmp_path))
    db = tmp_path / "t.db"
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE t (a TEXT, b TEXT, v TEXT, PRIMARY KEY (a, b))")
        c.execute("INSERT INTO t VALUES ('1', '2', 'old'), ('3', '4', 'stays')")
    gone = [["DEL", "k:1:2"]] if kind == "mysql" else [["HSET", "k:1:2", "v", "new"], ["HSET", "k:5:6", "v", "x"]]
    rows = sinks.batch_rows(log_of(spark, gone), [Rule("t", ["a", "b"], ["hash"], "k:{a}:{b}")]).coalesce(1)
    dsn = f"mysql://u@h{db}" if kind == "mysql" else str(db)
    connector = sinks.Connector(module, dsn)

    def connect(path=str(tmp_path)):  # the tasks' processes do not know the test's path
        import sys

        sys.path.insert(0, path)
        return connector()

    sinks.write_sql(rows, connect, kind, paramstyle=connector.paramstyle)
    left = sqlite3.connect(db).execute("SELECT * FROM t ORDER BY a").fetchall()
    assert left == ([("3", "4", "stays")] if kind == "mysql" else [("1", "2", "new"), ("3", "4", "stays"), ("5", "6", "x")])


def log_of(spark, commands):
    log = spark.createDataFrame([(3, 40 * (i + 1), 0, 0, c) for i, c in enumerate(commands)], "filenum bigint, offset bigint, seq bigint, exec_time_s bigint, argv array<string>")
    return to_events(log.withColumn("argv", F.col("argv").cast("array<binary>")), "s")


def test_composite_keys_stay_apart(spark):
    rule = Rule("t", ["a", "b"], ["hash"], "k:{a}:{b}")
    rows = sinks.batch_rows(log_of(spark, [["HSET", "k:1,b=2:3", "v", "x"], ["HSET", "k:1:2,b=3", "v", "y"]]), [rule]).collect()
    assert {(r.pk["a"], r.pk["b"], r.cols["v"]) for r in rows} == {("1,b=2", "3", "x"), ("1", "2,b=3", "y")}


def test_unmappable_events_fail_the_batch(spark):
    rows = sinks.batch_rows(log_of(spark, [["HSET", "any", "x", "1"]]), [Rule("t", ["id"], ["hash"])])
    with pytest.raises(Exception, match="cannot be mapped: any: no value for key column id"):
        rows.collect()


def test_load_chunks_and_labels(spark):
    rows = sinks.batch_rows(log_of(spark, [["HSET", f"user:{i}", "name", "x"] for i in range(57)]), [USERS])
    some = lambda **o: sinks.load_requests(rows, -1, chunk=10, **o).select("label", "body").collect()
    one = some(run="r1", source_id="a")
    assert max(len(json.loads(r.body)) for r in one) <= 10 and sum(len(json.loads(r.body)) for r in one) == 57
    assert sorted(one) == sorted(some(run="r1", source_id="a"))
    labels = [r.label for options in ({"run": "r1", "source_id": "a"}, {"run": "r2", "source_id": "a"}, {"run": "r1", "source_id": "b"}) for r in some(**options)]
    assert len(set(labels)) == len(labels)


def test_loads_pass_over_dead_nodes(spark, monkeypatch):
    asked = []

    def send(node, r, *_):
        asked.append(node)
        if node == "dead":
            raise ConnectionRefusedError(node)

    monkeypatch.setattr(sinks, "send_load", send)
    requests = spark.createDataFrame([("p", "l")], "path string, label string")
    sent = sinks.send_to_nodes
    assert sent(["dead", "alive"], requests.collect()[0].asDict(), 0, "u", "", 1.0) is None and asked == ["dead", "alive"]
    with pytest.raises(ConnectionRefusedError):
        sent(["dead"], {}, 0, "u", "", 1.0)


def test_log_source_batch(spark, tmp_path):
    log_source.register(spark)
    data = frames([["SET", "a", "1"], ["DEL", "a"]])
    (tmp_path / "1").write_bytes(data + data[:10])  # a torn frame at the end
    (tmp_path / "2").write_bytes(frames([["SET", "b", "2"]], 2))
    (tmp_path / "notes.txt").write_text("no log")
    rows = spark.read.format("keyflow_log").load(f"file://{tmp_path}").orderBy("pb_filenum", "pb_offset").collect()
    assert [(r.pb_filenum, r.pb_offset) for r in rows] == [(1, 100), (1, 200), (2, 100)]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert spark.read.format("keyflow_log").load(f"file://{empty}").count() == 0


def test_stream_to_table_with_restart(spark, tmp_path):
    logs, state, db = tmp_path / "log", tmp_path / "check", tmp_path / "t.db"
    logs.mkdir()
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE ods_user (uid TEXT PRIMARY KEY, name TEXT, age TEXT)")
    first = [["HSET", "user:1", "name", "old"], ["HMSET", "user:2", "name", "b", "age", "2"], ["HMSET", "user:1", "name", "a", "age", "1"], ["DEL", "user:2"]]
    (logs / "1").write_bytes(frames(first))
    control = runner.Control(f"file://{state}", "node").load()
    control.anchor = (1, 100)
    control.save()
    connect, fail = sinks.Connector("sqlite3", str(db)), []

    def sink(batch, number):
        sinks.write_sql(sinks.batch_rows(batch, [USERS]), connect, "sqlite")
        if fail:
            fail.pop()
            raise RuntimeError("lost after the write")

    def run():
        return runner.start(runner.log_stream(spark, f"file://{logs}", control, max_bytes=200), sink, str(state / "stream"), trigger=None)

    fail.append(1)
    runner.drain(run, pause=0.1)
    read = lambda: sqlite3.connect(db).execute("SELECT * FROM ods_user ORDER BY uid").fetchall()
    assert read() == [("1", "a", "1")]
    with (logs / "1").open("ab") as f:
        f.write(frames([["HSET", "user:3", "age", "9"], ["HSET", "user:2", "name", "back"]], start=4))
    runner.drain(run)
    assert read() == [("1", "a", "1"), ("2", "back", None), ("3", None, "9")]
    with pytest.raises(runner.SourceMismatch):
        runner.Control(f"file://{state}", "other").load()


def test_snapshot_job(spark, tmp_path):
    schema = "key string, typ string, s string, h map<string,string>, l array<string>, st array<string>, z map<string,double>, ttl bigint"
    state = spark.createDataFrame([("k", "string", "v", None, None, None, None, 0)], schema)
    control, seen = runner.Control(f"file://{tmp_path}", "n").load(), []
    runner.run_snapshot(state, control, (3, 9), lambda batch, n: seen.append((n, batch.count())))
    runner.run_snapshot(state, control, (3, 9), lambda batch, n: seen.append((n, batch.count())))
    assert seen == [(-1, 1)] and runner.Control(f"file://{tmp_path}", "n").load().snapshot_done


def test_replay_stream(spark, tmp_path):
    e = to_events(workload.churn(spark, 120, 5), "s").select(*[f.name for f in EVENT.fields])
    parts = [e.where("source.offset < 3000"), e.where("source.offset >= 2000")]  # they overlap
    source = tmp_path / "in"
    for i, p in enumerate(parts):
        p.coalesce(1).write.json(str(tmp_path / f"part{i}"))
    got = {}
    source.mkdir()

    def keep(batch, _):
        got.update({r.key: r.events for r in batch.collect()})

    for i in range(len(parts)):
        for f in (tmp_path / f"part{i}").glob("*.json"):
            f.rename(source / f"{i}-{f.name}")
        q = stateful.replay_stream(files.stream_events(spark, str(source))).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    assert got == {r.key: r.events for r in fold_states(e).collect()}


def test_redeliveries_across_batches(spark, tmp_path):
    e = to_events(workload.striped_load(spark, 50), "s").select(*[f.name for f in EVENT.fields])
    for i in range(2):
        e.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = stateful.without_redeliveries(files.stream_events(spark, str(tmp_path / "in"), max_files=1))
    q = stream.writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 50


def test_lines_and_topics(spark, tmp_path):
    e = to_events(workload.striped_load(spark, 20), "s")
    control = runner.Control(f"file://{tmp_path}/c", "s")
    batch = runner.with_heartbeat(e, control, (1, 2))
    sinks.write_lines(batch, str(tmp_path / "out"))
    assert files.read_events(spark, str(tmp_path / "out")).where("NOT malformed").count() == 20
    rows = sinks.topic_rows(batch, heartbeats=True).collect()
    assert len(rows) == 21 and all(json.loads(r.value)["db"] + ":" + json.loads(r.value)["key"] == r.key for r in rows)
    with pytest.raises(ValueError):
        sinks.write_topic(e, "b", "t", compression="rar")


def test_truth(spark, tmp_path):
    lines = [{"f": 1, "o": 5, "cmd": "set", "key": "a", "argc": 3}, {"f": 1, "o": 9, "bad": "torn"}, {"f": 1, "o": 7, "pef": 1, "peo": 9, "cmd": "DEL", "key": "a", "argc": 2}]
    (tmp_path / "gt.json").write_text("\n".join(map(json.dumps, lines)))
    got = files.read_truth(spark, str(tmp_path / "gt.json")).orderBy("offset").collect()
    assert [(r.offset, r.end_offset, r.command) for r in got] == [(5, 5, "SET"), (7, 9, "DEL")]


def test_loads(spark):
    events = [["HSET", "user:1", "name", "a"], ["HSET", "user:1", "age", "1"], ["HSET", "user:2", "name", "b"], ["DEL", "user:3"]]
    log = spark.createDataFrame([(3, 40 * (i + 1), 0, 0, c) for i, c in enumerate(events)], "filenum bigint, offset bigint, seq bigint, exec_time_s bigint, argv array<string>")
    e = to_events(log.withColumn("argv", F.col("argv").cast("array<binary>")), "s")
    rule = Rule("db1.ods_user", ["uid"], ["hash"], "user:{uid}")
    requests = sinks.load_requests(sinks.batch_rows(e, [rule]), 7, "seq").orderBy("columns").collect()
    assert {r.path for r in requests} == {"/api/db1/ods_user/_stream_load"} and len({r.label for r in requests}) == 3
    bodies = {r["columns"]: json.loads(r.body) for r in requests}
    assert bodies["age,name,seq,uid"] == [{"uid": "1", "name": "a", "age": "1", "seq": str((3 << 40) | 80)}]
    assert bodies["__DORIS_DELETE_SIGN__,seq,uid"] == [{"uid": "3", "__DORIS_DELETE_SIGN__": "1", "seq": str((3 << 40) | 160)}]
    assert requests[0].headers["function_column.sequence_col"] == "seq"
    seen = []

    class Node(BaseHTTPRequestHandler):
        def do_PUT(self):
            if self.path.startswith("/api"):
                self.send_response(307)
                self.send_header("Location", f"http://127.0.0.1:{self.server.server_port}/be{self.path}")
                self.send_header("Content-Length", "0")
                self.end_headers()
                return
            body = self.rfile.read(int(self.headers["Content-Length"]))
            seen.append((self.path, self.headers["label"], json.loads(body)))
            status = {"Status": "Fail"} if b'"bad"' in body else {"Status": "Label Already Exists"}
            data = json.dumps(status).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Node)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    node = f"127.0.0.1:{server.server_port}"
    sinks.send_load(node, requests[0].asDict(), "root", "")
    assert seen[0][0] == "/be/api/db1/ods_user/_stream_load" and seen[0][1] == requests[0].label
    with pytest.raises(sinks.SinkError):
        sinks.send_load(node, requests[0].asDict() | {"body": '[{"x":"bad"}]'}, "root", "")
    server.shutdown()
    assert sinks.split_table("a.b.c") == ("a.b", "c") and sinks.split_table("t") == ("information_schema", "t")


def test_exports(spark, tmp_path):
    states = fold_states(to_events(workload.striped_load(spark, 4, hash_every=2), "s"))
    sinks.export_tsv(states, str(tmp_path / "s"), "k:")
    sinks.export_tsv(states, str(tmp_path / "h"), "k:", ["name", "none"])
    read = lambda d: sorted(x for f in (tmp_path / d).glob("part*") for x in f.read_text().splitlines())
    assert read("s") == ["k:1\tv1", "k:3\tv3"] and read("h") == ["k:0\tn0\t", "k:2\tn2\t"]


def test_config(tmp_path, capsys):
    good = "source: {path: 'file:///x', source_id: n}\nsink: {file: {path: /tmp/o}}\nheartbeat: 1m30s\n"
    c = config.parse(good)
    assert c.sink.file.path == "/tmp/o" and c.source.db == "db0" and config.seconds("1m30s") == 90 and config.seconds(250) == 0.25
    for bad in (
        good + "extra: 1\n", good + "pipeline: {driver: sqlite, dsn: x, rules: [{table: t, pk: [a]}]}\n", "source: {path: a, source_id: b}\n", "sink: {file: {path: x}}\n",
        "source: {path: a, source_id: b}\npipeline: {driver: doris, rules: [{table: t, pk: [a]}]}\n", "source: {path: a, source_id: b}\npipeline: {driver: sqlite, dsn: x, rules: [{table: t}]}\n",
        good.replace("1m30s", "soon"),
    ):
        with pytest.raises(config.ConfigError):
            config.parse(bad)
    assert __main__.main(["-version"]) == 0 and __main__.main([]) == 2 and __main__.main(["-c", str(tmp_path / "none")]) == 1
    capsys.readouterr()


def test_command_line(spark, tmp_path):
    logs, out = tmp_path / "log", tmp_path / "out"
    logs.mkdir()
    (logs / "1").write_bytes(frames([["SET", "a", "1"], ["DEL", "a"]]))
    (tmp_path / "c.yaml").write_text(f"source: {{path: 'file://{logs}', source_id: n}}\nsink: {{file: {{path: {out}}}}}\ncheckpoint: 'file://{tmp_path}/check'\n")
    assert __main__.main(["-c", str(tmp_path / "c.yaml"), "-once"]) == 0
    assert sorted(r.op for r in files.read_events(spark, str(out)).collect()) == ["d", "u"]


def test_late_files_are_not_late(spark, tmp_path):
    """A file that was never seen counts, however old its entries."""
    log = to_events(workload.striped_load(spark, 90), "s").select(*[f.name for f in EVENT.fields])
    log = log.withColumn("source", F.col("source").withField("exec_time_s", F.col("source.offset") * 100))
    for i, part in enumerate(("source.offset >= 4000", "source.offset >= 3000", "source.offset < 3000")):
        log.where(part).coalesce(1).write.json(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    assert runner.collected(stateful.without_redeliveries(stream).select("event_id")).count() == 90


def test_log_ends(tmp_path):
    """Closed files end where they end; the newest is walked, up to the limit."""
    one, two = frames([["SET", "a", "1"]] * 3), frames([["SET", "b", "2"]] * 2, 2)
    (tmp_path / "1").write_bytes(one)
    (tmp_path / "2").write_bytes(two + two[:9])
    reader = log_source.LogStreamReader({"path": f"file://{tmp_path}"})
    assert reader.latestOffset() == {"file": 2, "byte": len(two)}
    bounded = log_source.LogStreamReader({"path": f"file://{tmp_path}", "maxbytes": str(len(one) + 1)})
    assert bounded.latestOffset() == {"file": 2, "byte": len(two) // 2}
    tight = log_source.LogStreamReader({"path": f"file://{tmp_path}", "maxbytes": "5"})
    assert tight.latestOffset() == {"file": 1, "byte": len(one) // 3}
    steps = {"file": -1, "byte": 0}
    for _ in range(5):
        end = tight._end(steps, 5)
        assert (end["file"], end["byte"]) > (steps["file"], steps["byte"])
        steps = end
    assert steps == {"file": 2, "byte": len(two)}


def test_long_logs_list_once(tmp_path, monkeypatch):
    """Closed files are listed once however many batches they make; the newest is looked at again."""
    one = frames([["SET", "a", "1"]] * 2)
    for n in range(12):
        (tmp_path / str(n)).write_bytes(one)
    calls, files_of = [], log_source._files
    monkeypatch.setattr(log_source, "_files", lambda uri: calls.append(uri) or files_of(uri))
    reader = log_source.LogStreamReader({"path": f"file://{tmp_path}", "maxbytes": str(len(one))})
    at = reader.initialOffset()
    for n in range(11):
        end = reader.latestOffset()
        assert end == {"file": n, "byte": len(one)}
        assert [(r.path[-1], r.start, r.stop) for t in reader.partitions(at, end) for r in t.ranges] == [(str(n)[-1], 0, len(one))]
        at = end
    assert len(calls) == 1
    assert reader.latestOffset() == {"file": 11, "byte": len(one)} == reader.latestOffset()
    (tmp_path / "11").write_bytes(one + one)
    (tmp_path / "12").write_bytes(one)
    assert reader.latestOffset() == {"file": 11, "byte": 2 * len(one)} and reader.latestOffset() == {"file": 12, "byte": len(one)}


def test_tasks_share_small_files(spark, tmp_path, monkeypatch):
    ranges = [log_source.FileRange(str(n), 0, size) for n, size in enumerate((4, 5, 2, 30, 1))]
    monkeypatch.setattr(log_source, "TASK_BYTES", 10)
    assert [[r.path for r in t.ranges] for t in log_source._tasks(ranges)] == [["0", "1"], ["2"], ["3"], ["4"]]
    assert [t.ranges for t in log_source._tasks([])] == [[]]


@pytest.mark.parametrize("lanes", [1, 3])
def test_bounded_batches_in_one_query(spark, tmp_path, monkeypatch, lanes):
    """All batches of a bounded stream come from one query, also when lanes share the log;
    every frame once, each lane's batches within the bound."""
    logs = tmp_path / "log"
    logs.mkdir()
    for n in range(7):
        (logs / str(n)).write_bytes(frames([["SET", f"k{n}-{i}", "1"] for i in range(4)], n))
    one, started, start = len(frames([["SET", "k0-0", "1"]])), [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **o: started.append(1) or start(self, *a, **o))
    control = runner.Control("", "n", (0, 100))
    streams = [runner.log_stream(spark, f"file://{logs}", control, max_bytes=3 * one, lane=i, lanes=lanes).select("key") for i in range(lanes)]
    got = runner.collected(streams if lanes > 1 else streams[0], bounded=True)
    assert sorted(r.key for r in got.collect()) == sorted(f"k{n}-{i}" for n in range(7) for i in range(4) if (n, i) != (0, 0))
    batches = got.groupBy(F.regexp_extract(F.input_file_name(), "lane=.*batch=\\d+", 0)).count().collect()
    assert len(started) == lanes and len(batches) >= 7 and max(r["count"] for r in batches) <= 3


def test_tools(spark, tmp_path, capsys):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert tools.main(["mutate", "--out", a, "--operations", "60", "--keys", "11", "--source", "s"]) == 0
    assert tools.main(["mutate", "--out", b, "--operations", "59", "--keys", "11", "--source", "s"]) == 0
    assert tools.main(["peek", "--events", a, "-n", "3"]) == 0
    assert tools.main(["verify", "--events", a, "--prefix", "k:", "--watch", "k:0-10:1"]) == 0
    assert tools.main(["verify", "--events", a, "--watch", "k:0-11:1"]) == 1
    assert tools.main(["compare", "--source", a, "--target", a]) == 0 and tools.main(["compare", "--source", a, "--target", b]) == 1
    assert tools.main(["ordchk", "--events", a]) == 0
    truth = [{"f": 0, "o": 64 * i, "cmd": c, "key": k} for i, (c, k) in enumerate((r.command, r.key) for r in files.read_events(spark, a).orderBy("source.offset").collect())]
    (tmp_path / "gt.json").write_text("\n".join(map(json.dumps, truth)))
    assert tools.main(["audit", "--events", a, "--truth", str(tmp_path / "gt.json")]) == 0
    assert tools.main(["audit", "--events", b, "--truth", str(tmp_path / "gt.json")]) == 0  # the last entry is pending
    (tmp_path / "gt.json").write_text("\n".join(map(json.dumps, truth[1:])))
    assert tools.main(["audit", "--events", a, "--truth", str(tmp_path / "gt.json")]) == 1  # a ghost
    for x, events in (("x", a), ("y", b)):
        assert tools.main(["replay", "--events", events, "--out", str(tmp_path / x), "--prefix", "k:"]) == 0
    assert tools.main(["diff", str(tmp_path / "x"), str(tmp_path / "x")]) == 0 and tools.main(["diff", str(tmp_path / "x"), str(tmp_path / "y")]) == 1
    assert "@0:" in capsys.readouterr().out


def test_start_order(spark, tmp_path):
    """An explicit start comes before the checkpoint, that before the log's beginning."""
    logs = tmp_path / "log"
    logs.mkdir()
    data = frames([["SET", f"k{i}", "1"] for i in range(4)])
    (logs / "1").write_bytes(data)
    control, uri, seen = runner.Control("", "n"), f"file://{logs}", []

    def run(start):
        got = []
        q = runner.start(runner.log_stream(spark, uri, control, start=start), lambda b, _: got.extend(r.key for r in b.collect()), runner.stream_checkpoint(str(tmp_path / "c"), start), trigger=None)
        q.awaitTermination()
        seen.append(sorted(got))

    for start in ("", "", f"1:{len(data) // 2}", f"1:{len(data) // 2}", "latest"):
        run(start)
    assert seen == [["k0", "k1", "k2", "k3"], [], ["k2", "k3"], [], []]


def test_metrics_page():
    metrics = runner.Metrics()
    metrics.add("keyflow_entries_received_total", 3)
    server = runner.serve_metrics(metrics, "127.0.0.1:0")
    read = lambda path: urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}{path}").read().decode()
    assert "keyflow_entries_received_total 3" in read("/metrics") and read("/healthz") == "ok\n"
    server.shutdown()


def test_heartbeats_and_stalls(spark, tmp_path):
    """An idle query beats; one that stands still while the log goes on is started anew."""
    logs, beats, seen = tmp_path / "log", [], []
    logs.mkdir()
    (logs / "1").write_bytes(frames([["SET", "a", "1"]]))
    control, uri = runner.Control(f"file://{tmp_path}/c", "n").load(), f"file://{logs}"
    sink = lambda batch, n: seen.append((n, sorted(r.phase for r in batch.collect())))
    beat = runner.heartbeat_to(sink, spark, control, uri)

    def counted():
        beat()
        beats.append(1)
        query.stop()

    query = runner.start(runner.log_stream(spark, uri, control), sink, str(tmp_path / "s"), "1 second")
    runner.supervise(lambda: query, idle=0.5, beat=counted)
    assert beats and (-2, ["heartbeat"]) in seen
    made = []

    def make():
        made.append(runner.start(runner.log_stream(spark, uri, control), sink, str(tmp_path / f"s{len(made)}"), "1 hour" if not made else None))
        return made[-1]

    runner.supervise(make, pause=0.1, stall=3.0, behind=lambda: len(made) == 1)
    assert len(made) == 2


def test_metrics(spark, tmp_path):
    metrics = runner.Metrics()
    listener = runner.MetricsListener(metrics)
    spark.streams.addListener(listener)
    e = to_events(workload.striped_load(spark, 30), "s").select(*[f.name for f in EVENT.fields])
    e.write.json(str(tmp_path / "in"))
    q = runner.start(runner.observed(files.stream_events(spark, str(tmp_path / "in"))), lambda b, _: b.count(), str(tmp_path / "c"), trigger=None)
    q.awaitTermination()
    for _ in range(50):
        # Late news of queries that ended before may come first.
        if metrics.values.get("keyflow_queries_ended_total") and metrics.values.get("keyflow_entries_received_total", 0) >= 30:
            break
        threading.Event().wait(0.2)
    spark.streams.removeListener(listener)
    assert metrics.values["keyflow_entries_received_total"] >= 30 and "keyflow_uptime_seconds" in metrics.text()
