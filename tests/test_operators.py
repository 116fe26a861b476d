import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyflow.functions.envelope import to_events
from keyflow.operators import snapshot, verify
from keyflow.operators.coalesce import apply_to_table, coalesce_rows
from keyflow.operators.gate import first_seen, gate
from keyflow.operators.rules import Rule, RuleError, map_events
from keyflow.operators.state import KeyState, canonical, fold_hashes, fold_states
from keyflow.plans import catalog
from keyflow.sources import workload

LOG = "filenum bigint, offset bigint, seq bigint, exec_time_s bigint, argv array<string>"


def events(spark, commands):
    rows = [(1, 64 * i, 0, 0, c) for i, c in enumerate(commands)]
    return to_events(spark.createDataFrame(rows, LOG).withColumn("argv", F.col("argv").cast("array<binary>")), "s")


def mapped(spark, rules, commands, **options):
    rows = map_events(events(spark, commands), rules, **options).orderBy("source.offset").select("row").collect()
    return [r.row and (r.row.action, r.row.pk, r.row.cols) for r in rows]


def test_hash_rule(spark):
    rule = Rule("t", ["uid"], ["hash"], "user:{uid}", {"name": "full_name", "age": "age"})
    got = mapped(spark, [rule], [["HSET", "user:42", "name", "tom", "x", "1", "name", "tim"], ["SET", "k", "v"], ["DEL", "user:3"], ["HSET", "user:4", "x", "1"], ["hdel", "user:5", "name"]])
    assert got == [("upsert", {"uid": "42"}, {"full_name": "tim"}), None, ("delete", {"uid": "3"}, {}), ("skip", {"uid": "4"}, {}), ("upsert", {"uid": "5"}, {"full_name": None})]
    assert mapped(spark, [rule], [["HDEL", "user:5", "name"]], compat=True) == [("upsert", {"uid": "5"}, {"full_name": ""})]


def test_key_patterns(spark):
    rule = Rule("t", ["org", "uid"], ["hash"], "org:{org}:user:{uid}")
    assert mapped(spark, [rule], [["HSET", "org:acme:user:7", "a", "1"]]) == [("upsert", {"org": "acme", "uid": "7"}, {"a": "1"})]
    strict = Rule("t", ["id"], ["hash"], "user:{id}:x")
    assert mapped(spark, [strict], [["HSET", "user:a:x", "f", "1"], ["HSET", "user:a:x:x", "f", "1"], ["HSET", "user::x", "f", "1"]]) == [("upsert", {"id": "a"}, {"f": "1"}), None, ("upsert", {"id": ""}, {"f": "1"})]
    assert mapped(spark, [Rule("t", ["id"], ["hash"], "a.*{id}")], [["HSET", "a.*1\n2", "f", "1"], ["HSET", "abc1", "f", "1"]]) == [("upsert", {"id": "1\n2"}, {"f": "1"}), None]
    for bad in ("x:{a}{b}", "x:{a", "x:{}", "x}:{a}"):
        with pytest.raises(RuleError):
            Rule("t", ["a"], key_pattern=bad)
    with pytest.raises(RuleError):
        Rule("", ["a"])


def test_string_rules(spark):
    rule = Rule("t", ["id"], ["string"], "acct:{id}", value_json=True, json_columns=["balance", "name", "gone"])
    got = mapped(spark, [rule], [["SET", "acct:9", '{"balance":12.5,"name":"bob","secret":"s","gone":null}'], ["SET", "acct:8", "no json"], ["INCRBY", "acct:7", "1"], ["SETEX", "acct:6", "60", '{"name":"x"}'], ["SET", "acct:5", '{"other":1}']])
    assert got[0] == ("upsert", {"id": "9"}, {"balance": "12.5", "name": "bob", "gone": ""})
    assert [g[0] for g in got[1:]] == ["error", "skip", "upsert", "skip"] and got[3][2] == {"name": "x"}
    plain = Rule("t", ["id"], ["string"], "k:{id}", value_column="v")
    assert mapped(spark, [plain], [["SET", "k:1", "a"], ["SET", "k:1"]]) == [("upsert", {"id": "1"}, {"v": "a"}), ("skip", {"id": "1"}, {})]
    assert mapped(spark, [Rule("t", ["uid"], ["hash"])], [["HSET", "any", "uid", "4", "b", "2"], ["HSET", "any", "b", "2"]]) == [("upsert", {"uid": "4"}, {"b": "2"}), ("error", {"uid": None}, {})]


def test_routing(spark):
    ignoring, other = Rule("a", ["id"], ["list", "hash"], "k:{id}", delete="ignore"), Rule("b", ["id"], ["hash", "string"], "k:{id}")
    assert [g and g[0] for g in mapped(spark, [ignoring, other], [["DEL", "k:1"], ["RPUSH", "k:1", "x"], ["SET", "k:1", "x"]])] == ["skip", None, "upsert"]


@pytest.mark.parametrize(
    "steps, expected",
    [
        ([("a", {"x": "1"}), ("a", {"x": "2"}), ("b", {"x": "x"})], {"a": (0, False, False, {"x": "2"}), "b": (2, False, False, {"x": "x"})}),
        ([("a", {"x": "1"}), ("a", None)], {"a": (0, True, False, {})}),
        ([("a", None), ("a", {"x": "9"})], {"a": (0, False, True, {"x": "9"})}),
        ([("a", {"x": "1", "y": "1"}), ("b", {"x": "2"}), ("a", {"x": "3", "z": None})], {"a": (0, False, False, {"x": "3", "y": "1", "z": None}), "b": (1, False, False, {"x": "2"})}),
    ],
)
def test_coalesce(spark, steps, expected):
    rows = spark.createDataFrame([(k, c or {}, c is None, i) for i, (k, c) in enumerate(steps)], "pk string, cols map<string,string>, del boolean, ord bigint")
    assert {r.pk: (r["first"], r["del"], r.reset, r.cols) for r in coalesce_rows(rows, ("pk",), "ord").collect()} == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.dictionaries(st.sampled_from("xyz"), st.sampled_from("123"), min_size=1))), min_size=1, max_size=12), st.integers(1, 5))
def test_coalesced_batches_equal_single_steps(spark, steps, size):
    table, target = {}, spark.createDataFrame([], "pk string, cols map<string,string>")
    for k, c in steps:
        if c is None:
            table.pop(k, None)
        else:
            table[k] = table.get(k, {}) | c
    for at in range(0, len(steps), size):
        rows = spark.createDataFrame([(k, c or {}, c is None, i) for i, (k, c) in enumerate(steps[at : at + size])], "pk string, cols map<string,string>, del boolean, ord bigint")
        after = apply_to_table(target, coalesce_rows(rows, ("pk",), "ord"), ("pk",)).collect()
        target = spark.createDataFrame(after, "pk string, cols map<string,string>")
    assert {r.pk: r.cols for r in target.collect()} == table


def test_gate(spark):
    log = spark.createDataFrame([(1, x, (1, x + 50)) for x in (50, 100, 150, 200, 250)] + [(0, 0, (0, 10))], "filenum bigint, offset bigint, pb_end struct<filenum:bigint,offset:bigint>")
    assert sorted((r.filenum, r.offset) for r in gate(log, (1, 200)).collect()) == [(1, 200), (1, 250)]
    assert gate(log, None).count() == 6


def test_snapshot_scan(spark):
    none = dict.fromkeys(("s", "h", "l", "st", "z"))
    rows = [
        {"key": "k1", "typ": "string", **none, "s": "v1", "ttl": 60}, {"key": "h", "typ": "hash", **none, "h": {"b": "2", "a": "1"}, "ttl": 5}, {"key": "l", "typ": "list", **none, "l": list("abcde"), "ttl": 0},
        {"key": "z", "typ": "zset", **none, "z": {"m": 1.5}, "ttl": 0}, {"key": "_internal:slotkey:4migrate:1", "typ": "string", **none, "s": "x", "ttl": 0}, {"key": "e", "typ": "set", **none, "st": [], "ttl": 9},
    ]
    schema = "key string, typ string, s string, h map<string,string>, l array<string>, st array<string>, z map<string,double>, ttl bigint"
    state = spark.createDataFrame([tuple(r[c.split(" ")[0]] for c in schema.split(", ")) for r in rows], schema)
    commands = snapshot.scan(state, chunk=2)
    got = [r.argv for r in commands.orderBy("stage", "key", "part").collect()]
    assert got == [
        ["SET", "k1", "v1", "EX", "60"], ["RPUSH", "l", "a", "b"], ["RPUSH", "l", "c", "d"], ["RPUSH", "l", "e"], ["HMSET", "h", "a", "1", "b", "2"], ["EXPIRE", "h", "5"], ["ZADD", "z", "1.5", "m"],
    ]
    out = snapshot.snapshot_events(commands, (3, 999), "s").orderBy("source.seq").collect()
    assert [r.source.seq for r in out] == list(range(1, 8)) and [r.op for r in out] == ["r"] * 5 + ["u", "r"]
    assert {(r.source.filenum, r.source.offset) for r in out} == {(3, 999)}
    assert [r.argv for r in snapshot.scan(state, list_tail=2, types=("list",)).collect()] == [["RPUSH", "l", "d", "e"]]
    assert {r.key for r in snapshot.scan(state, resume=("hash", "h")).collect()} == {"h", "z"}
    assert {r.key for r in snapshot.scan(state, pattern="?1", lifetimes=False).collect()} == {"k1"}


def test_snapshot_ranges(spark):
    """Keys of one long prefix are dealt over many tasks, and numbered in order."""
    rows = spark.range(20_000).select(F.lit(0).alias("stage"), F.format_string("session:%06d", "id").alias("key"), F.lit(0).alias("part"), F.array(F.lit("SET"), F.format_string("session:%06d", "id"), F.lit("v")).alias("argv"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = snapshot.snapshot_events(rows.repartition(3), (1, 2), "s")
        files = [f for f in out.inputFiles() if "snapshot" in f]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(set(files)) == 4
    got = out.select("key", "source.seq").orderBy("seq").collect()
    assert [(r.key, r.seq) for r in got] == [(f"session:{i:06d}", i + 1) for i in range(20_000)]


def test_wide_hashes(spark):
    """A command of thousands of fields is mapped in one sorted pass; the last value wins."""
    argv = ["HMSET", "k:1", *[x for i in range(8000) for x in (f"f{i % 5000}", str(i))]]
    (row,) = mapped(spark, [Rule("t", ["id"], ["hash"], "k:{id}")], [argv])
    assert row[0] == "upsert" and row[2] == {f"f{i % 5000}": str(i) for i in range(8000)}


def test_scores_as_numbers(spark):
    states = fold_states(events(spark, [["ZADD", "a", "1.50", "m"], ["ZADD", "b", "1.5", "m"], ["ZADD", "c", "high", "m"]]))
    assert {r.key: r.c for r in states.select("key", canonical(states).alias("c")).collect()} == {"a": "zset{m=1.5}", "b": "zset{m=1.5}", "c": "zset{m=high}"}


def test_replay_table():
    def run(*commands):
        s = KeyState()
        done = [s.apply(c[0], list(c)) for c in commands]
        return s.typ, s.value, done[-1], s.events

    assert run(["SET", "k", "a"], ["HSET", "k", "f", "v"]) == ("string", "a", False, 2)
    assert run(["HMSET", "k", "f", "v", "g"]) == ("none", None, False, 1)
    assert run(["HSET", "k", "f", "v"], ["HDEL", "k", "f"]) == ("none", None, True, 2)
    assert run(["RPUSH", "k", "a", "b", "c"], ["LPOP", "k"], ["RPOP", "k"])[:2] == ("list", ["b"])
    assert run(["SADD", "k", "a"], ["SREM", "k", "a", "b"])[0] == "none"
    assert run(["ZADD", "k", "1.50", "m"], ["EXPIRE", "k", "5"])[:3] == ("zset", {"m": "1.50"}, False)
    assert run(["ZADD", "k", "abc", "m"])[:2] == ("zset", {"m": "abc"})
    assert run(["SETEX", "k", "60", "v"])[:2] == ("string", "v")
    assert run(["SET", "k", "a"], ["DEL", "k"], ["LPUSH", "k", "a", "b"])[:2] == ("list", ["b", "a"])


def test_folds_agree(spark):
    rnd = random.Random(3)
    commands = [["DEL", f"k{rnd.randint(0, 3)}"] if rnd.random() < 0.1 else ["HMSET", f"k{rnd.randint(0, 3)}", *[x for _ in range(rnd.randint(1, 3)) for x in (rnd.choice("abc"), str(rnd.randint(0, 99)))]] for _ in range(200)]
    e = events(spark, commands)
    a = {r.key: r.h for r in fold_states(e).where("typ = 'hash'").collect()}
    b = {}
    for r in fold_hashes(e).collect():
        b.setdefault(r.key, {})[r.field] = r.value
    assert a == b and a


def test_net_zero_storm(spark):
    preload = workload.preload(spark, 100)
    text = lambda log: {r.key: r.c for r in (lambda s: s.where("typ != 'none'").select("key", canonical(s).alias("c")).collect())(fold_states(to_events(log, "s")))}
    before = text(preload)
    assert len(before) == 100 and before == text(preload.unionByName(workload.net_zero_storm(spark, 100, 500, lag=50)))


def test_replays_change_nothing(spark):
    e = to_events(workload.churn(spark, 500, 20), "s")
    again = e.unionByName(e.where("source.offset % 128 = 0"))
    state = lambda x: {r.key: (r.typ, r.events) for r in fold_states(x).collect()}
    assert state(e) == state(first_seen(again).repartition(7))
    assert workload.striped_load(spark, 10).count() == 10 and workload.probe(spark).count() == 5


def test_watch_specs():
    w = verify.Watch.parse("user:1-9:3:2")
    assert (w.prefix, w.low, w.high, w.skip, w.least) == ("user:", 1, 9, 3, 2)
    for bad in ("user", "user:1:2", "user:1-x:2", "a:1-2:3:4:5"):
        with pytest.raises(ValueError):
            verify.Watch.parse(bad)


def test_contiguous_prefix(spark):
    work = spark.createDataFrame([(0, True, 10), (1, True, 20), (2, False, 30), (3, True, 40)], "ord int, done boolean, pos int")
    assert verify.contiguous_prefix(work).first().pos == 20
    assert verify.contiguous_prefix(work.where("done")).first().pos == 40
    assert verify.contiguous_prefix(work.where("ord >= 2")).first().pos is None


def test_compare_and_report(spark):
    a = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "key string, state string")
    b = spark.createDataFrame([("b", "2"), ("c", "4"), ("d", "5")], "key string, state string")
    assert {r.key: r.kind for r in verify.compare_states(a, b).collect()} == {"a": "missing", "c": "value", "d": "extra"}
    assert {r.kind: (r.n, r["keys"]) for r in verify.report(verify.compare_states(a, b)).collect()} == {"missing": (1, ["a"]), "value": (1, ["c"]), "extra": (1, ["d"])}


def test_sessions_end_at_the_gap(spark, tmp_path):
    """Events exactly the gap apart are in two sessions; those without a time or a user count."""
    gap, at = 21600, "timestamp_seconds({})::timestamp_ntz"
    rows = [(1, gap), (1, 2 * gap), (1, 3 * gap - 1), (1, f"{3 * gap - 1}.5"), (1, "NULL"), (1, "NULL"), ("NULL", 5), (-5, 7)]
    values = ", ".join(f"({i}L, {at.format(t)}, CAST({user} AS BIGINT), 'view', 1D, '{{\"k\": 1}}')" for i, (user, t) in enumerate(rows))
    spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, ts, user_id, event_type, value, props)").write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in catalog.QUERIES["q30_session_windows"](spark, str(tmp_path)).collect()}
    assert got == {(1, gap, 2 * gap, 1), (1, 2 * gap, 4 * gap - 1, 3), (1, None, None, 2), (None, 5, gap + 5, 1), (-5, 7, gap + 7, 1)}
