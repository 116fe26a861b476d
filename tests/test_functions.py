import json
import struct

import pytest
from pyspark.sql import functions as F

from keyflow.functions import decode, envelope, info
from keyflow.functions.position import literal_position, position, sequence_number


def entry(content, kind=1, filenum=12, offset=34567, length=None):
    return struct.pack("<HIIQIQI", kind, 1700000000, 7, 8899, filenum, offset, len(content) if length is None else length) + content


@pytest.mark.parametrize(
    "data, argv",
    [
        (b"*3\r\n$3\r\nset\r\n$3\r\nkey\r\n$5\r\nvalue\r\n", [b"set", b"key", b"value"]),
        (b"*1\r\n$3\r\n\x00a\xff\r\n", [b"\x00a\xff"]),
        (b"*0\r\n", []), (b"", None), (b"+OK\r\n", None), (b"*1\r\n$3\r\nset\r\ntrailing", None), (b"*1\r\n$3\r\nse\r\n", None), (b"*1\r\n$-1\r\n", None), (None, None),
    ],
)
def test_resp(data, argv):
    assert decode.parse_resp(data) == argv
    if argv is not None:
        assert decode.resp_bytes(argv) == data


def test_entries(spark):
    good = entry(decode.resp_bytes([b"PING"]))
    rows = [(1, 100, 5, good), (1, 200, 5, good[:20]), (1, 300, 5, entry(b"x", kind=2)), (1, 400, 5, entry(b"xy", length=1)), (1, 500, 5, entry(b"*1\r\n")), (1, 600, 5, b""), (1, 700, 6, good)]
    raw = spark.createDataFrame(rows, "pb_filenum bigint, pb_offset bigint, session_id int, binlog binary")
    ok, bad = decode.decode_log(raw, 5)
    (r,) = ok.collect()
    assert (r.filenum, r.offset, r.exec_time_s, r.pb_end.offset, [bytes(a) for a in r.argv]) == (12, 34567, 1700000000, 100, [b"PING"])
    assert sorted((r.pb_offset, r.reason) for r in bad.collect()) == [(200, "undecodable entry"), (300, "undecodable entry"), (400, "undecodable entry"), (500, "undecodable command")]


def test_envelope(spark):
    log = spark.createDataFrame(
        [(7, 1234, 99, 5, [b"DEL", b"user:1"]), (7, 1300, 0, 0, [b"set", b"k", b"\xff\xfe\x01"]), (7, 1400, 0, 0, [b"zadd"])],
        "filenum bigint, offset bigint, seq bigint, exec_time_s bigint, argv array<binary>",
    )
    a, b, c = envelope.to_events(log, "127.0.0.1:9221").orderBy("source.offset").collect()
    assert (a.event_id, a.op, a.data_type, a.key) == ("inc:127.0.0.1:9221:7:1234:99", "d", "unknown", "user:1")
    assert (b.args_encoding, b.args, b.op, b.data_type) == ("base64", ["c2V0", "aw==", "//4B"], "u", "string")
    assert (c.key, c.data_type) == ("", "zset")
    events = envelope.to_events(log, "127.0.0.1:9221")
    lines = events.select(envelope.wire_json(events).alias("value"))
    seen = {json.loads(r.value)["event_id"]: json.loads(r.value) for r in lines.collect()}
    assert seen[a.event_id]["source"]["exec_time_s"] == 5 and "exec_time_s" not in seen[b.event_id]["source"]
    back = envelope.from_json_lines(lines.union(spark.createDataFrame([("no event",)], "value string")))
    assert sorted(r.malformed for r in back.collect()) == [False, False, False, True]
    restored = back.where("NOT malformed").select("event_id", envelope.decoded_args(F.col("args"), F.col("args_encoding")).alias("x")).collect()
    assert {bytes(r.x[2]) for r in restored if r.event_id == b.event_id} == {b"\xff\xfe\x01"}
    snap = envelope.to_events(log, "s", phase="snapshot").where("source.offset = 1300").first()
    assert (snap.event_id, snap.op) == ("snapshot:s:db0:string:k:set", "r")
    assert events.select(envelope.described(events)).count() == 3


def test_relative_expiry(spark):
    rows = spark.createDataFrame([(["pksetexat", "k", "1100", "v"],), (["pksetexat", "k", "x", "v"],), (["set", "k", "v"],)], "a array<string>").select(F.col("a").cast("array<binary>").alias("a"))
    out = [[bytes(x).decode() for x in r[0]] for r in rows.select(envelope.relative_expiry(F.col("a"), F.lit(1000))).collect()]
    assert out == [["setex", "k", "100", "v"], ["pksetexat", "k", "x", "v"], ["set", "k", "v"]]


def test_positions(spark):
    rows = spark.createDataFrame([(0, 0), (0, 5), (1, 0), (None, 1)], "filenum bigint, offset bigint")
    got = rows.select(position().alias("p"), (position() > literal_position(0, 0)).alias("later")).collect()
    assert [r.later for r in got] == [False, True, True, None] and got[3].p is None
    assert spark.range(1).select(sequence_number(F.lit(3), F.lit(120))).first()[0] == (3 << 40) | 120


@pytest.mark.parametrize(
    "text, expected",
    [
        ("# Replication\r\nbinlog_offset:7 12345\r\n", (7, 12345, None)), ("some=thing binlog_offset=12,34567 other", (12, 34567, None)),
        ("binlog_file_num: 9\nbinlog_offset: 999", (9, 999, None)), ("binlog_offset: 999\nbinlog_filenum: 9\nmaster_lag:4", (9, 999, 4)), ("db0 lag=(3, 17)", (None, None, 17)),
    ],
)
def test_status(spark, text, expected):
    s = spark.createDataFrame([(text,)], "t string").select(info.replication_status(F.col("t")).alias("s")).first().s
    assert (s.filenum, s.offset, s.lag) == expected


@pytest.mark.parametrize("text", ["", "role:master", "binlog_offset:4294967296 1", "# binlog_offset:1 2"])
def test_bad_status(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(info.replication_status(F.col("t")).alias("s")).first().s is None


def test_anchor():
    assert info.anchor_of("1s\nhost\n9221\n3\n999\n") == (3, 999)
    with pytest.raises(ValueError):
        info.anchor_of("1\n2\n")
