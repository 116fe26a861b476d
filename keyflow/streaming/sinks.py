"""Sinks: event lines, topics, SQL tables, bulk-load requests, text exports.

Every sink takes the DataFrame of one micro-batch (or a batch job) and its id, so it
fits ``foreachBatch``. Deliveries may repeat after a restart; sinks are idempotent:
rows are full images keyed by primary key, bulk loads carry a label made of the id.
"""

from __future__ import annotations

import importlib
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.envelope import partition_key, wire_json
from keyflow.functions.position import route, sequence_number
from keyflow.operators.coalesce import coalesce_rows
from keyflow.operators.rules import Rule, column_shape, key_of, map_events, rows_of
from keyflow.streaming.dialects import dialect, parsed_dsn

DELETE_SIGN, LABEL_TAKEN = "__DORIS_DELETE_SIGN__", "Label Already Exists"  # fixed values of the load protocol
COMPRESSIONS = ("none", "gzip", "snappy", "lz4", "zstd")


class SinkError(RuntimeError):
    pass


def deliverable(events: DataFrame, heartbeats: bool = False) -> DataFrame:
    return events if heartbeats else events.where(F.col("phase") != "heartbeat")


def in_key_order(events: DataFrame) -> DataFrame:
    """All events of a key in one partition, in delivery order."""
    place = [F.col("phase") != "snapshot", F.col("source.filenum"), F.col("source.offset"), F.col("source.seq")]
    key = partition_key(F.col("db"), F.col("key"))
    return events.repartition(key).sortWithinPartitions(*place)


def write_lines(events: DataFrame, path: str, heartbeats: bool = False) -> None:
    """Append JSON lines to the files in ``path``."""
    in_key_order(deliverable(events, heartbeats)).select(wire_json(events).alias("value")).write.mode("append").text(path)


def topic_rows(events: DataFrame, heartbeats: bool = False, partitions: int = 0) -> DataFrame:
    """``key`` and ``value`` of the messages; the key decides the topic's partition: the
    connector's own way, or by FNV-1a hash over ``partitions``, as column ``partition``."""
    rows = in_key_order(deliverable(events, heartbeats))
    key = partition_key(F.col("db"), F.col("key"))
    return rows.select(key.alias("key"), wire_json(rows).alias("value"), *([route(key, partitions).alias("partition")] if partitions else []))


def write_topic(
    events: DataFrame, brokers: str, topic: str, compression: str = "none", heartbeats: bool = False,
    client_id: str = "", batch_bytes: int = 0, partitions: int = 0,
) -> None:
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {', '.join(COMPRESSIONS)}, not {compression}")
    out = topic_rows(events, heartbeats, partitions).write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic)
    if client_id:
        out = out.option("kafka.client.id", client_id)
    if batch_bytes:
        out = out.option("kafka.batch.size", batch_bytes)
    out.option("kafka.acks", "all").option("kafka.compression.type", compression).save()


def batch_rows(events: DataFrame, rules: list[Rule], compat: bool = False) -> DataFrame:
    """Coalesced mutations of a batch: ``table, pk_key, pk, cols, del, reset, last``.

    Rows are told apart by ``pk_key``, the array of their key columns and values, so
    that values may hold any character. An event that is mapped to an error fails the
    job that reads the rows, with the event's key and error: one pass does both.
    """
    mapped = map_events(events, rules, compat)
    told = F.concat_ws(": ", F.lit("cannot be mapped"), F.col("key"), F.col("row.error"))
    action = F.when(F.col("row.action") == "error", F.raise_error(told)).otherwise(F.col("row.action"))
    checked = mapped.withColumn("row", F.when(F.col("row").isNotNull(), F.col("row").withField("action", action)))
    rows = rows_of(checked).select("table", key_of(F.col("pk")).alias("pk_key"), "cols", "del", F.struct("filenum", "offset", "seq").alias("at"))
    return coalesce_rows(rows, ("table", "pk_key"), "at").withColumn("pk", F.map_from_entries("pk_key"))


def write_sql(rows: DataFrame, connect: Callable[[], object], kind: str, chunk: int = 500, paramstyle: str = "") -> None:
    """Upsert and delete the rows of a batch, a transaction for each ``chunk`` rows.

    ``connect`` opens a DB-API connection in the task. A key is in one row of a batch,
    so tasks do not meet; a retried task writes the same images again. Parameter marks
    are the driver's (``connect.paramstyle``, or as given).
    """
    sql = dialect(kind, paramstyle or getattr(connect, "paramstyle", ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        connection, n = connect(), 0
        try:
            cursor = connection.cursor()
            for batch in batches:
                for r in batch.to_pylist():
                    pk, cols = sorted(r["pk"] or ()), sorted(r["cols"] or ())
                    names = [k for k, _ in pk]
                    if r["del"] or r["reset"]:
                        cursor.execute(sql.delete(r["table"], names), [v for _, v in pk])
                    if not r["del"]:
                        cursor.execute(sql.upsert(r["table"], names, [k for k, _ in cols]), [v for _, v in (*pk, *cols)])
                    n += 1
                    if n % chunk == 0:
                        connection.commit()
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.select("table", "pk", "cols", "del", "reset").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


class Connector:
    """Opens connections of a DB-API module inside tasks, and knows its parameter marks.
    A module that takes no connection text (MySQL's) gets its parts by name."""

    def __init__(self, module: str, dsn: str, paramstyle: str = ""):
        self.module, self.dsn = module, dsn
        self.paramstyle = paramstyle or importlib.import_module(module).paramstyle

    def __call__(self):
        connect = importlib.import_module(self.module).connect
        parts = parsed_dsn(self.dsn)
        return connect(**parts) if self.module in ("pymysql", "MySQLdb") else connect(self.dsn)


def split_table(name: str) -> tuple[str, str]:
    """Database and table; without a database, ``information_schema``."""
    database, dot, table = name.rpartition(".")
    return (database, table) if dot else ("information_schema", table)


def load_requests(rows: DataFrame, batch_id: int, sequence_column: str = "", label: str = "keyflow", chunk: int = 1000, run: str = "", source_id: str = "") -> DataFrame:
    """Bulk-load requests: ``path, label, columns, headers, body`` by table and shape, in
    order of their paths and labels.

    Each body is a JSON array of at most ``chunk`` rows that have the same columns. Hash
    shares of about that size, then slices of each share in order of their rows, so no
    task holds more than a share. A label is the same when the batch is sent again, and
    unlike those of any other ``run`` (the checkpoint's random id), source, database,
    table or batch.
    """
    columns = column_shape(F.col("cols"), F.col("pk"), F.col("del"))
    values = F.map_concat(F.col("pk"), F.map_filter("cols", lambda k, v: ~F.map_contains_key(F.col("pk"), k)))
    values = F.map_concat(values, F.when(F.col("del"), F.create_map(F.lit(DELETE_SIGN), F.lit("1"))).otherwise(F.expr("CAST(map() AS MAP<STRING, STRING>)")))
    if sequence_column:
        values = F.map_concat(values, F.create_map(F.lit(sequence_column), sequence_number(F.col("last.filenum"), F.col("last.offset")).cast("string")))
    share = F.pmod(F.xxhash64("pk_key"), F.greatest(F.lit(1), F.ceil(F.col("n") / chunk)))
    sizes = rows.groupBy("table", columns.alias("shape")).agg(F.count("*").alias("n"))
    dealt = rows.withColumn("shape", columns).join(sizes, ["table", "shape"]).withColumn("share", share)
    names = F.array_distinct(F.flatten(F.collect_set(F.map_keys("values"))))
    grouped = dealt.withColumn("values", values).groupBy("table", "shape", "share").agg(F.array_sort(names).alias("columns"), F.array_sort(F.collect_list(F.to_json("values"))).alias("all"))
    slices = F.transform(F.sequence(F.lit(0), F.floor((F.size("all") - 1) / chunk).cast("int")), lambda i: F.slice("all", i * chunk + 1, F.lit(chunk)))
    grouped = grouped.select("table", "shape", "share", "columns", F.posexplode(slices).alias("part", "own"))
    parts = F.split("table", r"\.(?=[^.]*$)")
    database = F.when(F.size(parts) > 1, parts[0]).otherwise("information_schema")
    name = F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.col("table"))
    told = F.md5(F.to_json(F.array(F.lit(source_id), database, name, F.col("shape"), F.col("share").cast("string"), F.col("part").cast("string"))))
    tag = F.concat_ws("-", F.lit(label), *([F.lit(run)] if run else []), F.lit(str(batch_id)), F.substring(told, 1, 16))
    headers = {"format": "json", "strip_outer_array": "true", "partial_columns": "true", **({"function_column.sequence_col": sequence_column} if sequence_column else {})}
    return grouped.select(
        F.concat(F.lit("/api/"), database, F.lit("/"), name, F.lit("/_stream_load")).alias("path"), tag.alias("label"), F.array_join("columns", ",").alias("columns"),
        F.create_map(*[F.lit(x) for pair in headers.items() for x in pair]).alias("headers"),
        F.concat(F.lit("["), F.array_join("own", ","), F.lit("]")).alias("body"),
    ).repartition("path").sortWithinPartitions("path", "label")


def send_loads(requests: DataFrame, nodes: list[str], user: str, password: str = "", timeout: float = 60.0) -> None:
    """Send the requests, in turn to the nodes; a node that cannot be reached is passed
    over for the next one. A label that exists counts as done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = 0
        for batch in batches:
            for r in batch.to_pylist():
                send_to_nodes(nodes, r, sent, user, password, timeout)
                sent += 1
        yield pa.RecordBatch.from_arrays([pa.array([sent], pa.int64())], names=["n"])

    requests.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def send_to_nodes(nodes: list[str], r: dict, first: int, user: str, password: str, timeout: float) -> None:
    """One load to the node whose turn it is, or the next one that can be reached."""
    for attempt in range(len(nodes)):
        try:
            return send_load(nodes[(first + attempt) % len(nodes)], r, user, password, timeout)
        except OSError:
            if attempt == len(nodes) - 1:
                raise


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def send_load(node: str, r: dict, user: str, password: str, timeout: float = 60.0) -> None:
    """One load. A redirect to the loopback address means the node's own host."""
    import base64

    url = f"http://{node}{r['path']}"
    headers = dict(r["headers"]) | {"label": r["label"], "columns": r["columns"], "Expect": "100-continue", "Authorization": "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()}
    opener = urllib.request.build_opener(_NoRedirect)
    for _ in range(3):
        try:
            with opener.open(urllib.request.Request(url, r["body"].encode(), headers, method="PUT"), timeout=timeout) as answer:
                said = json.loads(answer.read() or b"{}")
            break
        except urllib.error.HTTPError as e:
            if e.code not in (301, 302, 307, 308):
                raise SinkError(f"load of {r['path']} failed: {e.code} {e.read()[:200]!r}") from e
            to = urllib.parse.urlsplit(e.headers["Location"])
            host = node.split(":")[0] if to.hostname in ("127.0.0.1", "localhost", "::1") else to.hostname
            url = urllib.parse.urlunsplit((to.scheme, f"{host}:{to.port or 80}", to.path, to.query, ""))
    else:
        raise SinkError(f"load of {r['path']}: too many redirects")
    if said.get("Status") not in ("Success", "Publish Timeout", LABEL_TAKEN):
        raise SinkError(f"load of {r['path']} failed: {str(said)[:200]}")


def export_tsv(state: DataFrame, path: str, prefix: str, fields: list[str] | None = None) -> None:
    """Strings as ``key, value``, or hashes as ``key, fields...`` (missing ones empty)."""
    of_type = state.where(F.col("key").startswith(prefix) & (F.col("typ") == ("hash" if fields else "string")))
    columns: list[Column] = [F.coalesce(F.try_element_at("h", F.lit(f)), F.lit("")).alias(f) for f in fields] if fields else [F.coalesce("s", F.lit("")).alias("value")]
    of_type.select("key", *columns).write.mode("overwrite").option("sep", "\t").option("emptyValue", "").csv(path)


def export_report(differences: DataFrame, path: str, samples: int = 20) -> None:
    """Counts and sample keys by kind, as one JSON line a kind."""
    from keyflow.operators.verify import report

    report(differences, samples).write.mode("overwrite").json(path)
