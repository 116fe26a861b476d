"""Pipelines: snapshot job, log stream, supervision and metrics.

The snapshot is a batch job at its anchor; the log is a streaming query from there.
Both write through the same sink function ``(batch, batch_id)``. Offsets advance only
after the sink returned, so deliveries are at least once and sinks idempotent.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from keyflow.functions.decode import decode_log
from keyflow.functions.envelope import to_events
from keyflow.operators.gate import gate
from keyflow.operators.snapshot import scan, snapshot_events
from keyflow.sources.log_source import LogStreamReader, register
from keyflow.sources.shared import shared_dir

Sink = Callable[[DataFrame, int], None]


class SourceMismatch(RuntimeError):
    pass


@dataclass
class Control:
    """Small control file beside the streaming checkpoint: whose log this is, the
    anchor, whether the snapshot has been written, and a random id that is the
    checkpoint's own, so that what is labelled with it is never taken for another's."""

    uri: str
    source_id: str
    anchor: tuple[int, int] | None = None
    snapshot_done: bool = False
    stages_done: list[int] = field(default_factory=list)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def _place(self) -> tuple[pafs.FileSystem, str]:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        fs.create_dir(root, recursive=True)
        return fs, f"{root}/control.json"

    def load(self) -> Control:
        fs, path = self._place()
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            self.save()  # so that the id is kept before anything is labelled with it
            return self
        with fs.open_input_stream(path) as f:
            kept = json.loads(f.read())
        if kept["source_id"] != self.source_id:
            raise SourceMismatch(f"the checkpoint belongs to {kept['source_id']}, not {self.source_id}")
        self.anchor = tuple(kept["anchor"]) if kept["anchor"] else None
        self.snapshot_done, self.run_id = kept["snapshot_done"], kept.get("run_id", self.run_id)
        self.stages_done = kept.get("stages_done", [])
        return self

    def save(self) -> None:
        """Whole or not at all: written aside, then renamed."""
        fs, path = self._place()
        with fs.open_output_stream(path + ".new") as f:
            f.write(json.dumps({"source_id": self.source_id, "anchor": self.anchor, "snapshot_done": self.snapshot_done, "stages_done": self.stages_done, "run_id": self.run_id}).encode())
        fs.move(path + ".new", path)


def run_snapshot(state: DataFrame, control: Control, anchor: tuple[int, int], sink: Sink, db: str = "db0", **scan_options) -> None:
    """Write the snapshot unless it is done, type by type in scan order; each is recorded
    as done after the sink returned, so that a run that was cut short goes on after the
    last one. A scan of the same state at the same anchor numbers its events alike."""
    if control.snapshot_done:
        return
    if control.anchor != anchor:
        control.anchor, control.stages_done = anchor, []
        control.save()
    events = snapshot_events(scan(state, **scan_options), anchor, control.source_id, db)
    for stage in sorted(r.stage for r in events.select("stage").distinct().collect()):  # five at most
        if stage in control.stages_done:
            continue
        sink(events.where(F.col("stage") == stage).drop("stage"), -1 - stage)
        control.stages_done.append(stage)
        control.save()
    control.snapshot_done = True
    control.save()


def log_stream(spark: SparkSession, uri: str, control: Control, db: str = "db0", max_bytes: int = 0, session_id: int | None = None, start: str = "", lane: int = 0, lanes: int = 1) -> DataFrame:
    """Streaming events of a log directory, after the anchor. Undecodable entries are
    left out here; ``bad_stream`` has them. ``start``: see ``resolved_start``."""
    register(spark)
    options = {"maxbytes": max_bytes, "startingoffsets": starting_offsets(start), "lane": lane, "lanes": lanes}
    raw = spark.readStream.format("keyflow_log").options(**options).load(uri)
    return to_events(gate(decode_log(raw, session_id)[0], control.anchor), control.source_id, db)


def log_lanes(spark: SparkSession, *args, **options) -> list[DataFrame]:
    """The streams of ``log_stream`` by file, as many as the session has cores, 4 at most
    (each keeps a Python process of some 60 MB at the driver). A small batch mostly waits
    for its bookkeeping, so streams side by side drain a long log sooner. Each keeps its
    own files in order; across them there is none."""
    lanes = max(1, min(4, spark.sparkContext.defaultParallelism))
    return [log_stream(spark, *args, lane=i, lanes=lanes, **options) for i in range(lanes)]


def starting_offsets(start: str) -> str:
    """``earliest`` (also for no start), ``latest``, or ``FILE:BYTE`` as the source's offset."""
    if start in ("", "earliest", "latest"):
        return start or "earliest"
    file, _, byte = start.partition(":")
    return json.dumps({"file": int(file), "byte": int(byte)})


def stream_checkpoint(checkpoint: str, start: str) -> str:
    """Where a query keeps its offsets. An explicit start comes before what a checkpoint
    without it has kept, so it has a checkpoint of its own, in which it then goes on;
    without one, the checkpoint comes before the log's first entry."""
    return f"{checkpoint}/stream" + (f"-from-{start.replace(':', '-')}" if start else "")


def bad_stream(spark: SparkSession, uri: str, session_id: int | None = None) -> DataFrame:
    register(spark)
    return decode_log(spark.readStream.format("keyflow_log").load(uri), session_id)[1]


def start(events: DataFrame, sink: Sink, checkpoint: str, trigger: str | None = "1 second", name: str | None = None) -> StreamingQuery:
    """Start the query; without a trigger interval it takes what is there and ends."""
    writer = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def supervise(
    make: Callable[[], StreamingQuery], restarts: int = 5, pause: float = 1.0, stall: float = 0.0, behind: Callable[[], bool] | None = None,
    idle: float = 0.0, beat: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Run a query to its end; start it anew from its checkpoint when it fails, or when it
    made no progress for ``stall`` seconds although ``behind`` says there is more. After
    each ``idle`` seconds without rows, ``beat`` is called."""
    left, rested = restarts, time.time()
    while True:
        query, seen, since = make(), None, time.time()
        try:
            while not query.awaitTermination(0.2):
                now = (query.lastProgress or {}).get("batchId")
                if now != seen:
                    seen, since = now, time.time()
                    rested = since if (query.lastProgress or {}).get("numInputRows") else rested
                if beat and idle and time.time() - rested > idle:
                    beat()
                    rested = time.time()
                if stall and time.time() - since > stall and behind and behind():
                    query.stop()
                    raise TimeoutError(f"no progress for {stall} s")
            return query
        except Exception:
            if not left:
                raise
            left -= 1
            time.sleep(pause)


def collected(stream: DataFrame | list[DataFrame], mode: str = "append", bounded: bool = False) -> DataFrame:
    """Run a stream, or several side by side, over all that is there and read what they
    gave: the batches appended, or, in complete mode, the last one of the only stream. A
    source in ``bounded`` batches would fix its end after one batch if it were to take what
    is available when its query starts; that query runs until it finds nothing new.
    Checkpoint and output go to the folder that ``spark.checkpoint.dir`` names (a temporary
    one where it is unset)."""
    streams = stream if isinstance(stream, list) else [stream]
    spark = streams[0].sparkSession
    place = f"{shared_dir(spark)}/keyflow-{uuid.uuid4().hex}"

    def writer(lane: int):
        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{place}/out" if mode == "complete" else f"{place}/out/lane={lane}/batch={number}")

        out = streams[lane].writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{place}/checkpoint-{lane}")
        return out if bounded else out.trigger(availableNow=True)

    def run(writer) -> None:
        query = writer.start()
        try:
            query.processAllAvailable() if bounded else query.awaitTermination()
        finally:
            query.stop()

    with ThreadPoolExecutor(len(streams)) as pool:
        list(pool.map(run, [writer(lane) for lane in range(len(streams))]))
    return spark.read.schema(streams[0].schema).parquet(f"{place}/out").select(*streams[0].columns)


def drain(make: Callable[[], StreamingQuery], restarts: int = 5, pause: float = 1.0) -> None:
    """Take all that is there, in bounded batches: a query that takes what is available
    fixes its end when it starts, so it is run again until it finds nothing new."""
    while True:
        query = supervise(make, restarts, pause)
        if not any(p["numInputRows"] for p in query.recentProgress):
            return


def with_heartbeat(batch: DataFrame, control: Control, at: tuple[int, int], db: str = "db0") -> DataFrame:
    """The batch and one heartbeat at the given position."""
    from keyflow.functions.envelope import EVENT, heartbeat

    beat = batch.sparkSession.range(1).select(heartbeat(control.source_id, db, F.lit(at[0]), F.lit(at[1]), F.unix_timestamp()).alias("e")).select("e.*")
    return batch.select(*[f.name for f in EVENT.fields]).unionByName(beat)


def heartbeat_to(sink: Sink, spark: SparkSession, control: Control, uri: str, db: str = "db0") -> Callable[[], None]:
    """Sends one heartbeat at the log's end through the sink."""

    def beat() -> None:
        from keyflow.functions.envelope import EVENT

        end = LogStreamReader({"path": uri}).latestOffset()
        sink(with_heartbeat(spark.createDataFrame([], EVENT), control, (end["file"], end["byte"]), db), -2)

    return beat


def behind_of(uri: str, query: Callable[[], StreamingQuery | None]) -> Callable[[], bool]:
    """Whether the log goes on after what the query has taken."""

    def behind() -> bool:
        progress = query() and query().lastProgress
        taken = json.loads(progress["sources"][0]["endOffset"] or "null") if progress and isinstance(progress["sources"][0]["endOffset"], str) else (progress["sources"][0]["endOffset"] if progress else None)
        end = LogStreamReader({"path": uri}).latestOffset()
        return taken is None or (end["file"], end["byte"]) > (taken["file"], taken["byte"])

    return behind


def serve_metrics(metrics: Metrics, listen: str) -> ThreadingHTTPServer:
    """``/metrics`` and ``/healthz`` at ``host:port``, served by a thread."""

    class Page(BaseHTTPRequestHandler):
        def do_GET(self):
            body = {"/metrics": metrics.text(), "/healthz": "ok\n"}.get(self.path)
            data = (body or "not found\n").encode()
            self.send_response(200 if body else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    host, _, port = listen.rpartition(":")
    server = ThreadingHTTPServer((host or "0.0.0.0", int(port)), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server


@dataclass
class Metrics:
    """Counters of a run, as text for a scraper."""

    values: dict[str, float] = field(default_factory=dict)
    began: float = field(default_factory=time.time)

    def add(self, name: str, by: float = 1) -> None:
        self.values[name] = self.values.get(name, 0) + by

    def set(self, name: str, to: float) -> None:
        self.values[name] = to

    def text(self) -> str:
        rows = {**self.values, "keyflow_uptime_seconds": round(time.time() - self.began, 3)}
        return "".join(f"{k} {v:g}\n" for k, v in sorted(rows.items()))


class MetricsListener(StreamingQueryListener):
    """Feeds ``Metrics`` from the progress of streaming queries and from the observed
    aggregates ``keyflow`` (see ``observed``)."""

    def __init__(self, metrics: Metrics):
        self.metrics = metrics

    def onQueryStarted(self, event) -> None:
        self.metrics.add("keyflow_queries_started_total")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.metrics.add("keyflow_entries_received_total", p.numInputRows)
        seen = p.observedMetrics.get("keyflow")
        if seen is not None:
            self.metrics.add("keyflow_events_emitted_total", seen["events"])
            for name in ("delivered", "lag_s"):
                if seen[name] is not None:
                    self.metrics.set({"delivered": "keyflow_delivered_position", "lag_s": "keyflow_source_lag_seconds"}[name], seen[name])

    def onQueryIdle(self, event) -> None:
        self.metrics.add("keyflow_idle_total")

    def onQueryTerminated(self, event) -> None:
        self.metrics.add("keyflow_queries_failed_total" if event.exception else "keyflow_queries_ended_total")


def observed(events: DataFrame) -> DataFrame:
    from keyflow.functions.position import sequence_number

    place = sequence_number(F.col("source.filenum"), F.col("source.offset"))
    lag = F.greatest(F.lit(0), F.unix_timestamp(F.current_timestamp()) - F.col("source.exec_time_s"))
    return events.observe("keyflow", F.count("*").alias("events"), F.max(place).alias("delivered"), F.min(lag).alias("lag_s"))
