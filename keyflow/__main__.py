"""``python -m keyflow -c config.yaml``: run a configured pipeline."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from keyflow import config as configuration
from keyflow.streaming import runner, sinks

VERSION = "0.1.0"


def sink_of(c: configuration.Config, run: str = "") -> runner.Sink:
    if k := c.sink.kafka:
        return lambda batch, _: sinks.write_topic(batch, ",".join(k.brokers), k.topic, k.compression, k.include_heartbeats, k.client_id, k.batch_bytes, k.partitions)
    if f := c.sink.file:
        return lambda batch, _: sinks.write_lines(batch, f.path, f.include_heartbeats)
    p = c.pipeline
    if p.driver == "doris":
        return lambda batch, n: sinks.send_loads(sinks.load_requests(sinks.batch_rows(batch, p.rules), n, p.sequence_column, chunk=p.max_batch_rows, run=run, source_id=c.source.source_id), p.fenodes, p.user, p.password)
    module = {"sqlite": "sqlite3", "postgres": "psycopg2", "pgx": "psycopg2", "mysql": "pymysql"}[p.driver]
    return lambda batch, _: sinks.write_sql(sinks.batch_rows(batch, p.rules), sinks.Connector(module, p.dsn), p.driver, p.max_batch_rows)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="keyflow")
    parser.add_argument("-c", metavar="CONFIG", help="configuration file")
    parser.add_argument("-version", action="store_true", help="print the version")
    parser.add_argument("-once", action="store_true", help="take what is there, then end")
    found = parser.parse_args(args)
    if found.version:
        print(VERSION)
        return 0
    if not found.c:
        parser.print_usage(sys.stderr)
        return 2
    try:
        c = configuration.load(found.c)
    except (OSError, configuration.ConfigError) as e:
        print(f"keyflow: {e}", file=sys.stderr)
        return 1
    spark = SparkSession.builder.appName("keyflow").getOrCreate()
    control = runner.Control(c.checkpoint, c.source.source_id).load()
    sink = sink_of(c, control.run_id)
    if c.snapshot and not control.snapshot_done:
        state = spark.read.parquet(c.snapshot)
        with_info = spark.read.text(f"{c.snapshot.rstrip('/')}.info", wholetext=True).first()[0]
        from keyflow.functions.info import anchor_of

        runner.run_snapshot(state, control, anchor_of(with_info), sink, c.source.db, lifetimes=c.include_ttl)
    metrics = runner.Metrics()
    if c.metrics:
        runner.serve_metrics(metrics, c.metrics)
    listener = runner.MetricsListener(metrics)
    spark.streams.addListener(listener)
    trigger = None if found.once else f"{configuration.seconds(c.pipeline.flush_every if c.pipeline else '1s')} seconds"
    running = []

    def make():
        events = runner.log_stream(spark, c.source.path, control, c.source.db, c.source.max_bytes, c.source.session_id, c.source.start)
        running[:] = [runner.start(runner.observed(events), sink, runner.stream_checkpoint(c.checkpoint, c.source.start), trigger)]
        return running[0]

    if found.once:
        runner.drain(make)
        spark.streams.removeListener(listener)
    else:
        behind = runner.behind_of(c.source.path, lambda: running[0] if running else None)
        beat = runner.heartbeat_to(sink, spark, control, c.source.path, c.source.db)
        runner.supervise(make, stall=configuration.seconds(c.stall), behind=behind, idle=configuration.seconds(c.heartbeat), beat=beat)
    return 0


if __name__ == "__main__":
    sys.exit(main())
