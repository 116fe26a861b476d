"""``python -m keyflow.tools COMMAND``: look at, check and make event streams.

Every checking command prints JSON lines and ends with 1 if it found a fault.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.envelope import EVENT, described, to_events
from keyflow.functions.position import position
from keyflow.operators import verify
from keyflow.operators.state import canonical, fold_states
from keyflow.sources import files, workload
from keyflow.streaming import sinks

WORKLOADS = {"preload": workload.preload, "striped": workload.striped_load, "probe": lambda spark, _: workload.probe(spark)}


def _anchor(text: str) -> tuple[int, int]:
    filenum, _, offset = text.partition(":")
    return int(filenum), int(offset)


def _shown(df: DataFrame, limit: int = 1000) -> list[dict]:
    """Rows of a report, printed. Reports are short: a row a kind, prefix or watch."""
    rows = [json.loads(r[0]) for r in df.select(F.to_json(F.struct("*"))).limit(limit).collect()]
    for r in rows:
        print(json.dumps(r, ensure_ascii=False))
    return rows


def _events(spark: SparkSession, path: str) -> DataFrame:
    return files.read_events(spark, path).where("NOT malformed")


def peek(spark, a) -> int:
    rows = _events(spark, a.events)
    for r in rows.select(described(rows).alias("line")).limit(a.n).collect():
        print(r.line)
    return 0


def load(spark, a) -> int:
    sinks.write_lines(to_events(WORKLOADS[a.kind](spark, a.keys), a.source, phase="incremental"), a.out)
    return 0


def mutate(spark, a) -> int:
    sinks.write_lines(to_events(workload.mutations(spark, a.operations, a.keys, a.start), a.source), a.out)
    return 0


def verify_events(spark, a) -> int:
    events, wrong = _events(spark, a.events), 0
    if a.sample > 1:
        events = verify.sampled(events, a.sample)
    if a.prefix:
        _shown(verify.tally(events, a.prefix))
    for spec in a.watch:
        seen = verify.watched(spark, events, verify.Watch.parse(spec))
        found = seen.agg(F.count("*").alias("keys"), F.count_if(~F.col("ok")).alias("short"), F.min(F.when(~F.col("ok"), F.col("key"))).alias("first")).withColumn("watch", F.lit(spec))
        wrong += _shown(found)[0]["short"]
    if a.repeated:
        wrong += _shown(verify.repeated_snapshot_keys(events).agg(F.count("*").alias("repeated_snapshot_events")))[0]["repeated_snapshot_events"]
    return int(wrong > 0)


def audit(spark, a) -> int:
    events = _events(spark, a.events).where("phase = 'incremental'").select("source.filenum", "source.offset", "command", "key")
    found = verify.audit(files.read_truth(spark, a.truth), events, _anchor(a.anchor) if a.anchor else None)
    kinds = {r["kind"]: r["n"] for r in _shown(found.groupBy("kind").agg(F.count("*").alias("n")))}
    return int(any(kinds.get(k) for k in ("missing", "ghost", "mismatch")))


def _states(spark, path: str, prefix: str) -> DataFrame:
    state = fold_states(_events(spark, path).where(F.col("key").startswith(prefix)))
    return state.where("typ != 'none'").select("key", canonical(state).alias("state"))


def compare(spark, a) -> int:
    return int(bool(_shown(verify.report(verify.compare_states(_states(spark, a.source, a.prefix), _states(spark, a.target, a.prefix)), a.samples))))


def ordchk(spark, a) -> int:
    """Lines keep their order inside a file, and files are named in theirs."""
    lines = spark.read.text(a.events).select("value", F.monotonically_increasing_id().alias("line"))
    events = lines.select(F.from_json("value", EVENT).alias("e"), "line").where("e.phase = 'incremental'").select("e.key", "line", position(F.col("e.source.filenum"), F.col("e.source.offset")).alias("pos"))
    late = verify.order_violations(events, "line", "key").agg(F.count("*").alias("key_violations"), F.min("key").alias("first_key"))
    wrong = _shown(late)[0]["key_violations"]
    if a.whole:
        wrong += _shown(verify.global_order_violations(events, "line").agg(F.count("*").alias("violations")))[0]["violations"]
    return int(wrong > 0)


def replay(spark, a) -> int:
    sinks.export_tsv(fold_states(_events(spark, a.events)), a.out, a.prefix, a.fields or None)
    return 0


def diff(spark, a) -> int:
    left, right = (spark.read.option("sep", "\t").csv(p) for p in (a.left, a.right))
    return int(bool(_shown(verify.export_difference(left, right), a.samples)))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="keyflow.tools", description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name, run, *arguments):
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        for flag, options in arguments:
            p.add_argument(flag, **options)

    needed = {"required": True}
    command("peek", peek, ("--events", needed), ("-n", {"type": int, "default": 20}))
    command("load", load, ("--out", needed), ("--kind", {"choices": sorted(WORKLOADS), "default": "striped"}), ("--keys", {"type": int, "default": 1000}), ("--source", {"default": "load"}))
    command("mutate", mutate, ("--out", needed), ("--operations", {"type": int, "default": 1000}), ("--keys", {"type": int, "default": 100}), ("--start", {"type": int, "default": 0}), ("--source", {"default": "load"}))
    command("verify", verify_events, ("--events", needed), ("--prefix", {"action": "append", "default": []}), ("--watch", {"action": "append", "default": []}), ("--sample", {"type": int, "default": 1}), ("--repeated", {"action": "store_true"}))
    command("audit", audit, ("--events", needed), ("--truth", needed), ("--anchor", {"default": ""}))
    command("compare", compare, ("--source", needed), ("--target", needed), ("--prefix", {"default": ""}), ("--samples", {"type": int, "default": 20}))
    command("ordchk", ordchk, ("--events", needed), ("--whole", {"action": "store_true"}))
    command("replay", replay, ("--events", needed), ("--out", needed), ("--prefix", {"default": ""}), ("--fields", {"nargs": "*", "default": []}))
    command("diff", diff, ("left", {}), ("right", {}), ("--samples", {"type": int, "default": 20}))
    return top


def main(args: list[str] | None = None) -> int:
    found = parser().parse_args(args)
    return found.run(SparkSession.builder.appName("keyflow-tools").getOrCreate(), found)


if __name__ == "__main__":
    sys.exit(main())
