"""Per-key state: replaying commands in order.

``KeyState`` is the fold itself, shared by batch and streaming. ``fold_hashes`` is
the same for logs of hashes, strings and deletions, with grouped aggregates only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATE_SCHEMA = (
    "key string, typ string, s string, h map<string,string>, l array<string>, st array<string>, z map<string,string>, events bigint"
)


@dataclass
class KeyState:
    """State of one key; ``apply`` follows the source's rules for the commands that it
    models and leaves the state alone for all others. A write to a key of another
    type is refused, only SET and its like and deletions cross types; a collection
    that becomes empty is gone."""

    typ: str = "none"
    value: object = None
    events: int = 0
    expires_at: int | None = field(default=None)

    def _open(self, typ: str, empty) -> bool:
        if self.typ == "none":
            self.typ, self.value = typ, empty
        return self.typ == typ

    def _close_if_empty(self) -> None:
        if not self.value:
            self.typ, self.value = "none", None

    def apply(self, command: str, argv: list[str], phase: str = "incremental") -> bool:
        """Whether the command was modelled. Heartbeats neither change nor count."""
        if phase == "heartbeat":
            return True
        self.events += 1
        name, n = command.upper(), len(argv)
        pairs = n >= 4 and n % 2 == 0
        match name:
            case "SET" | "GETSET" if n >= 3:
                self.typ, self.value = "string", argv[2]
            case "SETEX" | "PSETEX" | "PKSETEXAT" if n >= 4:
                self.typ, self.value = "string", argv[3]
            case "DEL" | "UNLINK":
                self.typ, self.value = "none", None
            case "HSET" | "HMSET" if pairs and self._open("hash", {}):
                self.value.update(zip(argv[2::2], argv[3::2], strict=True))
            case "HDEL" if n >= 3 and self.typ == "hash":
                for f in argv[2:]:
                    self.value.pop(f, None)
                self._close_if_empty()
            case "RPUSH" if n >= 3 and self._open("list", []):
                self.value.extend(argv[2:])
            case "LPUSH" if n >= 3 and self._open("list", []):
                self.value[:0] = argv[:1:-1]
            case "LPOP" | "RPOP" if self.typ == "list":
                self.value.pop(0 if name == "LPOP" else -1)
                self._close_if_empty()
            case "SADD" if n >= 3 and self._open("set", set()):
                self.value.update(argv[2:])
            case "SREM" if n >= 3 and self.typ == "set":
                self.value.difference_update(argv[2:])
                self._close_if_empty()
            case "ZADD" if pairs and self._open("zset", {}):
                # Scores stay as they were written; ``canonical`` reads them as numbers.
                self.value.update(zip(argv[3::2], argv[2::2], strict=True))
            case "ZREM" if n >= 3 and self.typ == "zset":
                for m in argv[2:]:
                    self.value.pop(m, None)
                self._close_if_empty()
            case _:
                return False
        return True

    def row(self, key: str) -> tuple:
        of = lambda typ: self.value if self.typ == typ else None
        members = of("set")
        return (key, self.typ, of("string"), of("hash"), of("list"), sorted(members) if members is not None else None, of("zset"), self.events)


def fold_states(events: DataFrame) -> DataFrame:
    """STATE of every key after all ``events`` (``key, phase, command, args`` and
    ``source``), snapshot before log, in position order.

    Keys are dealt out by hash and sorted within partitions; a task folds them one
    after another as they stream by, holding one key's state, never its events.
    """
    order = ["key", "rank", "filenum", "offset", "seq"]
    rows = events.where("phase != 'heartbeat'").select(
        "key", (F.col("phase") != "snapshot").cast("int").alias("rank"), "source.filenum", "source.offset", "source.seq", "phase", "command", "args"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in STATE_SCHEMA.replace("map<string,", "map<").split(", ")]
        key, state, out = None, None, []
        for batch in batches:
            for k, phase, command, args in zip(batch["key"], batch["phase"], batch["command"], batch["args"], strict=True):
                if state is None or k != key:
                    if state is not None:
                        out.append(state.row(key))
                    key, state = k, KeyState()
                state.apply(command or "", list(args), phase)
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if state is not None:
            out.append(state.row(key))
        yield pd.DataFrame(out, columns=names)

    return rows.repartition("key").sortWithinPartitions(*order).mapInPandas(run, STATE_SCHEMA)


def fold_hashes(events: DataFrame) -> DataFrame:
    """``key, field, value`` of all live hashes, for logs in which a key is only ever a
    hash (HSET, HMSET) or deleted; no Python, one shuffle of partial results a step."""
    at = F.struct("source.filenum", "source.offset", "source.seq")
    name = F.upper("command")
    pairs = F.transform(F.sequence(F.lit(3), F.size("args") - 1, F.lit(2)), lambda i: F.struct(F.element_at("args", i).alias("field"), F.element_at("args", i + 1).alias("value"), i.alias("i")))
    gone = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), F.lit(0).alias("i")))
    # A deletion is a cell without a field: one pass finds the last of each.
    steps = F.when(name.isin("DEL", "UNLINK"), gone).when(name.isin("HSET", "HMSET") & (F.size("args") >= 4), pairs)
    cells = events.select("key", at.alias("at"), F.explode(steps).alias("p")).select("key", "p.field", "p.value", F.struct("at", "p.i").alias("at"))
    latest = cells.groupBy("key", "field").agg(F.max("at").alias("at"), F.max_by("value", "at").alias("value"))
    wiped = F.max(F.when(F.col("field").isNull(), F.col("at.at"))).over(Window.partitionBy("key"))
    live = latest.withColumn("wiped", wiped).where("field IS NOT NULL AND (wiped IS NULL OR at.at > wiped)")
    return live.select("key", "field", "value")


def canonical(state: DataFrame):
    """One text per state: members sorted (lists in order), scores as numbers where they
    are some, else as written."""
    scores = F.transform_values(F.col("z"), lambda k, v: F.coalesce(v.cast("string").try_cast("double").cast("string"), v.cast("string")))
    joined = lambda m: F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",")
    return (
        F.when(F.col("typ") == "string", F.concat(F.lit("string:"), "s")).when(F.col("typ") == "hash", F.concat(F.lit("hash{"), joined(F.col("h")), F.lit("}")))
        .when(F.col("typ") == "zset", F.concat(F.lit("zset{"), joined(scores), F.lit("}")))
        .when(F.col("typ") == "list", F.concat(F.lit("list["), F.array_join("l", ","), F.lit("]")))
        .when(F.col("typ") == "set", F.concat(F.lit("set{"), F.array_join(F.array_sort("st"), ","), F.lit("}"))).otherwise("none")
    )
