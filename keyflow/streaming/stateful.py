"""Streaming state: per-key replay and duplicate removal across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyflow.operators.state import KeyState

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT_SCHEMA = "key string, typ string, s string, members string, events bigint, filenum bigint, offset bigint"


class ReplayProcessor(StatefulProcessor):
    """Folds a key's events in order; an event at or before the last position applied
    is a redelivery and is dropped, so replays after a restart change nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "data string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        import json

        kept = json.loads(self.state.get()[0]) if self.state.exists() else {"typ": "none", "value": None, "events": 0, "at": None}
        one = KeyState(kept["typ"], set(kept["value"]) if kept["typ"] == "set" else kept["value"], kept["events"])
        at = tuple(kept["at"]) if kept["at"] else None
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["rank", "filenum", "offset", "seq"], kind="stable")
        for r in batch.itertuples(index=False):
            place = (int(r.rank), int(r.filenum), int(r.offset), int(r.seq))
            if at is not None and place <= at:
                continue
            one.apply(r.command or "", list(r.args), r.phase)
            at = place
        value = sorted(one.value) if one.typ == "set" else one.value
        self.state.update((json.dumps({"typ": one.typ, "value": value, "events": one.events, "at": at}),))
        text = value if one.typ == "string" else None
        members = json.dumps(value, sort_keys=True, ensure_ascii=False) if one.typ not in ("string", "none") else None
        yield pd.DataFrame([(key[0], one.typ, text, members, one.events, at[1] if at else None, at[2] if at else None)], columns=[c.split(" ")[0] for c in OUT_SCHEMA.split(", ")])

    def close(self) -> None:
        pass


def replay_stream(events: DataFrame) -> DataFrame:
    """State of each key after each micro-batch that touched it (update mode).

    Needs the RocksDB state store: set ``spark.sql.streaming.stateStore.providerClass``
    to ``STATE_PROVIDER``.
    """
    rows = events.where("phase != 'heartbeat'").select(
        "key", (F.col("phase") != "snapshot").cast("int").alias("rank"), "source.filenum", "source.offset", "source.seq", "phase", "command", "args"
    )
    return rows.groupBy("key").transformWithStateInPandas(ReplayProcessor(), OUT_SCHEMA, "Update", "None")


def without_redeliveries(events: DataFrame, horizon: str | None = None) -> DataFrame:
    """Stream without events seen before, told by source, phase, position and number.

    An event that was not seen before is never left out, however old it is; the state
    is four numbers and a text an event, kept by the RocksDB state store on disk.
    ``horizon`` bounds it: then positions are forgotten, and events dropped, that are
    older than the newest by that much execution time. Only a source that cannot
    deliver older files late may be read so.
    """
    place = ["__source", "phase", "__file", "__offset", "__seq"]
    named = events.withColumns({"__source": F.col("source.id"), "__file": F.col("source.filenum"), "__offset": F.col("source.offset"), "__seq": F.col("source.seq")})
    if horizon is None:
        return named.dropDuplicates(place).drop("__source", "__file", "__offset", "__seq")
    timed = named.withColumn("__at", F.timestamp_seconds("source.exec_time_s")).withWatermark("__at", horizon)
    return timed.dropDuplicatesWithinWatermark(place).drop("__source", "__file", "__offset", "__seq", "__at")
