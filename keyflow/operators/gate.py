"""Handoff from snapshot to log: what lies at or before the anchor is in the dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.position import literal_position

PHASE_RANK = {"snapshot": 0, "incremental": 1}


def after_anchor(pb_end: Column, filenum: int, offset: int) -> Column:
    """The entry ends after the anchor. A null end is kept: it cannot be in the dump."""
    return F.coalesce(pb_end > literal_position(filenum, offset), F.lit(True))


def gate(log: DataFrame, anchor: tuple[int, int] | None) -> DataFrame:
    """Entries to emit; without an anchor, all."""
    return log if anchor is None else log.where(after_anchor(F.col("pb_end"), *anchor))


def phase_rank(phase: Column) -> Column:
    return F.when(phase == "snapshot", PHASE_RANK["snapshot"]).otherwise(PHASE_RANK["incremental"])


def ordered_union(snapshot: DataFrame, incremental: DataFrame) -> DataFrame:
    """Both phases with their ``phase_rank``: order by it, then position, then seq."""
    both = snapshot.unionByName(incremental, allowMissingColumns=True)
    return both.withColumn("phase_rank", phase_rank(F.col("phase")))


def first_seen(events: DataFrame) -> DataFrame:
    """Without redeliveries: one event per position and seq (ids of chunked snapshot
    keys repeat, so the id alone would lose chunks)."""
    return events.withColumn("__p", F.struct("event_id", "source.filenum", "source.offset", "source.seq")).dropDuplicates(["__p"]).drop("__p")


def with_pb_end(log: DataFrame, next_start: Column) -> DataFrame:
    """Adds ``pb_end`` from the start of the following entry in the same file."""
    return log.withColumn("pb_end", F.struct(F.col("filenum"), next_start.alias("offset")))
