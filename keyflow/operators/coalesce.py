"""Write coalescing: the mutations of a row, folded into the one that counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_COLS = "CAST(map() AS MAP<STRING, STRING>)"


def coalesce_rows(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One mutation per ``keys``: ``keys, first, last, del, reset, cols``.

    ``rows`` has the keys, ``cols`` (map), ``del`` and ``order`` (comparable, unique
    within a key). Upserts merge column by column, the last value wins; a deletion
    wipes what was before it. If a row is deleted and then written again, the result
    is an upsert of the later columns with ``reset`` true: columns that it lacks are
    to be cleared, not kept. ``first`` and ``last`` are the key's first and last place.

    One pass over the rows: each column's last value is found first (combined before
    it is shuffled, so that a hot key is no burden), then the columns of a key meet
    with its last deletion, which decides which of them live.
    """
    names = list(keys)
    cells = rows.select(*names, order, "del", F.explode_outer(F.when(~F.col("del"), F.col("cols"))).alias("k", "v"))
    latest = cells.groupBy(*names, "k").agg(
        F.min(order).alias("first"), F.max(order).alias("last"), F.max(F.when(F.col("del"), F.col(order))).alias("wiped"), F.max_by(F.struct("v"), order).alias("v")
    )
    met = latest.groupBy(*names).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("wiped").alias("wiped"),
        F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", F.col("v.v").alias("v"), F.col("last").alias("at")))).alias("cells"),
    )
    gone = F.coalesce(F.col("wiped") == F.col("last"), F.lit(False))
    live = F.filter("cells", lambda c: F.col("wiped").isNull() | (c["at"] > F.col("wiped")))
    return met.select(
        *names, "first", "last", gone.alias("del"), (F.col("wiped").isNotNull() & ~gone).alias("reset"),
        F.map_from_entries(F.array_sort(F.transform(live, lambda c: F.struct(c["k"].alias("k"), c["v"].alias("v"))))).alias("cols"),
    )


def apply_to_table(target: DataFrame, changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Target rows (``keys, cols``) after the coalesced ``changes``."""
    names = list(keys)
    old, new = F.coalesce("old", F.expr(NO_COLS)), F.coalesce("cols", F.expr(NO_COLS))
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
    both = target.select(*names, F.col("cols").alias("old")).join(changes.select(*names, "del", "reset", "cols"), names, "full_outer")
    return both.where(~F.coalesce("del", F.lit(False))).select(*names, F.when(F.coalesce("reset", F.lit(False)), new).otherwise(F.map_concat(kept, new)).alias("cols"))
