"""Verification: loss, order, duplication and full-state comparison of streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass
class Watch:
    """Keys ``prefix`` + number in [low, high]; ``skip`` > 0 leaves out its multiples,
    < 0 keeps only them; each key needs at least ``least`` events."""

    prefix: str
    low: int
    high: int
    least: int
    skip: int = 0

    @classmethod
    def parse(cls, spec: str) -> Watch:
        """``prefix:low-high[:skip]:least``."""
        parts = spec.strip().split(":")
        try:
            low, high = (int(x) for x in parts[1].split("-", 1))
            if len(parts) not in (3, 4):
                raise ValueError
            prefix = parts[0] if parts[0].endswith(":") else parts[0] + ":"
            return cls(prefix, low, high, int(parts[-1]), int(parts[2]) if len(parts) == 4 else 0)
        except (ValueError, IndexError):
            raise ValueError(f"bad watch {spec!r}") from None

    def holds(self, number: Column) -> Column:
        inside = number.between(self.low, self.high)
        if not self.skip:
            return inside
        multiple = F.pmod(number, F.lit(abs(self.skip))) == 0
        return inside & (~multiple if self.skip > 0 else multiple)


def suffix_number(key: Column, prefix: str) -> Column:
    return F.when(key.startswith(prefix), F.substring(key, len(prefix) + 1, 2**31 - 1).try_cast("bigint"))


def tally(events: DataFrame, prefixes: list[str]) -> DataFrame:
    """Events by first matching prefix: ``prefix, n, low, high`` of the key's number."""
    which = F.lit(None).cast("string")
    number = F.lit(None).cast("bigint")
    for p in reversed(prefixes):
        which = F.when(F.col("key").startswith(p), p).otherwise(which)
        number = F.when(F.col("key").startswith(p), suffix_number(F.col("key"), p)).otherwise(number)
    return events.select(which.alias("prefix"), number.alias("number")).where("prefix IS NOT NULL").groupBy("prefix").agg(F.count("*").alias("n"), F.min("number").alias("low"), F.max("number").alias("high"))


def watched(spark: SparkSession, events: DataFrame, watch: Watch) -> DataFrame:
    """Every key of the watch with its number of events: ``key, n, ok``, missing keys included."""
    wanted = spark.range(watch.low, watch.high + 1).where(watch.holds(F.col("id"))).select(F.concat(F.lit(watch.prefix), F.col("id").cast("string")).alias("key"))
    counts = events.where(F.col("phase") != "heartbeat").groupBy("key").agg(F.count("*").alias("n"))
    return wanted.join(counts, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) >= watch.least).alias("ok"))


def three_way(spark: SparkSession, events: DataFrame, watch: Watch, live: DataFrame) -> DataFrame:
    """Every key of the watch: ``key, n, ok, model, live, agrees``. The model is the state
    that the events replay to, ``live`` (``key, state`` as text) what the source holds;
    a key that neither has agrees."""
    from keyflow.operators.state import canonical, fold_states

    folded = fold_states(events.where(F.col("key").startswith(watch.prefix)))
    model = folded.where("typ != 'none'").select("key", canonical(folded).alias("model"))
    seen = watched(spark, events, watch).join(model, "key", "left").join(live.select("key", F.col("state").alias("live")), "key", "left")
    return seen.withColumn("agrees", F.col("model").eqNullSafe(F.col("live")))


def export_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two exports has, with their number: ``side, n`` and the rows'
    columns. Both need the same columns."""
    signed = left.withColumn("__n", F.lit(1)).unionByName(right.withColumn("__n", F.lit(-1)))
    more = signed.groupBy(*left.columns).agg(F.sum("__n").alias("__n")).where("__n != 0")
    return more.select(F.when(F.col("__n") > 0, "left").otherwise("right").alias("side"), F.abs("__n").alias("n"), *[F.col(f"`{c}`") for c in left.columns])


def backlog_tail(log: DataFrame, delivered: tuple[int, int] | None) -> DataFrame:
    """What is yet to be delivered, by file: ``filenum, entries, first, last`` offsets."""
    rest = log if delivered is None else log.where(F.struct("filenum", "offset") > F.struct(F.lit(delivered[0]).cast("bigint").alias("filenum"), F.lit(delivered[1]).cast("bigint").alias("offset")))
    return rest.groupBy("filenum").agg(F.count("*").alias("entries"), F.min("offset").alias("first"), F.max("offset").alias("last"))


def sampled(events: DataFrame, one_in: int) -> DataFrame:
    """The events of one key in ``one_in``, chosen by the first 32 bits of the key's md5."""
    return events.where(F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("bigint") % one_in == 0)


def order_violations(events: DataFrame, arrival: str, key: str | None = None) -> DataFrame:
    """Events at or before their predecessor's position, in arrival order; per ``key``, or
    (costly: one ordered pass) over all."""
    spec = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy(arrival)
    return events.withColumn("before", F.lag("pos").over(spec)).where(F.col("pos") <= F.col("before"))


def global_order_violations(events: DataFrame, arrival: str, span: int = 100_000) -> DataFrame:
    """The same over all events without one task for all: neighbours are compared inside
    spans of arrival numbers, and each span's first with the last of the span before."""
    spans = events.withColumn("__span", F.floor(F.col(arrival) / span))
    inside = spans.withColumn("before", F.lag("pos").over(Window.partitionBy("__span").orderBy(arrival)))
    lasts = spans.groupBy("__span").agg(F.max_by("pos", arrival).alias("last")).withColumn("__next", F.lead("__span").over(Window.orderBy("__span")))
    linked = inside.join(lasts.select(F.col("__next").alias("__span"), "last"), "__span", "left")
    return linked.withColumn("before", F.coalesce("before", "last")).where(F.col("pos") <= F.col("before")).drop("last", "__span")


def capture_gaps(log: DataFrame) -> DataFrame:
    """Entries that do not start where the one before them in their file ended:
    ``kind`` is gap, or redelivered for a start seen before. Needs ``filenum, offset,
    pb_end``; file by file, so files are compared in parallel."""
    spec = Window.partitionBy("filenum").orderBy("offset", "pb_end")
    seen = log.withColumn("end_before", F.lag("pb_end").over(spec)).withColumn("start_before", F.lag("offset").over(spec))
    kind = F.when(F.col("offset") == F.col("start_before"), "redelivered").when(F.col("offset") != F.col("end_before"), "gap")
    return seen.withColumn("kind", kind).where("kind IS NOT NULL").drop("start_before")


def audit(truth: DataFrame, events: DataFrame, anchor: tuple[int, int] | None = None) -> DataFrame:
    """Every position of either side with its ``kind``: ok, mismatch, missing, ghost,
    folded (at or before the anchor, so in the snapshot) or pending (truth after the
    last event). Both have ``filenum, offset, command, key``."""
    place = ["filenum", "offset"]
    a = truth.select(*place, F.upper("command").alias("t_command"), F.col("key").alias("t_key"), F.lit(True).alias("in_truth"))
    b = events.select(*place, F.upper("command").alias("e_command"), F.col("key").alias("e_key"), F.lit(True).alias("in_events"))
    last = b.agg(F.max(F.struct(*place)).alias("last"))
    at = F.struct(*place)
    folded = (at <= F.struct(F.lit(anchor[0]).cast("bigint").alias("filenum"), F.lit(anchor[1]).cast("bigint").alias("offset"))) if anchor else F.lit(False)
    both = a.join(b, place, "full_outer").join(F.broadcast(last))  # one row
    kind = (
        F.when(F.col("in_truth").isNull(), "ghost").when(F.col("in_events").isNotNull() & (F.col("t_command") == F.col("e_command")) & (F.col("t_key") == F.col("e_key")), "ok")
        .when(F.col("in_events").isNotNull(), "mismatch").when(folded, "folded").when(F.col("last").isNull() | (at > F.col("last")), "pending").otherwise("missing")
    )
    return both.select(*place, F.coalesce("t_key", "e_key").alias("key"), "t_command", "e_command", kind.alias("kind"))


def compare_states(source: DataFrame, target: DataFrame) -> DataFrame:
    """Keys that differ: ``key, kind, src, tgt``; kind is missing, extra or value. Both
    have ``key, state`` (text)."""
    both = source.select("key", F.col("state").alias("src")).join(target.select("key", F.col("state").alias("tgt")), "key", "full_outer")
    kind = F.when(F.col("tgt").isNull(), "missing").when(F.col("src").isNull(), "extra").when(F.col("src") != F.col("tgt"), "value")
    return both.withColumn("kind", kind).where("kind IS NOT NULL")


def report(differences: DataFrame, samples: int = 20) -> DataFrame:
    """``kind, n`` and the first ``samples`` keys of each kind by order. Ranks are cut
    inside hash shares of a kind before they meet, so a kind may hold any number."""
    share = F.pmod(F.xxhash64("key"), F.lit(64))
    some = differences.withColumn("r", F.row_number().over(Window.partitionBy("kind", share).orderBy("key"))).where(F.col("r") <= samples)
    keys = some.groupBy("kind").agg(F.slice(F.array_sort(F.collect_list("key")), 1, samples).alias("keys"))
    return differences.groupBy("kind").agg(F.count("*").alias("n")).join(keys, "kind")


def repeated_snapshot_keys(events: DataFrame) -> DataFrame:
    """Snapshot events that came more than once: same key and number."""
    return events.where("phase = 'snapshot'").groupBy("key", "source.seq").agg(F.count("*").alias("n")).where("n > 1")


def corrections_after_log(events: DataFrame, arrival: str) -> DataFrame:
    """Correction events that arrived after the first log event (they belong before)."""
    first = events.where("phase = 'incremental'").agg(F.min(arrival).alias("first_log"))
    return events.where("phase = 'correction'").join(F.broadcast(first)).where(F.col(arrival) > F.col("first_log")).drop("first_log")  # one row


def contiguous_prefix(work: DataFrame) -> DataFrame:
    """One row ``pos``: the last position before the first ``ord`` not yet ``done``."""
    first_open = work.agg(F.min(F.when(~F.col("done"), F.col("ord"))).alias("open"))
    return work.join(F.broadcast(first_open)).where(F.col("open").isNull() | (F.col("ord") < F.col("open"))).agg(F.max("pos").alias("pos"))
