"""File sources: event lines, ground-truth captures, raw log rows, Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.envelope import EVENT, from_json_lines

GT_SCHEMA = "f bigint, o bigint, pef bigint, peo bigint, cmd string, key string, argc int, ex bigint, bad string, raw string"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events from JSON lines; malformed lines are kept apart by ``malformed``."""
    return from_json_lines(spark.read.text(path))


def stream_events(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", max_files).json(path)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Independent captures: undecodable records left out, commands upper-cased, a
    missing end is the start. ``filenum, offset, end_filenum, end_offset, command, key``."""
    rows = spark.read.schema(GT_SCHEMA).json(path).where(F.coalesce("bad", F.lit("")) == "")
    return rows.select(
        F.col("f").alias("filenum"), F.col("o").alias("offset"), F.coalesce("pef", "f").alias("end_filenum"), F.coalesce("peo", "o").alias("end_offset"),
        F.upper("cmd").alias("command"), "key",
    )


def read_topic(spark: SparkSession, brokers: str, topic: str, stream: bool = False) -> DataFrame:
    """Events of a Kafka topic, all partitions from the first offset (needs Spark's
    Kafka connector on the class path)."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", brokers)
    lines = reader.option("subscribe", topic).option("startingOffsets", "earliest").load()
    return from_json_lines(lines.select(F.col("value").cast("string").alias("value")))
