"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """As ``spark.checkpoint.dir`` names it. Only a local session without that setting
    gets a temporary one; on a cluster a machine's own folder would lose rows."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="keyflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(df: DataFrame, place: str) -> DataFrame:
    """Write ``df`` and read it back: lineage ends here."""
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
