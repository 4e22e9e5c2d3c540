"""The Spark session that the lake needs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .config import Config

#: Results depend on the first four.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",  # hour=05 stays '05'
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build(cfg: Config = Config(), master: str | None = None, **settings: str) -> SparkSession:  # noqa: B008
    """A session with the lake's settings. Memory, cores and spill folders are the cluster's own (spark.executor.memory and so on)."""
    builder = SparkSession.builder.appName("eventlake")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(cfg.shuffle_partition_bytes), **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepared(spark: SparkSession) -> SparkSession:
    """A session of its own settings for the lake, beside one that belongs to somebody else."""
    own = spark.newSession()
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return own
