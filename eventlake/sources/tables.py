"""Reading the layers. Existence is looked up first: a missing layer has an error, or an empty result, of its own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Config
from .store import Store


class BronzeNotFoundError(Exception):
    """No bronze file for the hour."""


class SilverEmptyError(Exception):
    """There is no silver partition yet."""


class GoldNotBuiltError(Exception):
    """The mart has not been built."""


def raw_events(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame:
    """JSON lines with the declared schema. A line that is no JSON object fails the read; unknown fields are passed over."""
    reader = spark.read.schema(schemas.RAW).option("mode", "FAILFAST")
    return (reader.option("basePath", base) if base else reader).json(list(paths))


def bronze_hours(spark: SparkSession, cfg: Config, hours: list[datetime]) -> DataFrame:
    """The raw events of hours, with date and hour columns; each file is one input partition, as gzip can't be split."""
    store = Store(spark)
    missing = [cfg.bronze_file(h) for h in hours if not store.exists(cfg.bronze_file(h))]
    if missing or not hours:
        raise BronzeNotFoundError(", ".join(missing) or "no hours")
    reader = spark.read.schema(f"{schemas.RAW}, date string, hour string").option("mode", "FAILFAST").option("basePath", cfg.bronze)
    return reader.json([cfg.bronze_file(h) for h in hours])


def silver(spark: SparkSession, cfg: Config, hours: list[datetime] | None = None) -> DataFrame:
    """Silver rows, with date and hour; of all hours, or of those given by their folders, so that no other is listed."""
    store = Store(spark)
    paths = store.glob(f"{cfg.silver}/date=*/hour=*") if hours is None else [cfg.silver_hour(h) for h in hours if store.exists(cfg.silver_hour(h))]
    if not paths:
        raise SilverEmptyError(cfg.silver)
    reader = spark.read.schema(f"{schemas.SILVER_DDL}, date string, hour string").option("basePath", cfg.silver)
    return reader.parquet(cfg.silver) if hours is None else reader.parquet(*paths)


def silver_hour_as_it_is(spark: SparkSession, cfg: Config, hour: datetime) -> DataFrame | None:
    """One hour with the columns that its files have; None if it isn't there."""
    path = Store(spark).settled(cfg.silver_hour(hour))
    return spark.read.parquet(path) if path else None


def mart(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    path = Store(spark).settled(f"{cfg.gold}/{name}")
    if path is None:
        raise GoldNotBuiltError(f"{cfg.gold}/{name}")
    return spark.read.parquet(path)


def metrics(spark: SparkSession, cfg: Config) -> DataFrame:
    """All metric records; none, rather than an error, where there are none. Missing fields are null."""
    if not Store(spark).glob(f"{cfg.metrics}/date=*/*.json"):
        return spark.createDataFrame([], schemas.METRICS)
    names = [x.split()[0] for x in schemas.METRICS.split(", ")]
    return spark.read.schema(schemas.METRICS).json(f"{cfg.metrics}/date=*").select(*names)


def only_gated(events: DataFrame, records: DataFrame) -> DataFrame:
    """Silver rows of the hours that passed the quality gate, by its metric records (one a passed hour)."""
    passed = records.where(F.col("kind") == "quality_gate").select(F.col("hour").cast("timestamp_ntz").alias("_hour")).distinct()
    passed = passed.select(F.date_format("_hour", "yyyy-MM-dd").alias("date"), F.date_format("_hour", "HH").alias("hour"))
    return events.join(passed, ["date", "hour"], "left_semi")
