"""Silver: typed events without exact repetitions, one partition an hour."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Config, partition
from ..functions.expressions import lenient_int, lenient_long
from ..sources import tables
from ..sources.store import Store


@dataclass(frozen=True)
class TransformResult:
    path: str
    rows_in: int
    rows_out: int
    bytes_out: int
    duration_seconds: float


def parse(raw: DataFrame, *keep: str) -> DataFrame:
    """The twelve silver columns, and `keep`. Times, numbers in payloads that can't be read are null; a payload of any JSON kind is taken."""
    payload = lambda path: F.get_json_object("payload", path)
    return raw.select(
        "id",
        "type",
        F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
        F.col("public").cast("boolean").alias("public"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").cast("bigint").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("org.login").alias("org_login"),
        payload("$.action").alias("payload_action"),
        lenient_long(payload("$.pull_request.number")).alias("pr_number"),
        payload("$.pull_request.merged_at").try_cast("timestamp_ntz").alias("pr_merged_at"),
        lenient_int(payload("$.size")).alias("push_commits"),
        *keep,
    )


def dedup(events: DataFrame) -> DataFrame:
    """One of each group of equal rows. Rows that share an id and nothing else stay: the quality gate tells them."""
    return events.distinct()


def _judge_anew(store: Store, cfg: Config, hours: list[datetime]) -> None:
    """Withdraws what the quality gate said of hours that are about to be replaced: a pass was of the old rows."""
    for hour in hours:
        store.delete(cfg.metric_file("quality_gate", hour))


def transform_hour(spark: SparkSession, cfg: Config, hour: datetime) -> TransformResult:
    """Replaces one hour of silver: staged beside it, then moved into its place; running it again gives the same.

    An earlier pass of the quality gate goes before the new rows come.
    """
    began, store, target = time.monotonic(), Store(spark), cfg.silver_hour(hour)
    if not store.exists(cfg.bronze_file(hour)):
        raise tables.BronzeNotFoundError(cfg.bronze_file(hour))
    taken, made = Observation(), Observation()
    rows = parse(tables.raw_events(spark, cfg.bronze_file(hour)).observe(taken, F.count(F.lit(1)).alias("n")))
    staged = store.staging(target)
    try:
        dedup(rows).observe(made, F.count(F.lit(1)).alias("n")).write.parquet(staged)
        _judge_anew(store, cfg, [hour])
        store.publish(staged, target)
    except Exception:
        store.delete(staged)
        raise
    return TransformResult(target, taken.get["n"], made.get["n"], store.bytes(target), time.monotonic() - began)


def transform_hours(spark: SparkSession, cfg: Config, hours: list[datetime]) -> int:
    """Replaces many hours in one job, each deduplicated by itself; the number of rows.

    Input parallelism is the number of hours, as a gzip file is one partition. Rows are dealt out by their hour, and large
    hours over several files. Each partition is replaced whole as the job commits; hours that turn out empty are replaced too.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    made, store = Observation(), Store(spark)
    _judge_anew(store, cfg, hours)
    rows = dedup(parse(tables.bronze_hours(own, cfg, hours), "date", "hour")).hint("rebalance", "date", "hour")
    rows.observe(made, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("date", "hour").parquet(cfg.silver)
    there = {(r["date"], r["hour"]) for r in tables.silver(own, cfg, hours).select("date", "hour").distinct().collect()} if made.get["n"] else set()
    for hour in hours:
        if (hour.strftime("%Y-%m-%d"), hour.strftime("%H")) not in there:
            staged = store.staging(f"{cfg.silver}/{partition(hour)}")
            spark.createDataFrame([], schemas.SILVER_DDL).write.parquet(staged)
            store.publish(staged, cfg.silver_hour(hour))
    return made.get["n"]
