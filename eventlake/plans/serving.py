"""Serving queries over the marts, as DataFrames; nothing is collected before the rim."""

from __future__ import annotations

import time
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import hour_of, safe_ratio
from ..operators.gold import BASELINE_DAYS
from ..schemas import MARTS
from ..sources import tables
from ..sources.store import Store

OTHER = "Other"


def summary(types: DataFrame, activity: DataFrame) -> DataFrame:
    """One row: total_events, bot_share, days, first_day, last_day, events_per_day, distinct_repos; nulls and zeros without data."""
    whole = types.agg(F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"), F.sum("bot_events").alias("_bots"), F.count_distinct("event_date").alias("days"), F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))
    repos = activity.agg(F.count_distinct("repo_name")).scalar()
    share = F.coalesce(safe_ratio(F.col("_bots"), F.col("total_events")), F.lit(0.0))
    daily = F.coalesce(safe_ratio(F.col("total_events"), F.col("days")), F.lit(0.0))
    return whole.select("total_events", share.alias("bot_share"), "days", "first_day", "last_day", daily.alias("events_per_day"), repos.alias("distinct_repos"))


def type_ranks(types: DataFrame) -> DataFrame:
    """Types by their total, the name breaking ties. The window is over one row for each type."""
    totals = types.groupBy("type").agg(F.sum("events").alias("total"))
    return totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("total").desc(), "type")).cast("bigint"))


def daily_type_mix(types: DataFrame, top_n: int = 6) -> DataFrame:
    """The daily mix with the types after the first top_n as one, Other."""
    ranks = type_ranks(types).select("type", "rank")
    named = types.join(F.broadcast(ranks), "type").withColumn("type", F.when(F.col("rank") <= top_n, F.col("type")).otherwise(OTHER))
    sums = [F.sum(c).alias(c) for c in ("events", "bot_events", "human_events")]
    return named.groupBy("event_date", "type").agg(*sums).orderBy("event_date", F.col("events").desc(), "type")


def top_types(types: DataFrame, top_n: int = 6) -> DataFrame:
    return types.groupBy("type").agg(F.sum("events").alias("total")).orderBy(F.col("total").desc(), "type").limit(top_n)


def type_order(types: DataFrame, top_n: int = 6) -> list[str]:
    """Names for a legend, the most frequent first, and Other last, whether or not it is needed."""
    return [r["type"] for r in top_types(types, top_n).collect()] + [OTHER]


def in_order(spark: SparkSession, served: list) -> DataFrame:
    """Served values or rows with their position, from 1, as a table again."""
    plain = [x.asDict() if isinstance(x, Row) else {"name": x} for x in served]
    return spark.createDataFrame([Row(position=i, **x) for i, x in enumerate(plain, 1)])


def top_repos(activity: DataFrame, limit: int = 15) -> DataFrame:
    """Repositories by human events, of the days that more than one human acted on."""
    busy = activity.where(F.col("human_actors") >= 2)
    sums = busy.groupBy("repo_name").agg(F.sum("human_events").alias("human_events"), F.sum("events").alias("events"), F.max("human_actors").alias("peak_daily_human_actors"))
    return sums.orderBy(F.col("human_events").desc(), "repo_name").limit(limit)


def trending(mart: DataFrame, limit: int = 20) -> DataFrame:
    """The highest scores of all days."""
    scored = mart.where(F.col("trend_score").isNotNull()).orderBy(F.col("trend_score").desc(), "event_date", "repo_name").limit(limit)
    return scored.withColumns({"baseline_7d": F.round("baseline_7d", 1), "trend_score": F.round("trend_score", 2)})


def trending_first_scored_date(types: DataFrame) -> DataFrame:
    """One row: the first day that can have a score."""
    return types.agg(F.date_add(F.min("event_date"), BASELINE_DAYS).alias("first_scored_date"))


def pr_daily(mart: DataFrame) -> DataFrame:
    return mart.orderBy("event_date")


def hourly_volume(events: DataFrame) -> DataFrame:
    """Events by the hour of their own time, from silver."""
    timed = events.where(F.col("created_at").isNotNull())
    return timed.groupBy(hour_of(F.col("created_at")).alias("hour")).agg(F.count(F.lit(1)).alias("events")).orderBy("hour")


def by_actor_kind(types: DataFrame) -> DataFrame:
    """Long form: a row for each type and kind of actor."""
    sums = types.groupBy("type").agg(F.sum("human_events").alias("human_events"), F.sum("bot_events").alias("bot_events"))
    long = sums.unpivot("type", ["human_events", "bot_events"], "actor", "events")
    return long.withColumn("actor", F.when(F.col("actor") == "human_events", "human").otherwise("bot"))


def pr_long(mart: DataFrame) -> DataFrame:
    """Long form: a row for each day and kind of pull request event."""
    long = mart.unpivot("event_date", ["prs_opened", "prs_closed"], "kind", "prs")
    return long.withColumn("kind", F.when(F.col("kind") == "prs_opened", "opened").otherwise("closed"))


def latest(df: DataFrame, by: str) -> DataFrame:
    """The row with the largest value."""
    return df.orderBy(F.col(by).desc()).limit(1)


def rounded(df: DataFrame, places: int = 2) -> DataFrame:
    """All doubles rounded."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


RUN_KINDS = ("ingest", "transform", "quality_gate")


def run_metrics(records: DataFrame) -> DataFrame:
    """Each run of the hourly steps."""
    at: Column = F.col("hour").cast("timestamp_ntz")
    return records.where(F.col("kind").isin(*RUN_KINDS)).select("kind", at.alias("hour"), "duration_seconds", "rows_in", "rows_out", "bytes_downloaded").orderBy("hour", "kind")


def throughput_summary(records: DataFrame) -> DataFrame:
    """One row: transform_runs, median_events_per_sec, median_transform_seconds, gb_ingested, download_runs. Runs of no time have no rate."""
    transform, downloaded = F.col("kind") == "transform", (F.col("kind") == "ingest") & ~F.coalesce("skipped", F.lit(False))
    rate = safe_ratio(F.col("rows_in"), F.col("duration_seconds"))
    return records.agg(
        F.count_if(transform).alias("transform_runs"),
        F.median(F.when(transform, rate)).alias("median_events_per_sec"),
        F.median(F.when(transform, F.col("duration_seconds"))).alias("median_transform_seconds"),
        (F.sum(F.when(F.col("kind") == "ingest", F.col("bytes_downloaded"))) / F.lit(1e9)).alias("gb_ingested"),
        F.count_if(downloaded).alias("download_runs"),
    )


def ops_snapshot(spark: SparkSession, cfg: Config, now: datetime | None = None) -> dict:
    """Partitions and megabytes of each layer, sizes of the marts, the latest silver hour, and hours since it ended. From listings alone."""
    store = Store(spark)
    now = now or datetime.now(UTC).replace(tzinfo=None)
    out: dict = {}
    hours: list[datetime] = []
    for layer, root in (("bronze", cfg.bronze), ("silver", cfg.silver)):
        found = [e for day in store.list(root) if day.name.startswith("date=") for e in store.list(day.path) if e.name.startswith("hour=")]
        out[f"{layer}_partitions"] = len(found)
        out[f"{layer}_mb"] = sum(store.bytes(e.path) for e in found) / 1e6
        if layer == "silver":
            hours = [datetime.strptime(f"{e.path.rstrip('/').split('/')[-2][5:]} {e.name[5:]}", "%Y-%m-%d %H") for e in found]
    out["gold_mb"] = {m: store.bytes(f"{cfg.gold}/{m}") / 1e6 for m in MARTS if store.exists(f"{cfg.gold}/{m}")}
    out["latest_hour"] = max(hours, default=None)
    out["freshness_hours"] = (now - out["latest_hour"] - timedelta(hours=1)).total_seconds() / 3600 if hours else None
    return out


def rows(df: DataFrame) -> list[dict]:
    """The rim: a served result as plain rows."""
    return [r.asDict() for r in df.collect()]


class Serving:
    """The queries over a lake's own marts."""

    #: Seconds that cached() keeps a result.
    KEPT = 300

    def __init__(self, spark: SparkSession, cfg: Config):
        self.spark, self.cfg = spark, cfg
        self._kept: dict[tuple, tuple[float, object]] = {}

    def cached(self, query: str, *arguments, now: float | None = None):
        """A query's result as plain values, kept for KEPT seconds by query and arguments. Served results are small."""
        now, key = time.monotonic() if now is None else now, (query, *arguments)
        if key not in self._kept or now - self._kept[key][0] >= self.KEPT:
            found = getattr(self, query)(*arguments)
            self._kept[key] = now, rows(found) if isinstance(found, DataFrame) else found
        return self._kept[key][1]

    def _mart(self, name: str) -> DataFrame:
        return tables.mart(self.spark, self.cfg, name)

    def summary(self) -> dict:
        return rows(summary(self._mart("event_type_daily"), self._mart("repo_activity_daily")))[0]

    def daily_type_mix(self, top_n: int = 6) -> DataFrame:
        return daily_type_mix(self._mart("event_type_daily"), top_n)

    def type_order(self, top_n: int = 6) -> list[str]:
        return type_order(self._mart("event_type_daily"), top_n)

    def top_repos(self, limit: int = 15) -> DataFrame:
        return top_repos(self._mart("repo_activity_daily"), limit)

    def trending(self, limit: int = 20) -> DataFrame:
        return trending(self._mart("trending_repos"), limit)

    def trending_first_scored_date(self):
        return trending_first_scored_date(self._mart("event_type_daily")).first()[0]

    def pr_daily(self) -> DataFrame:
        return pr_daily(self._mart("pr_stats_daily"))

    def hourly_volume(self) -> DataFrame:
        return hourly_volume(tables.silver(self.spark, self.cfg))

    def run_metrics(self) -> DataFrame:
        return run_metrics(tables.metrics(self.spark, self.cfg))

    def throughput_summary(self) -> dict | None:
        found = rows(throughput_summary(tables.metrics(self.spark, self.cfg)))[0]
        return found if found["transform_runs"] or found["download_runs"] else None

    def ops_snapshot(self, now: datetime | None = None) -> dict:
        return ops_snapshot(self.spark, self.cfg, now)
