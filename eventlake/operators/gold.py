"""The four daily marts, each a function of the events, and their build."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.expressions import hours_between, is_bot, safe_ratio, trailing_days
from ..sources import tables
from ..sources.store import Store

#: Days of the trending baseline; distinct human actors that a day needs to be told.
BASELINE_DAYS, MIN_ACTORS = 7, 2


@dataclass(frozen=True)
class GoldBuildResult:
    rows_per_mart: dict[str, int] = field(default_factory=dict)
    duration_seconds: float = 0.0


def events(silver: DataFrame) -> DataFrame:
    """Silver rows that have a time, with their own day (not the partition's) and whether a bot acted."""
    timed = silver.where(F.col("created_at").isNotNull())
    return timed.withColumn("event_date", F.to_date("created_at")).withColumn("is_bot", is_bot(F.col("actor_login")))


def event_type_daily(events: DataFrame) -> DataFrame:
    """Events a day and type. Events without an actor are neither a bot's nor a human's."""
    return events.groupBy("event_date", "type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_bot").alias("bot_events"),
        F.count_if(~F.col("is_bot")).alias("human_events"),
    )


def repo_activity_daily(events: DataFrame) -> DataFrame:
    """Activity a day and repository.

    Two steps: first a row for each actor, so that distinct actors are counted as rows; this takes one shuffle of partial
    sums on the finer key where counting distinct actors and human actors at once would triple the input rows.
    """
    typed = lambda t: F.count_if(F.col("type") == t)
    by_actor = events.groupBy("event_date", "repo_name", "actor_login", "is_bot").agg(
        F.min("repo_id").alias("repo_id"),
        F.count(F.lit(1)).alias("n"),
        typed("PushEvent").alias("pushes"),
        typed("PullRequestEvent").alias("pr_events"),
    )
    of = lambda bot: F.coalesce(F.sum(F.when(F.col("is_bot") == bot, F.col("n"))), F.lit(0).cast("bigint"))
    return by_actor.groupBy("event_date", "repo_name").agg(
        F.min("repo_id").alias("repo_id"),
        F.sum("n").alias("events"),
        F.sum("pushes").alias("pushes"),
        F.sum("pr_events").alias("pr_events"),
        F.count("actor_login").alias("actors"),
        F.count_if(~F.col("is_bot")).alias("human_actors"),
        of(True).alias("bot_events"),
        of(False).alias("human_events"),
    )


def first_day(rows: DataFrame) -> Column:
    """The first day of a table as a scalar subquery. Of events it is one narrow scan; from the activity of a plan it would be made anew."""
    return rows.agg(F.min("event_date")).scalar()


def trending_repos(activity: DataFrame, min_daily_events: int, min_baseline: float, first: Column | None = None) -> DataFrame:
    """Human events of a day against a seventh of those of the seven days before.

    A day is complete if seven days of the whole data lie before it. It is scored if it is complete and its baseline
    reaches the floor; a zero baseline has no score. Quiet days and those of one actor go last, as they are part of
    other days' baselines. `first` is the first day of all, the activity's own unless given.
    """
    first = first_day(activity) if first is None else first
    past = F.sum("human_events").over(trailing_days(BASELINE_DAYS, F.col("event_date"), "repo_name"))
    rows = activity.select("event_date", "repo_name", "human_events", "human_actors").withColumn("baseline_7d", past / F.lit(float(BASELINE_DAYS)))
    rows = rows.withColumn("window_complete", F.datediff("event_date", first) >= BASELINE_DAYS)
    scored = F.col("window_complete") & (F.col("baseline_7d") >= min_baseline)
    return rows.withColumn("trend_score", F.when(scored, safe_ratio(F.col("human_events"), F.col("baseline_7d")))).where((F.col("human_events") >= min_daily_events) & (F.col("human_actors") >= MIN_ACTORS))


def lifecycles(opened: DataFrame, closed: DataFrame, *keys: str) -> DataFrame:
    """Pairs of one opening and one closing row a key, closed no earlier; keys with nulls never meet."""
    return closed.join(opened, list(keys)).where(F.col("closed_at") >= F.col("opened_at"))


def latency_daily(pairs: DataFrame) -> DataFrame:
    """Exact median and 90th percentile of the hours from opening to closing, by the day of closing."""
    hours = hours_between(F.col("opened_at"), F.col("closed_at"))
    return pairs.groupBy(F.to_date("closed_at").alias("event_date")).agg(
        F.count(F.lit(1)).alias("closed_with_known_open"),
        F.percentile(hours, F.lit(0.5)).alias("median_hours_open"),
        F.percentile(hours, F.lit(0.9)).alias("p90_hours_open"),
    )


def pr_stats_daily(events: DataFrame) -> DataFrame:
    """Pull requests opened and closed a day, and how long those closed had been open since their first opening.

    A request counts with its first closing; if that comes before its first opening, it isn't told among the latencies.
    Days with any pull request event have a row.
    """
    prs = events.where(F.col("type") == "PullRequestEvent")
    action = lambda a: F.col("payload_action") == a
    counts = prs.groupBy("event_date").agg(F.count_if(action("opened")).alias("prs_opened"), F.count_if(action("closed")).alias("prs_closed"))
    named = prs.where(F.col("pr_number").isNotNull() & F.col("repo_name").isNotNull() & F.col("payload_action").isin("opened", "closed"))
    first = lambda a: F.min(F.when(action(a), F.col("created_at")))
    pairs = named.groupBy("repo_name", "pr_number").agg(first("opened").alias("opened_at"), first("closed").alias("closed_at"))  # both sides at once: no join
    latency = latency_daily(pairs.where(F.col("closed_at") >= F.col("opened_at")))
    joined = counts.join(latency, "event_date", "left")
    return joined.select("event_date", "prs_opened", "prs_closed", F.coalesce("closed_with_known_open", F.lit(0).cast("bigint")).alias("closed_with_known_open"), "median_hours_open", "p90_hours_open")


def build_gold(spark: SparkSession, cfg: Config, only_gated: bool = False) -> GoldBuildResult:
    """Rebuilds the marts from all of silver; each is staged and then moved into its place.

    By default gold reads every silver hour, also one that failed the gate; only_gated reads those that passed.
    The trending mart reads the activity mart back, so the events are aggregated once.
    """
    began, store = time.monotonic(), Store(spark)
    rows = tables.silver(spark, cfg)
    found = events(tables.only_gated(rows, tables.metrics(spark, cfg)) if only_gated else rows)
    made = {
        "event_type_daily": lambda: event_type_daily(found),
        "repo_activity_daily": lambda: repo_activity_daily(found),
        "trending_repos": lambda: trending_repos(tables.mart(spark, cfg, "repo_activity_daily"), cfg.trending_min_daily_events, cfg.trending_min_baseline),
        "pr_stats_daily": lambda: pr_stats_daily(found),
    }
    counts = {}
    for name, build in made.items():
        seen, target = Observation(), f"{cfg.gold}/{name}"
        staged = store.staging(target)
        build().observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged)
        store.publish(staged, target)
        counts[name] = seen.get["n"]
    return GoldBuildResult(counts, time.monotonic() - began)
