"""The engine's queries over the driver's tables, each with the same statement in DuckDB's SQL.

The events table is brought into silver's shape by adapter(), and the marts and serving queries run on it as they run on a lake. The
lake_ queries write the events as hourly files first and go through the lake's own sources and sinks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas
from .config import Config
from .functions.expressions import lenient_long
from .operators import gold, quality, silver
from .plans import operations, serving
from .sources import tables
from .sources.store import Store, shared_folder

#: event_type -> payload_action.
OPENED, CLOSED = "signup", "purchase"
#: event_type -> type; others are as they are.
KINDS = {"click": "PushEvent", "view": "WatchEvent", "signup": "PullRequestEvent", "purchase": "PullRequestEvent"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as silver rows: users are actors (every eleventh a bot, every thirteenth unknown), the number in props is repository and request.

    Every 41st time can't be read, and one repository rests on every fourth day.
    """
    e = table(spark, sf_dir, "events")
    k = lenient_long(F.get_json_object("props", "$.k"))
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    for old, new in KINDS.items():
        kind = F.when(F.col("event_type") == old, new).otherwise(kind)
    login = F.when(F.col("user_id") % 11 == 0, F.concat(F.lit("svc"), user, F.lit("[bot]"))).when(F.col("user_id") % 13 != 0, F.concat(F.lit("user"), user))
    awake = e.where(F.coalesce((k % 5 != 2) | (F.dayofmonth("ts") % 4 != 0), F.lit(True)))
    return awake.select(
        F.col("event_id").cast("string").alias("id"),
        kind.alias("type"),
        F.when(F.col("event_id") % 41 != 0, F.col("ts")).alias("created_at"),
        F.lit(True).alias("public"),
        login.alias("actor_login"),
        (k % 5).alias("repo_id"),
        F.concat(F.lit("org/repo"), (k % 5).cast("string")).alias("repo_name"),
        F.lit(None).cast("string").alias("org_login"),
        F.when(F.col("event_type") == OPENED, "opened").when(F.col("event_type") == CLOSED, "closed").alias("payload_action"),
        k.alias("pr_number"),
        F.lit(None).cast("timestamp_ntz").alias("pr_merged_at"),
        F.lit(None).cast("int").alias("push_commits"),
    )


ADAPTER = """
keyed AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
silver AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'PullRequestEvent' WHEN 'purchase' THEN 'PullRequestEvent' ELSE event_type END AS type,
         CASE WHEN event_id % 41 <> 0 THEN ts END AS created_at,
         CASE WHEN user_id % 11 = 0 THEN 'svc' || user_id || '[bot]' WHEN user_id % 13 <> 0 THEN 'user' || user_id END AS actor_login,
         k % 5 AS repo_id, 'org/repo' || (k % 5) AS repo_name,
         CASE event_type WHEN 'signup' THEN 'opened' WHEN 'purchase' THEN 'closed' END AS payload_action, k AS pr_number
  FROM keyed WHERE coalesce(k % 5 <> 2 OR day(ts) % 4 <> 0, true)),
ev AS (SELECT *, CAST(created_at AS DATE) AS event_date, contains(actor_login, '[bot]') AS is_bot FROM silver WHERE created_at IS NOT NULL)
"""
TYPES = """
types AS (
  SELECT event_date, type, count(*) AS events, count(*) FILTER (WHERE is_bot) AS bot_events, count(*) FILTER (WHERE NOT is_bot) AS human_events
  FROM ev GROUP BY event_date, type)
"""
ACTIVITY = """
activity AS (
  SELECT event_date, repo_name, min(repo_id) AS repo_id, count(*) AS events,
         count(*) FILTER (WHERE type = 'PushEvent') AS pushes, count(*) FILTER (WHERE type = 'PullRequestEvent') AS pr_events,
         count(DISTINCT actor_login) AS actors, count(DISTINCT CASE WHEN NOT is_bot THEN actor_login END) AS human_actors,
         count(*) FILTER (WHERE is_bot) AS bot_events, count(*) FILTER (WHERE NOT is_bot) AS human_events
  FROM ev GROUP BY event_date, repo_name)
"""
TRENDING = """
past AS (
  SELECT event_date, repo_name, human_events, human_actors,
         sum(human_events) OVER (PARTITION BY repo_name ORDER BY event_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) / 7.0 AS baseline_7d,
         date_diff('day', (SELECT min(event_date) FROM activity), event_date) >= 7 AS window_complete
  FROM activity),
trending AS (
  SELECT *, CASE WHEN window_complete AND baseline_7d >= 2.0 THEN human_events / baseline_7d END AS trend_score
  FROM past WHERE human_events >= 20 AND human_actors >= 2)
"""
#: Medians and percentiles are compared to six places: the engines interpolate with different last bits.
LATENCY = """
  SELECT CAST(closed_at AS DATE) AS event_date, count(*) AS closed_with_known_open,
         round(quantile_cont(date_diff('minute', opened_at, closed_at) / 60.0, 0.5), 6) AS median_hours_open,
         round(quantile_cont(date_diff('minute', opened_at, closed_at) / 60.0, 0.9), 6) AS p90_hours_open
  FROM closed JOIN opened USING ({keys}) WHERE closed_at >= opened_at GROUP BY 1
"""


def _events(spark, sf_dir):
    return gold.events(adapter(spark, sf_dir))


def _types(spark, sf_dir):
    return gold.event_type_daily(_events(spark, sf_dir))


def _activity(spark, sf_dir):
    return gold.repo_activity_daily(_events(spark, sf_dir))


def _trending(spark, sf_dir):
    return gold.trending_repos(_activity(spark, sf_dir), 20, 2.0, gold.first_day(_events(spark, sf_dir)))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def pr_stats_daily(spark, sf_dir):
    """The mart with actors as repositories: the table has too few repositories otherwise."""
    e = _events(spark, sf_dir).withColumn("repo_name", F.col("actor_login"))
    return _rounded(gold.pr_stats_daily(e), "median_hours_open", "p90_hours_open")


def order_ship_lifecycle_daily(spark, sf_dir):
    """The same lifecycle on orders and the first shipment of each."""
    opened = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("opened_at"))
    closed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.min("l_shipdate").alias("closed_at"))
    return _rounded(gold.latency_daily(gold.lifecycles(opened, closed, "key")), "median_hours_open", "p90_hours_open")


def silver_dedup(spark, sf_dir):
    """Exact deduplication over the twelve columns, of events cut down until some repeat: rows of the same hour, type and number."""
    rows = adapter(spark, sf_dir).withColumns({"id": F.concat_ws("-", "type", F.col("pr_number").cast("string")), "created_at": F.date_trunc("hour", "created_at").cast("timestamp_ntz"), "actor_login": F.lit("one")})
    return silver.dedup(rows)


def _raw(spark, sf_dir):
    """Raw rows of strings, as JSON has them: ids, times and numbers that can and can't be read. Every eighth event occurs twice."""
    e = table(spark, sf_dir, "events")
    e = e.select("*", F.explode(F.when(F.col("event_id") % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    n = F.col("event_id")
    merged = F.when(n % 4 == 0, F.concat(F.lit(',"merged_at":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"'))).when(n % 4 == 1, ',"merged_at":"soon"').otherwise("")
    return e.select(
        n.cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.when(n % 7 == 0, "not-a-timestamp").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("created_at"),
        F.when(n % 5 == 0, "false").otherwise("true").alias("public"),
        F.when(n % 13 != 0, F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"))).alias("actor"),
        F.struct(n.cast("string").alias("id"), F.concat(F.lit("org/repo"), (n % 6).cast("string")).alias("name")).alias("repo"),
        F.when(n % 2 == 0, F.struct(F.concat(F.lit("org"), (n % 3).cast("string")).alias("login"))).alias("org"),
        F.when(n % 3 == 0, F.lit('"text"')).otherwise(F.concat(F.lit('{"action":"opened","size":'), (n % 10).cast("string"), F.lit(',"pull_request":{"number":"'), (n % 4).cast("string"), F.lit('.7"'), merged, F.lit("}}"))).alias("payload"),
    )


def silver_parse(spark, sf_dir):
    """All twelve columns of the silver projection."""
    return silver.parse(_raw(spark, sf_dir))


PARSED = """
parsed AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS created_at,
         event_id % 5 <> 0 AS public, CASE WHEN event_id % 13 <> 0 THEN 'user' || user_id END AS actor_login, event_id AS repo_id, 'org/repo' || (event_id % 6) AS repo_name,
         CASE WHEN event_id % 2 = 0 THEN 'org' || (event_id % 3) END AS org_login, CASE WHEN event_id % 3 <> 0 THEN 'opened' END AS payload_action,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 4 + 1 AS BIGINT) END AS pr_number,
         CASE WHEN event_id % 3 <> 0 AND event_id % 4 = 0 THEN date_trunc('second', ts) END AS pr_merged_at,
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 10 AS INTEGER) END AS push_commits
  FROM events)
"""

#: The hours of the staged lakes: events are dealt out over one day's, and those that occur twice meet in the same hour or the next.
DAY = datetime(2024, 3, 5)


def _lake(spark) -> Config:
    """A new lake in the shared folder."""
    return Config(data_root=f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}", quality_min_rows=1)


def _landed(spark, sf_dir) -> tuple[Config, list[datetime]]:
    """A lake whose bronze has all raw events as gzipped JSON lines, one file an hour. Of two copies, every other one is an hour later."""
    cfg, store = _lake(spark), Store(spark)
    number = F.col("id").cast("bigint")
    hour = F.format_string("%02d", (number + F.when((number % 16 == 0) & (F.col("_n") == 2), 1).otherwise(0)) % 24)
    numbered = _raw(spark, sf_dir).withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("type")))
    plain = F.to_json(F.struct("id", "type", "created_at", F.col("public").cast("boolean").alias("public"), "actor", "repo", "org"))
    lines = numbered.select(plain.alias("line"), "payload", hour.alias("hour"))
    whole = lines.select(F.concat(F.expr("left(line, length(line) - 1)"), F.lit(',"payload":'), "payload", F.lit("}")).alias("value"), "hour")
    staged = f"{cfg.data_root}/staged"
    whole.repartition(24, "hour").write.partitionBy("hour").option("compression", "gzip").text(staged)
    hours = []
    for folder in store.list(staged):
        if folder.name.startswith("hour="):
            hours.append(DAY.replace(hour=int(folder.name[5:])))
            file = next(f.path for f in store.list(folder.path) if f.name.startswith("part-"))
            store.make_folder(cfg.bronze_file(hours[-1]).rpartition("/")[0])
            store.move(file, cfg.bronze_file(hours[-1]))
    store.delete(staged)
    return cfg, hours


def lake_silver(spark, sf_dir):
    """Bronze files through the declared JSON schema, the projection, deduplication by hour, partitioned files, and back."""
    cfg, hours = _landed(spark, sf_dir)
    silver.transform_hours(spark, cfg, hours)
    return tables.silver(spark, cfg).select(*schemas.SILVER, "hour")


def lake_gold(spark, sf_dir):
    """A mart that was built from the files of all hours, read from its own."""
    cfg, hours = _landed(spark, sf_dir)
    silver.transform_hours(spark, cfg, hours)
    gold.build_gold(spark, cfg)
    return tables.mart(spark, cfg, "event_type_daily")


HOURS = PARSED + """,
lake AS (
  SELECT p.*, printf('%02d', CAST((CAST(id AS BIGINT) + CASE WHEN CAST(id AS BIGINT) % 16 = 0 THEN c ELSE 0 END) % 24 AS INTEGER)) AS hour
  FROM parsed p JOIN (VALUES (0), (1)) AS copies (c) ON c = 0 OR CAST(id AS BIGINT) % 16 = 0),
ev AS (SELECT *, CAST(created_at AS DATE) AS event_date, contains(actor_login, '[bot]') AS is_bot FROM lake WHERE created_at IS NOT NULL)
"""


def lake_metrics(spark, sf_dir):
    """Metric records as JSON files, a kind and hour each, read back with their declared schema."""
    cfg = _lake(spark)
    o = records(spark, sf_dir).where(F.col("kind") != "build_gold")
    hour = F.col("rows_in") % 24
    sums = o.groupBy("kind", hour.cast("int").alias("h")).agg(F.sum("rows_in").alias("rows_in"), F.max("rows_out").alias("rows_out"), F.sum("duration_seconds").alias("duration_seconds"))
    for r in sums.collect():  # three kinds of 24 hours
        operations.record(spark, cfg, r["kind"], DAY.replace(hour=r["h"]), rows_in=r["rows_in"], duration_seconds=r["duration_seconds"], **({"rows_out": r["rows_out"]} if r["kind"] == "transform" else {}))
    return serving.run_metrics(tables.metrics(spark, cfg))


def quality_profile(spark, sf_dir):
    """The gate's counts for one hour, with ids that repeat, ids and times that are null, and times far off."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.when(F.col("event_id") % 97 != 0, (F.col("event_id") - F.col("event_id") % 3).cast("string")).alias("id"), F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("created_at"))
    return quality.profile(rows, datetime(2024, 1, 10, 12), 60)


def records(spark, sf_dir):
    """Metric records made of orders: priorities are kinds, and every fourth order is one of a transform."""
    o, n = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 4
    kind = F.when(n == 0, "transform").when(n == 1, "ingest").when(n == 2, "quality_gate").otherwise("build_gold")
    return o.select(
        kind.alias("kind"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("hour"),
        (F.col("o_custkey") % 100).cast("double").alias("duration_seconds"),
        F.col("o_orderkey").alias("rows_in"),
        F.col("o_custkey").alias("rows_out"),
        (F.col("o_orderkey") * 1000).alias("bytes_downloaded"),
        (F.col("o_custkey") % 2 == 0).alias("skipped"),
    )


RECORDS = """
records AS (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'transform' WHEN 1 THEN 'ingest' WHEN 2 THEN 'quality_gate' ELSE 'build_gold' END AS kind,
         date_trunc('second', o_orderdate) AS hour, CAST(o_custkey % 100 AS DOUBLE) AS duration_seconds, o_orderkey AS rows_in, o_custkey AS rows_out,
         o_orderkey * 1000 AS bytes_downloaded, o_custkey % 2 = 0 AS skipped
  FROM orders)
"""


def trending_top(spark, sf_dir):
    top = _trending(spark, sf_dir).where("trend_score is not null").orderBy(F.col("trend_score").desc(), "event_date", "repo_name").limit(20)
    return _rounded(top, "baseline_7d", "trend_score")


def daily_type_mix_order(spark, sf_dir):
    """The daily mix as it is served, with its positions: the order is part of the result."""
    return serving.in_order(spark, serving.daily_type_mix(_types(spark, sf_dir), 3).collect())


def type_order(spark, sf_dir):
    return serving.in_order(spark, serving.type_order(_types(spark, sf_dir), 3))


def pr_daily(spark, sf_dir):
    return serving.in_order(spark, serving.pr_daily(pr_stats_daily(spark, sf_dir)).collect())


def latest_day(spark, sf_dir):
    """The last day of the pull request mart."""
    return serving.latest(pr_stats_daily(spark, sf_dir), "event_date")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "event_type_daily": _types,
        "repo_activity_daily": _activity,
        "trending_repos": _trending,
        "pr_stats_daily": pr_stats_daily,
        "order_ship_lifecycle_daily": order_ship_lifecycle_daily,
        "daily_type_mix": lambda s, d: serving.daily_type_mix(_types(s, d), 3),
        "type_ranks": lambda s, d: serving.type_ranks(_types(s, d)),
        "top_types": lambda s, d: serving.top_types(_types(s, d), 3),
        "top_repos": lambda s, d: serving.top_repos(_activity(s, d)),
        "trending_top": trending_top,
        "trending": lambda s, d: serving.trending(_trending(s, d)),
        "trending_head": lambda s, d: serving.trending(_trending(s, d), 12),
        "daily_type_mix_order": daily_type_mix_order,
        "type_order": type_order,
        "pr_daily": pr_daily,
        "summary": lambda s, d: _rounded(serving.summary(_types(s, d), _activity(s, d)), "bot_share", "events_per_day"),
        "hourly_volume": lambda s, d: serving.hourly_volume(adapter(s, d)),
        "trending_first_scored_date": lambda s, d: serving.trending_first_scored_date(_types(s, d)),
        "human_bot_long": lambda s, d: serving.by_actor_kind(_types(s, d)),
        "pr_long": lambda s, d: serving.pr_long(pr_stats_daily(s, d)),
        "latest_day": latest_day,
        "silver_dedup": silver_dedup,
        "silver_parse": silver_parse,
        "lake_silver": lake_silver,
        "lake_gold": lake_gold,
        "lake_metrics": lake_metrics,
        "quality_profile": quality_profile,
        "run_metrics": lambda s, d: serving.run_metrics(records(s, d)),
        "throughput_summary": lambda s, d: _rounded(serving.throughput_summary(records(s, d)), "median_events_per_sec", "median_transform_seconds", "gb_ingested"),
    }


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def oracle_sql() -> dict[str, str]:
    types, activity, trending = _with(ADAPTER, TYPES), _with(ADAPTER, ACTIVITY), _with(ADAPTER, ACTIVITY, TRENDING)
    pr_sides = """
opened AS (SELECT actor_login, pr_number, min(created_at) AS opened_at FROM ev WHERE type = 'PullRequestEvent' AND payload_action = 'opened' AND pr_number IS NOT NULL GROUP BY 1, 2),
closed AS (SELECT actor_login, pr_number, min(created_at) AS closed_at FROM ev WHERE type = 'PullRequestEvent' AND payload_action = 'closed' AND pr_number IS NOT NULL GROUP BY 1, 2),
latency AS (""" + LATENCY.format(keys="actor_login, pr_number") + """),
prs AS (SELECT event_date, count(*) FILTER (WHERE payload_action = 'opened') AS prs_opened, count(*) FILTER (WHERE payload_action = 'closed') AS prs_closed FROM ev WHERE type = 'PullRequestEvent' GROUP BY 1),
pr AS (SELECT event_date, prs_opened, prs_closed, coalesce(closed_with_known_open, 0) AS closed_with_known_open, median_hours_open, p90_hours_open FROM prs LEFT JOIN latency USING (event_date))
"""
    pr = _with(ADAPTER, pr_sides)
    shown = """SELECT event_date, repo_name, human_events, human_actors, CAST(round(CAST(CAST(baseline_7d AS VARCHAR) AS DECIMAL(38, 18)), 1) AS DOUBLE) AS baseline_7d, window_complete,
        CAST(round(CAST(CAST(trend_score AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS trend_score
        FROM (SELECT * FROM trending WHERE trend_score IS NOT NULL ORDER BY trend_score DESC, event_date, repo_name LIMIT %d)"""
    mix = """mix AS (SELECT event_date, CASE WHEN rank <= 3 THEN type ELSE 'Other' END AS type, CAST(sum(events) AS BIGINT) AS events,
        CAST(sum(bot_events) AS BIGINT) AS bot_events, CAST(sum(human_events) AS BIGINT) AS human_events FROM types JOIN ranks USING (type) GROUP BY 1, 2)"""
    ranks = ", ranks AS (SELECT type, sum(events) AS total, row_number() OVER (ORDER BY sum(events) DESC, type) AS rank FROM types GROUP BY type)"
    return {
        "event_type_daily": f"{types} SELECT * FROM types",
        "repo_activity_daily": f"{activity} SELECT * FROM activity",
        "trending_repos": f"{trending} SELECT * FROM trending",
        "pr_stats_daily": f"{pr} SELECT * FROM pr",
        "order_ship_lifecycle_daily": "WITH opened AS (SELECT o_orderkey AS key, o_orderdate AS opened_at FROM orders), closed AS (SELECT l_orderkey AS key, min(l_shipdate) AS closed_at FROM lineitem GROUP BY 1)" + LATENCY.format(keys="key"),
        "daily_type_mix": f"{types}{ranks}, {mix} SELECT * FROM mix",
        "daily_type_mix_order": f"{types}{ranks}, {mix} SELECT row_number() OVER (ORDER BY event_date, events DESC, type) AS position, * FROM mix",
        "type_order": f"{types}{ranks} SELECT CAST(rank AS BIGINT) AS position, type AS name FROM ranks WHERE rank <= 3 UNION ALL SELECT 4, 'Other'",
        "pr_daily": f"{pr} SELECT row_number() OVER (ORDER BY event_date) AS position, * FROM pr",
        "trending": f"{trending} {shown % 20}",
        "trending_head": f"{trending} {shown % 12}",
        "type_ranks": f"{types}{ranks} SELECT type, CAST(total AS BIGINT) AS total, CAST(rank AS BIGINT) AS rank FROM ranks",
        "top_types": f"{types} SELECT type, CAST(sum(events) AS BIGINT) AS total FROM types GROUP BY type ORDER BY total DESC, type LIMIT 3",
        "top_repos": f"""{activity} SELECT repo_name, CAST(sum(human_events) AS BIGINT) AS human_events, CAST(sum(events) AS BIGINT) AS events, max(human_actors) AS peak_daily_human_actors
            FROM activity WHERE human_actors >= 2 GROUP BY repo_name ORDER BY human_events DESC, repo_name LIMIT 15""",
        "trending_top": f"""{trending} SELECT event_date, repo_name, human_events, human_actors, round(baseline_7d, 6) AS baseline_7d, window_complete, round(trend_score, 6) AS trend_score
            FROM (SELECT * FROM trending WHERE trend_score IS NOT NULL ORDER BY trend_score DESC, event_date, repo_name LIMIT 20)""",
        "summary": f"""{_with(ADAPTER, TYPES, ACTIVITY)} SELECT CAST(sum(events) AS BIGINT) AS total_events, round(CAST(sum(bot_events) AS DOUBLE) / CAST(sum(events) AS DOUBLE), 6) AS bot_share,
            count(DISTINCT event_date) AS days, min(event_date) AS first_day, max(event_date) AS last_day, round(CAST(sum(events) AS DOUBLE) / count(DISTINCT event_date), 6) AS events_per_day,
            (SELECT count(DISTINCT repo_name) FROM activity) AS distinct_repos FROM types""",
        "hourly_volume": f"{_with(ADAPTER)} SELECT date_trunc('hour', created_at) AS hour, count(*) AS events FROM ev GROUP BY 1",
        "trending_first_scored_date": f"{types} SELECT CAST(min(event_date) + INTERVAL 7 DAY AS DATE) AS first_scored_date FROM types",
        "human_bot_long": f"""{types} SELECT type, 'human' AS actor, CAST(sum(human_events) AS BIGINT) AS events FROM types GROUP BY type
            UNION ALL SELECT type, 'bot', CAST(sum(bot_events) AS BIGINT) FROM types GROUP BY type""",
        "pr_long": f"{pr} SELECT event_date, 'opened' AS kind, prs_opened AS prs FROM pr UNION ALL SELECT event_date, 'closed', prs_closed FROM pr",
        "latest_day": f"{pr} SELECT * FROM pr ORDER BY event_date DESC LIMIT 1",
        "silver_dedup": f"""{_with(ADAPTER)} SELECT DISTINCT concat_ws('-', type, pr_number) AS id, type, date_trunc('hour', created_at) AS created_at, true AS public, 'one' AS actor_login, repo_id, repo_name,
            CAST(NULL AS VARCHAR) AS org_login, payload_action, pr_number, CAST(NULL AS TIMESTAMP) AS pr_merged_at, CAST(NULL AS INTEGER) AS push_commits FROM silver""",
        "silver_parse": f"{_with(PARSED)} SELECT p.* FROM parsed p JOIN (VALUES (0), (1)) AS copies (c) ON c = 0 OR CAST(id AS BIGINT) % 8 = 0",
        "lake_silver": f"{_with(HOURS)} SELECT * FROM lake",
        "lake_gold": f"{_with(HOURS, TYPES)} SELECT * FROM types",
        "lake_metrics": f"""{_with(RECORDS)} SELECT kind, TIMESTAMP '2024-03-05 00:00:00' + to_hours(CAST(rows_in % 24 AS INTEGER)) AS hour, sum(duration_seconds) AS duration_seconds, CAST(sum(rows_in) AS BIGINT) AS rows_in,
            CASE WHEN kind = 'transform' THEN max(rows_out) END AS rows_out, CAST(NULL AS BIGINT) AS bytes_downloaded FROM records WHERE kind <> 'build_gold' GROUP BY kind, rows_in % 24""",
        "quality_profile": """WITH e AS (SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(event_id - event_id % 3 AS VARCHAR) END AS id, CASE WHEN event_id % 50 <> 0 THEN ts END AS created_at FROM events)
            SELECT count(*) AS rows, count(*) FILTER (WHERE id IS NULL) AS null_ids, count(*) - count(DISTINCT id) AS duplicate_ids, count(*) FILTER (WHERE created_at IS NULL) AS null_times,
            count(*) FILTER (WHERE created_at IS NOT NULL AND (created_at < TIMESTAMP '2024-01-10 11:00:00' OR created_at >= TIMESTAMP '2024-01-10 14:00:00')) AS outside_window FROM e""",
        "run_metrics": f"{_with(RECORDS)} SELECT kind, hour, duration_seconds, rows_in, rows_out, bytes_downloaded FROM records WHERE kind IN ('ingest', 'transform', 'quality_gate')",
        "throughput_summary": f"""{_with(RECORDS)} SELECT count(*) FILTER (WHERE kind = 'transform') AS transform_runs,
            round(median(CASE WHEN kind = 'transform' AND duration_seconds <> 0 THEN CAST(rows_in AS DOUBLE) / duration_seconds END), 6) AS median_events_per_sec,
            round(median(CASE WHEN kind = 'transform' THEN duration_seconds END), 6) AS median_transform_seconds,
            round(CAST(sum(CASE WHEN kind = 'ingest' THEN bytes_downloaded END) AS DOUBLE) / 1e9, 6) AS gb_ingested,
            count(*) FILTER (WHERE kind = 'ingest' AND NOT skipped) AS download_runs FROM records""",
    }
