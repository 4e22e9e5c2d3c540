from datetime import datetime, timedelta

import pytest
from lake import HOUR, frame, hidden, row, silver

from eventlake.operators import gold
from eventlake.plans.operations import record
from eventlake.sources import tables

DAY = datetime(2024, 3, 1, 12)


def days(spark, per_day):
    """per_day: day number -> rows as (login, count)."""
    out = []
    for day, actors in per_day.items():
        for login, n in actors:
            out += [row(f"{day}-{login}-{i}", DAY + timedelta(days=day), actor_login=login) for i in range(n)]
    return gold.repo_activity_daily(gold.events(frame(spark, out)))


def test_bots_humans_and_events_without_actor(spark):
    e = gold.events(frame(spark, [row("1"), row("2", actor_login="ci[bot]"), row("3", actor_login=None), row("4", at=None)]))
    r = gold.event_type_daily(e).collect()
    assert [tuple(x) for x in r] == [(HOUR.date(), "PushEvent", 3, 1, 1)]


def test_repo_activity(spark):
    e = gold.events(frame(spark, [row("1"), row("2"), row("3", type="PullRequestEvent", actor_login="bob"), row("4", actor_login="ci[bot]", repo_id=None), row("5", actor_login=None), row("6", repo_name="c/d")]))
    got = {r["repo_name"]: r for r in gold.repo_activity_daily(e).collect()}
    r = got["a/b"]
    assert (r.repo_id, r.events, r.pushes, r.pr_events, r.actors, r.human_actors, r.bot_events, r.human_events) == (42, 5, 4, 1, 3, 2, 1, 3)
    assert got["c/d"].events == 1


def test_trending_scores_after_a_full_week(spark):
    activity = days(spark, {d: [(f"u{i}", 3 if d == 9 else 1) for i in range(30)] for d in range(10)})
    got = gold.trending_repos(activity, 20, 2.0).orderBy("event_date").collect()
    assert [r.trend_score for r in got] == [None] * 7 + [1.0, 1.0, 3.0]
    assert [r.window_complete for r in got] == [False] * 7 + [True] * 3
    assert got[0].baseline_7d is None


def test_quiet_days_count_in_the_baseline(spark):
    activity = days(spark, {0: [("a", 35), ("b", 35)], 3: [("a", 7)], 8: [("a", 20), ("b", 20)]})
    got = gold.trending_repos(activity, 20, 1.0).orderBy("event_date").collect()
    assert [(r.human_events, r.baseline_7d, r.trend_score) for r in got] == [(70, None, None), (40, 1.0, 40.0)]


def test_bots_single_actors_and_newcomers(spark):
    assert days(spark, {d: [("ci[bot]", 50), ("a", 5)] for d in range(9)}).transform(lambda a: gold.trending_repos(a, 20, 2.0)).count() == 0
    assert days(spark, {d: [("solo", 30)] for d in range(9)}).transform(lambda a: gold.trending_repos(a, 20, 2.0)).count() == 0
    old = [row(f"o{i}", DAY, repo_name="old/one") for i in range(3)]
    new = [row(f"n{i}", DAY + timedelta(days=9), actor_login=f"u{i % 3}") for i in range(25)]
    activity = gold.repo_activity_daily(gold.events(frame(spark, old + new)))
    got = gold.trending_repos(activity, 20, 2.0).collect()
    assert [(r.repo_name, r.window_complete, r.trend_score) for r in got] == [("a/b", True, None)]


def test_zero_floor_has_no_score_on_a_zero_baseline(spark):
    activity = days(spark, {0: [("a", 1)], 3: [("ci[bot]", 9)], 9: [("a", 20), ("b", 20)]})
    got = gold.trending_repos(activity, 20, 0.0).collect()
    assert [(r.baseline_7d, r.trend_score) for r in got] == [(0.0, None)]


def pr(id_, n, action, at, **changes):
    return row(id_, at, type="PullRequestEvent", payload_action=action, pr_number=n, **changes)


def test_pull_requests(spark):
    day2 = DAY + timedelta(days=1)
    rows = [pr("1", 1, "opened", DAY), pr("2", 2, "opened", DAY), pr("3", 2, "closed", DAY + timedelta(hours=2)), pr("4", 1, "closed", DAY + timedelta(hours=26)), pr("5", None, "closed", day2), pr("6", 9, "closed", day2)]
    got = gold.pr_stats_daily(gold.events(frame(spark, rows))).orderBy("event_date").collect()
    assert [tuple(r)[1:] for r in got] == [(2, 1, 1, 2.0, 2.0), (0, 3, 1, 26.0, 26.0)]


def test_first_closing_before_first_opening_is_left_out(spark):
    rows = [pr("1", 1, "closed", DAY), pr("2", 1, "opened", DAY + timedelta(hours=1)), pr("3", 1, "closed", DAY + timedelta(hours=3)), pr("4", 5, "labeled", DAY + timedelta(days=1))]
    got = gold.pr_stats_daily(gold.events(frame(spark, rows))).orderBy("event_date").collect()
    assert [tuple(r)[1:] for r in got] == [(1, 2, 0, None, None), (0, 0, 0, None, None)]


def test_percentiles_interpolate(spark):
    rows = [x for n, h in enumerate((1, 2, 4)) for x in (pr(f"o{n}", n, "opened", DAY - timedelta(hours=h)), pr(f"c{n}", n, "closed", DAY))]
    got = [r for r in gold.pr_stats_daily(gold.events(frame(spark, rows))).collect() if r.closed_with_known_open]
    assert (got[0].median_hours_open, round(got[0].p90_hours_open, 6)) == (2.0, 3.6)


def test_build(spark, cfg):
    with pytest.raises(tables.SilverEmptyError):
        gold.build_gold(spark, cfg)
    silver(spark, cfg, [row("1"), row("2", actor_login="bob")])
    silver(spark, cfg, [row("3", HOUR + timedelta(hours=1))], HOUR + timedelta(hours=1))
    first = gold.build_gold(spark, cfg)
    assert first.rows_per_mart == {"event_type_daily": 1, "repo_activity_daily": 1, "trending_repos": 0, "pr_stats_daily": 0}
    assert gold.build_gold(spark, cfg).rows_per_mart == first.rows_per_mart
    assert tables.mart(spark, cfg, "event_type_daily").first().events == 3
    assert not hidden(cfg.gold)
    record(spark, cfg, "quality_gate", HOUR, rows=2, soft_warnings=0)
    gold.build_gold(spark, cfg, only_gated=True)
    assert tables.mart(spark, cfg, "event_type_daily").first().events == 2
