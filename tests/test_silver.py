import gzip
import os
from datetime import datetime, timedelta

import pytest
from lake import HOUR, bronze, event, hidden

from eventlake import schemas
from eventlake.operators.silver import transform_hour, transform_hours
from eventlake.sources import tables
from eventlake.streaming import silver_stream


def rows(spark, cfg, hour=HOUR):
    return spark.read.parquet(cfg.silver_hour(hour)).orderBy("id").collect()


def test_types_and_payloads(spark, cfg):
    merged = {"action": "closed", "pull_request": {"number": 7, "merged_at": "2024-03-05T15:00:00Z"}}
    bronze(cfg, [event("1"), event("2", "PullRequestEvent", payload=merged, org={"id": 3, "login": "acme"}, unknown=[1])])
    out = transform_hour(spark, cfg, HOUR)
    a, b = rows(spark, cfg)
    assert (out.rows_in, out.rows_out) == (2, 2)
    assert out.bytes_out > 0
    assert dict(spark.read.parquet(cfg.silver_hour(HOUR)).dtypes) == schemas.SILVER
    assert (a.created_at, a.public, a.actor_login, a.repo_id, a.push_commits, a.org_login) == (datetime(2024, 3, 5, 15, 10), True, "ada", 42, 3, None)
    assert (b.payload_action, b.pr_number, b.pr_merged_at, b.org_login, b.push_commits) == ("closed", 7, datetime(2024, 3, 5, 15), "acme", None)


def test_only_equal_rows_are_one(spark, cfg):
    bronze(cfg, [event("1"), event("1"), event("1", "WatchEvent"), event("2")])
    out = transform_hour(spark, cfg, HOUR)
    assert (out.rows_in, out.rows_out) == (4, 3)


def test_odd_values_are_null_and_rows_stay(spark, cfg):
    bronze(cfg, [event("1", at="not-a-timestamp"), event("2", actor=..., payload={"size": "2.5"}), event("3", payload="text"), event("4", payload=[1]), "", event("5", repo={"id": "98", "name": "x"}, public=1)])
    transform_hour(spark, cfg, HOUR)
    one, two, three, four, five = rows(spark, cfg)
    assert one.created_at is None
    assert (two.actor_login, two.push_commits) == (None, 3)
    assert (three.push_commits, four.payload_action) == (None, None)
    assert (five.repo_id, five.public) == (98, True)


@pytest.mark.parametrize("line", ["{broken", '{"id": "1", "repo": {"id": "x"}}'])
def test_what_is_no_event_fails_and_leaves_nothing(spark, cfg, line):
    bronze(cfg, [event("1"), line])
    with pytest.raises(Exception, match="(?i)malformed|cast"):
        transform_hour(spark, cfg, HOUR)
    assert not os.path.exists(cfg.silver_hour(HOUR))
    assert not hidden(cfg.silver)


def test_truncated_gzip_fails(spark, cfg):
    path = bronze(cfg, [event(str(i)) for i in range(500)])
    data = open(path, "rb").read()
    open(path, "wb").write(data[: len(data) // 2])
    with pytest.raises(Exception):  # noqa: B017
        transform_hour(spark, cfg, HOUR)


def test_again_gives_the_same(spark, cfg):
    bronze(cfg, [event("1"), event("2")])
    transform_hour(spark, cfg, HOUR)
    first = rows(spark, cfg)
    transform_hour(spark, cfg, HOUR)
    assert rows(spark, cfg) == first
    assert not hidden(cfg.silver)


def test_missing_bronze(spark, cfg):
    with pytest.raises(tables.BronzeNotFoundError):
        transform_hour(spark, cfg, HOUR)


def test_many_hours_in_one_job(spark, cfg):
    early, empty = HOUR.replace(hour=5), HOUR.replace(hour=6)
    bronze(cfg, [event("1"), event("1")], early)
    bronze(cfg, [event("1")], HOUR)
    bronze(cfg, [event("9")], empty)
    assert transform_hours(spark, cfg, [early, empty, HOUR]) == 3  # the same row in two hours stays twice
    with gzip.open(cfg.bronze_file(empty), "wt"):
        pass
    assert transform_hours(spark, cfg, [empty]) == 0
    found = tables.silver(spark, cfg).groupBy("hour").count().collect()
    assert {r["hour"]: r["count"] for r in found} == {"05": 1, "15": 1}
    assert os.path.exists(cfg.silver_hour(empty))
    assert tables.silver(spark, cfg, [early]).count() == 1


def test_stream_rebuilds_the_hours_of_new_files(spark, cfg, tmp_path):
    later = HOUR + timedelta(hours=1)
    bronze(cfg, [event("1"), event("1"), event("2")])
    silver_stream.start(spark, cfg, str(tmp_path / "checkpoint")).awaitTermination()
    assert len(rows(spark, cfg)) == 2
    bronze(cfg, [event("3")], later)
    silver_stream.start(spark, cfg, str(tmp_path / "checkpoint")).awaitTermination()
    assert len(rows(spark, cfg, later)) == 1
    assert len(rows(spark, cfg)) == 2
