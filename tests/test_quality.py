from datetime import timedelta

import pytest
from lake import HOUR, frame, row, silver

from eventlake.operators.quality import QualityGateError, check_hour

GOOD = [row(str(i)) for i in range(5)]


def failures(spark, cfg):
    with pytest.raises(QualityGateError) as caught:
        check_hour(spark, cfg, HOUR)
    assert not caught.value.report.passed
    return " ".join(caught.value.report.hard_failures)


def test_clean(spark, cfg):
    silver(spark, cfg, GOOD)
    report = check_hour(spark, cfg, HOUR)
    assert (report.passed, report.rows, report.soft_warnings) == (True, 5, ())


def test_missing_partition(spark, cfg):
    assert "no silver partition" in failures(spark, cfg)


def test_too_few(spark, cfg):
    silver(spark, cfg, GOOD[:2])
    assert "2 rows" in failures(spark, cfg)


def test_null_id_is_told_twice(spark, cfg):
    silver(spark, cfg, [*GOOD, row(None)])
    told = failures(spark, cfg)
    assert "1 ids are null" in told
    assert "1 duplicate ids" in told


def test_duplicate_ids(spark, cfg):
    silver(spark, cfg, [*GOOD, row("1", type="WatchEvent")])
    assert "1 duplicate ids" in failures(spark, cfg)


def test_missing_columns(spark, cfg):
    frame(spark, GOOD).drop("org_login", "created_at").write.parquet(cfg.silver_hour(HOUR))
    assert "created_at, org_login" in failures(spark, cfg)


def test_soft_checks_pass(spark, cfg):
    late = HOUR + timedelta(hours=2, minutes=31)
    silver(spark, cfg, [*GOOD, row("8", at=None), row("9", at=late)])
    assert len(check_hour(spark, cfg, HOUR).soft_warnings) == 2


def test_tolerance_is_half_open(spark, cfg):
    silver(spark, cfg, [*GOOD, row("8", at=HOUR - timedelta(hours=1)), row("9", at=HOUR + timedelta(hours=2))])
    assert check_hour(spark, cfg, HOUR).soft_warnings[0].startswith("1 events")
