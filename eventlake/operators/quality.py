"""The quality gate of one silver hour: hard checks fail it, soft ones are told."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Config
from ..sources import tables


@dataclass(frozen=True)
class QualityReport:
    hour: datetime
    rows: int
    hard_failures: tuple[str, ...] = ()
    soft_warnings: tuple[str, ...] = ()

    @property
    def passed(self) -> bool:
        return not self.hard_failures


class QualityGateError(Exception):
    """A hard check failed; `report` has all findings."""

    def __init__(self, report: QualityReport):
        super().__init__("; ".join(report.hard_failures))
        self.report = report


def profile(events: DataFrame, hour: datetime, tolerance_minutes: int) -> DataFrame:
    """One row of counts. A null id counts as null and, as it is no distinct value, as a duplicate too."""
    slack = timedelta(minutes=tolerance_minutes)
    at = F.col("created_at")
    outside = (at < F.lit(hour - slack).cast("timestamp_ntz")) | (at >= F.lit(hour + timedelta(hours=1) + slack).cast("timestamp_ntz"))
    return events.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
        (F.count(F.lit(1)) - F.count_distinct("id")).alias("duplicate_ids"),
        F.count_if(at.isNull()).alias("null_times"),
        F.count_if(at.isNotNull() & outside).alias("outside_window"),
    )


def judge(counts: dict[str, int], missing: list[str], hour: datetime, cfg: Config) -> QualityReport:
    hard, soft = [], []
    if missing:
        hard.append(f"missing columns: {', '.join(missing)}")
    if counts["rows"] < cfg.quality_min_rows:
        hard.append(f"{counts['rows']} rows are under the floor of {cfg.quality_min_rows}")
    if counts["null_ids"]:
        hard.append(f"{counts['null_ids']} ids are null")
    if counts["duplicate_ids"]:
        hard.append(f"{counts['duplicate_ids']} duplicate ids with different content")
    if counts["null_times"]:
        soft.append(f"{counts['null_times']} events have no readable time")
    if counts["outside_window"]:
        soft.append(f"{counts['outside_window']} events lie over {cfg.quality_ts_tolerance_minutes} minutes outside the hour")
    return QualityReport(hour, counts["rows"], tuple(hard), tuple(soft))


def check_hour(spark: SparkSession, cfg: Config, hour: datetime) -> QualityReport:
    """The report of an hour; QualityGateError, which carries it, if a hard check fails.

    Columns are checked by name. Where some are missing, that alone is told of the columns, and they count as null.
    """
    rows = tables.silver_hour_as_it_is(spark, cfg, hour)
    if rows is None:
        report = QualityReport(hour, 0, (f"no silver partition at {cfg.silver_hour(hour)}",))
    else:
        missing = sorted(set(schemas.SILVER) - set(rows.columns))
        for name in missing:
            rows = rows.withColumn(name, F.lit(None).cast(schemas.SILVER[name]))
        report = judge(profile(rows, hour, cfg.quality_ts_tolerance_minutes).first().asDict(), missing, hour, cfg)
    if not report.passed:
        raise QualityGateError(report)
    return report
