"""The hourly and daily chains, backfills, and their command line. Steps are repeated by a policy of their own."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import SparkSession

from ..config import Config, get_config
from ..operators import gold, quality, silver
from ..session import build
from ..sources import bronze
from ..sources.store import Store
from .operations import PruneResult, notify_failure, prune, record

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Policy:
    """Further tries of a failed step, the wait before the first of them, and whether waits double, up to the longest."""

    retries: int = 0
    wait_seconds: float = 60.0
    doubling: bool = True
    longest_seconds: float = 1800.0

    def waits(self) -> list[float]:
        return [min(self.longest_seconds, self.wait_seconds * (2**i if self.doubling else 1)) for i in range(self.retries)]


#: By step. A failed gate says the same again, so it has no second try.
POLICIES = {
    "ingest": Policy(6, 120.0),
    "transform": Policy(3),
    "quality_gate": Policy(0),
    "backfill": Policy(3),
    "build_gold": Policy(2, 120.0, doubling=False),
    "prune_retention": Policy(2, 120.0, doubling=False),
}
#: For schedulers that repeat failed steps themselves.
ONCE: dict[str, Policy] = {}
#: Hours of a backfill that are landed at a time.
HOURS_AT_ONCE = 2


def guarded[T](cfg: Config, step: str, of: object, work: Callable[[], T], policies: Mapping[str, Policy] = ONCE, sleep: Callable[[float], None] = time.sleep) -> T:
    """Runs a step, again by its policy; the last failure is alerted and raised."""
    waits = policies.get(step, Policy()).waits()
    while True:
        try:
            return work()
        except Exception as error:
            if not waits:
                notify_failure(cfg, f"{step} {of}".rstrip(), error)
                raise
            log.warning("%s %s failed (%s: %s); again in %.0f s", step, of, type(error).__name__, error, waits[0])
            sleep(waits.pop(0))


def ingest(spark: SparkSession, cfg: Config, hour: datetime, force: bool = False, policies: Mapping[str, Policy] = ONCE) -> bronze.IngestResult:
    out = guarded(cfg, "ingest", hour, lambda: bronze.ingest_hour(spark, cfg, hour, force), policies)
    record(spark, cfg, "ingest", hour, bytes_downloaded=out.bytes_downloaded, duration_seconds=out.duration_seconds, skipped=out.skipped)
    return out


def transform(spark: SparkSession, cfg: Config, hour: datetime, policies: Mapping[str, Policy] = ONCE) -> silver.TransformResult:
    out = guarded(cfg, "transform", hour, lambda: silver.transform_hour(spark, cfg, hour), policies)
    record(spark, cfg, "transform", hour, rows_in=out.rows_in, rows_out=out.rows_out, bytes_out=out.bytes_out, duration_seconds=out.duration_seconds)
    return out


def gate(spark: SparkSession, cfg: Config, hour: datetime, policies: Mapping[str, Policy] = ONCE) -> quality.QualityReport:
    """A failed gate leaves no record; the transform has withdrawn that of an earlier pass, and so does this, for silver that others wrote."""
    Store(spark).delete(cfg.metric_file("quality_gate", hour))
    out = guarded(cfg, "quality_gate", hour, lambda: quality.check_hour(spark, cfg, hour), policies)
    record(spark, cfg, "quality_gate", hour, rows=out.rows, soft_warnings=len(out.soft_warnings))
    return out


def run_hour(spark: SparkSession, cfg: Config, hour: datetime, force: bool = False, policies: Mapping[str, Policy] = ONCE) -> quality.QualityReport:
    ingest(spark, cfg, hour, force, policies)
    transform(spark, cfg, hour, policies)
    return gate(spark, cfg, hour, policies)


def hours_between(first: datetime, last: datetime) -> list[datetime]:
    """Whole hours from the first to the last, both included."""
    return [first + timedelta(hours=i) for i in range(int((last - first).total_seconds() // 3600) + 1)]


def _failed(hour: datetime, step: str, error: Exception) -> quality.QualityReport:
    return quality.QualityReport(hour, 0, (f"{step}: {type(error).__name__}: {error}",))


def backfill(spark: SparkSession, cfg: Config, first: datetime, last: datetime, policies: Mapping[str, Policy] = ONCE) -> dict[datetime, quality.QualityReport]:
    """A report for each hour, in order. Hours stand apart: one that can't be landed, read or passed is alerted and told, and the rest go on.

    HOURS_AT_ONCE hours are landed at a time. Those landed are transformed in one Spark job; if that fails, one by one.
    """
    hours, began, out = hours_between(first, last), time.monotonic(), {}

    def land(hour: datetime) -> Exception | None:
        try:
            ingest(spark, cfg, hour, policies=policies)
        except Exception as error:
            return error

    with ThreadPoolExecutor(HOURS_AT_ONCE) as pool:
        landed = dict(zip(hours, pool.map(land, hours), strict=True))
    out |= {hour: _failed(hour, "ingest", error) for hour, error in landed.items() if error}
    todo, rows = [hour for hour in hours if not landed[hour]], 0
    if todo:
        try:
            rows = silver.transform_hours(spark, cfg, todo)
        except Exception as error:
            log.warning("the hours are transformed one by one, as all at once failed: %s", error)
            for hour in todo:
                try:
                    rows += transform(spark, cfg, hour, policies).rows_out
                except Exception as error:
                    out[hour] = _failed(hour, "transform", error)
    record(spark, cfg, "backfill", first, rows_out=rows, duration_seconds=time.monotonic() - began)
    for hour in todo:
        if hour not in out:
            try:
                out[hour] = gate(spark, cfg, hour, policies)
            except quality.QualityGateError as error:
                out[hour] = error.report
    return {hour: out[hour] for hour in hours}


def run_daily(spark: SparkSession, cfg: Config, today: date | None = None, only_gated: bool = False, policies: Mapping[str, Policy] = ONCE) -> tuple[gold.GoldBuildResult, PruneResult]:
    now = datetime.combine(today, datetime.min.time()) if today else datetime.now(UTC).replace(tzinfo=None)
    built = guarded(cfg, "build_gold", "", lambda: gold.build_gold(spark, cfg, only_gated), policies)
    record(spark, cfg, "build_gold", now, duration_seconds=built.duration_seconds, **{f"rows_{m}": n for m, n in built.rows_per_mart.items()})
    pruned = guarded(cfg, "prune_retention", "", lambda: prune(spark, cfg, today), policies)
    record(spark, cfg, "prune_retention", now, partitions_removed=len(pruned.removed))
    return built, pruned


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="eventlake")
    parser.add_argument("--once", action="store_true", help="no step is repeated: the scheduler does that")
    steps = parser.add_subparsers(dest="step", required=True)
    at = lambda text: datetime.strptime(text, "%Y-%m-%dT%H")
    for name in ("ingest", "transform", "gate", "hour"):
        steps.add_parser(name).add_argument("hour", type=at)
    several = steps.add_parser("backfill")
    several.add_argument("first", type=at)
    several.add_argument("last", type=at)
    steps.add_parser("daily").add_argument("--only-gated", action="store_true")
    args, cfg = parser.parse_args(arguments), get_config()
    spark, policies = build(cfg), ONCE if args.once else POLICIES
    try:
        if args.step == "backfill":
            return int(not all(r.passed for r in backfill(spark, cfg, args.first, args.last, policies).values()))
        if args.step == "daily":
            run_daily(spark, cfg, only_gated=args.only_gated, policies=policies)
        else:
            {"ingest": ingest, "transform": transform, "gate": gate, "hour": run_hour}[args.step](spark, cfg, args.hour, policies=policies)
    except bronze.HourNotPublishedError:
        return 75  # try again later
    except Exception:
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
