"""Around the engine: metric records, retention, alerts."""

from __future__ import annotations

import json
import logging
import urllib.request
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import SparkSession

from ..config import Config
from ..sources.store import Store

log = logging.getLogger(__name__)


def record(spark: SparkSession, cfg: Config, kind: str, hour: datetime, **values) -> str:
    """One JSON object for a kind and hour; a later run replaces it."""
    path = cfg.metric_file(kind, hour)
    entry = {"kind": kind, "hour": hour.strftime("%Y-%m-%dT%H:%M:%S"), "recorded_at": datetime.now(UTC).isoformat(), **values}
    Store(spark).write(path, json.dumps(entry).encode() + b"\n")
    return path


@dataclass(frozen=True)
class PruneResult:
    removed: tuple[str, ...]


def prune(spark: SparkSession, cfg: Config, today: date | None = None) -> PruneResult:
    """Deletes days older than each layer keeps: those before today less its days. Folders with other names stay, and are told."""
    store, today, removed = Store(spark), today or datetime.now(UTC).date(), []
    for root, days in ((cfg.bronze, cfg.bronze_retention_days), (cfg.silver, cfg.silver_retention_days)):
        oldest = today - timedelta(days=days)
        for entry in store.list(root):
            try:
                if not entry.is_dir or not entry.name.startswith("date="):
                    raise ValueError(entry.name)
                day = date.fromisoformat(entry.name[5:])
            except ValueError:
                log.warning("%s is no day's folder and stays", entry.path)
                continue
            if day < oldest:
                store.delete(entry.path)
                removed.append(entry.path)
    return PruneResult(tuple(removed))


def notify_failure(cfg: Config, step: str, error: BaseException) -> bool:
    """Posts a failure to the webhook, or logs it where none is set. Never raises."""
    text = f"{step} failed: {type(error).__name__}: {error}"
    if not cfg.alert_webhook_url:
        log.error(text)
        return False
    try:
        request = urllib.request.Request(cfg.alert_webhook_url, json.dumps({"text": text}).encode(), {"Content-Type": "application/json"})  # noqa: S310
        with urllib.request.urlopen(request, timeout=10):  # noqa: S310
            return True
    except Exception:
        log.exception("the alert itself failed; it was: %s", text)
        return False
