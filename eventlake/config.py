"""Settings: defaults, environment overrides, and the places that follow from them."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from datetime import datetime


@dataclass(frozen=True)
class Config:
    data_root: str = "data"
    bronze_retention_days: int = 3
    #: Has to exceed the seven days that trending looks back.
    silver_retention_days: int = 10
    #: The hour in a source's URL has no leading zero.
    url_template: str = "https://data.example.org/{date}-{hour}.json.gz"
    http_timeout_seconds: int = 60
    http_max_attempts: int = 4
    http_initial_wait_seconds: float = 1.0
    http_chunk_bytes: int = 1 << 20
    quality_min_rows: int = 50_000
    quality_ts_tolerance_minutes: int = 60
    trending_min_daily_events: int = 20
    #: 0 scores repositories without a past.
    trending_min_baseline: float = 2.0
    alert_webhook_url: str = ""
    #: Bytes of a shuffle partition that the session aims at; executors hold a few of these at once.
    shuffle_partition_bytes: int = 128 << 20

    @property
    def bronze(self) -> str:
        return f"{self.data_root.rstrip('/')}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.data_root.rstrip('/')}/silver"

    @property
    def gold(self) -> str:
        return f"{self.data_root.rstrip('/')}/gold"

    @property
    def metrics(self) -> str:
        return f"{self.data_root.rstrip('/')}/metrics"

    def url(self, hour: datetime) -> str:
        return self.url_template.format(date=hour.strftime("%Y-%m-%d"), hour=hour.hour)

    def bronze_file(self, hour: datetime) -> str:
        return f"{self.bronze}/{partition(hour)}/events.json.gz"

    def silver_hour(self, hour: datetime) -> str:
        return f"{self.silver}/{partition(hour)}"

    def metric_file(self, kind: str, hour: datetime) -> str:
        return f"{self.metrics}/{hour:date=%Y-%m-%d}/{kind}_hour={hour:%H}.json"


#: Environment variable by setting.
ENVIRONMENT = {
    "data_root": "DATA_ROOT",
    "bronze_retention_days": "BRONZE_RETENTION_DAYS",
    "silver_retention_days": "SILVER_RETENTION_DAYS",
    "quality_min_rows": "QUALITY_MIN_ROWS",
    "alert_webhook_url": "ALERT_WEBHOOK_URL",
    "url_template": "SOURCE_URL_TEMPLATE",
}


def partition(hour: datetime) -> str:
    """date=YYYY-MM-DD/hour=HH, with leading zeros."""
    return hour.strftime("date=%Y-%m-%d/hour=%H")


def get_config(environment: Mapping[str, str] = os.environ, **settings) -> Config:
    """Defaults, then the environment, then what is given."""
    base = Config()
    kinds = {f.name: type(getattr(base, f.name)) for f in fields(Config)}
    found = {name: kinds[name](environment[key]) for name, key in ENVIRONMENT.items() if environment.get(key)}
    return replace(base, **found | settings)
