"""Builders of small lakes."""

import gzip
import json
import os
from datetime import datetime

from eventlake import schemas
from eventlake.config import Config

HOUR = datetime(2024, 3, 5, 15)


def event(id_, type_="PushEvent", at="2024-03-05T15:10:00Z", **changes):
    out = {"id": id_, "type": type_, "created_at": at, "public": True, "actor": {"id": 1, "login": "ada"}, "repo": {"id": 42, "name": "a/b"}, "payload": {"size": 3}}
    return {k: v for k, v in (out | changes).items() if v is not ...}


def bronze(cfg: Config, lines, hour=HOUR):
    path = cfg.bronze_file(hour)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)
    return path


def row(id_, at=HOUR, **changes):
    out = dict.fromkeys(schemas.SILVER) | {"id": id_, "type": "PushEvent", "created_at": at, "public": True, "actor_login": "ada", "repo_id": 42, "repo_name": "a/b", "push_commits": 1}
    assert not set(changes) - set(out)
    return out | changes


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in schemas.SILVER) for r in rows], schemas.SILVER_DDL)


def silver(spark, cfg: Config, rows, hour=HOUR):
    frame(spark, rows).coalesce(1).write.mode("overwrite").parquet(cfg.silver_hour(hour))


def hidden(folder):
    return [os.path.join(d, x) for d, dirs, names in os.walk(folder) for x in [*dirs, *names] if x.startswith((".", "_")) and not x.endswith(".crc") and x != "_SUCCESS"]
