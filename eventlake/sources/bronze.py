"""Bronze: one hour's gzipped JSON lines, downloaded, verified and put in place whole."""

from __future__ import annotations

import gzip
import logging
import os
import random
import tempfile
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import SparkSession

from ..config import Config
from .store import Store

log = logging.getLogger(__name__)


class HourNotPublishedError(Exception):
    """The source answers 404: there is no such hour yet."""


class TransientDownloadError(Exception):
    """Worth another attempt."""


class CorruptDownloadError(TransientDownloadError):
    """What came is not a whole gzip file."""


@dataclass(frozen=True)
class IngestResult:
    path: str
    bytes_downloaded: int
    skipped: bool
    duration_seconds: float


def with_retries[T](work: Callable[[], T], attempts: int, first_wait: float, sleep: Callable[[float], None] = time.sleep) -> T:
    """Repeats transient failures, waiting twice as long each time, with jitter; the last failure is raised."""
    for turn in range(1, attempts + 1):
        try:
            return work()
        except TransientDownloadError as error:
            if turn == attempts:
                raise
            wait = first_wait * 2 ** (turn - 1) * random.uniform(0.75, 1.25)  # noqa: S311
            log.warning("attempt %d of %d failed (%s); next in %.1f s", turn, attempts, error, wait)
            sleep(wait)
    raise ValueError("no attempts")


def verify_gzip(path: str) -> None:
    """Reads the stream to its end."""
    try:
        with gzip.open(path) as stream:
            while stream.read(1 << 20):
                pass
    except (OSError, EOFError, zlib.error) as error:
        raise CorruptDownloadError(str(error)) from error
    if os.path.getsize(path) == 0:
        raise CorruptDownloadError("empty file")


def download(url: str, target: str, cfg: Config) -> int:
    """One attempt; the number of bytes. Server errors and broken connections are transient, other refusals aren't."""
    done = 0
    try:
        with urllib.request.urlopen(url, timeout=cfg.http_timeout_seconds) as answer, open(target, "wb") as out:  # noqa: S310
            told = answer.headers.get("Content-Length")
            while chunk := answer.read(cfg.http_chunk_bytes):
                out.write(chunk)
                done += len(chunk)
            if told is not None and done < int(told):
                raise TransientDownloadError(f"{done} of {told} bytes came")
    except urllib.error.HTTPError as error:
        if error.code == 404:
            raise HourNotPublishedError(url) from error
        if error.code >= 500:
            raise TransientDownloadError(f"{error.code} from {url}") from error
        raise
    except (OSError, EOFError) as error:
        raise TransientDownloadError(f"{url}: {error}") from error
    verify_gzip(target)
    return done


def ingest_hour(spark: SparkSession, cfg: Config, hour: datetime, force: bool = False, sleep: Callable[[float], None] = time.sleep) -> IngestResult:
    """Lands an hour; one that is there already is left alone, unless forced. No half file is ever seen."""
    began, store, path = time.monotonic(), Store(spark), cfg.bronze_file(hour)
    if not force and store.exists(path):
        return IngestResult(path, 0, True, time.monotonic() - began)
    with tempfile.TemporaryDirectory() as folder:
        local = os.path.join(folder, "events.json.gz")
        size = with_retries(lambda: download(cfg.url(hour), local, cfg), cfg.http_max_attempts, cfg.http_initial_wait_seconds, sleep)
        store.upload(local, path)
    return IngestResult(path, size, False, time.monotonic() - began)
