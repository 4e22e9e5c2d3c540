import http.server
import json
import os
import threading
from dataclasses import replace
from datetime import date, datetime

import pytest
from lake import HOUR, bronze, event

from eventlake.config import Config, get_config, partition
from eventlake.operators import silver
from eventlake.operators.quality import QualityGateError
from eventlake.plans import operations, runner
from eventlake.sources import tables
from eventlake.sources.store import Store, shared_folder


def test_config():
    cfg = get_config({"DATA_ROOT": "/x/", "QUALITY_MIN_ROWS": "7"}, trending_min_baseline=0.0)
    assert (cfg.bronze, cfg.quality_min_rows, cfg.trending_min_baseline, cfg.silver_retention_days) == ("/x/bronze", 7, 0.0, 10)
    assert partition(datetime(2024, 3, 5, 7)) == "date=2024-03-05/hour=07"
    assert Config(url_template="{date}-{hour}").url(datetime(2024, 3, 5, 7)) == "2024-03-05-7"
    assert Config().silver_retention_days > 7


def test_retention(spark, cfg):
    for layer in (cfg.bronze, cfg.silver):
        for day in range(1, 11):
            os.makedirs(f"{layer}/date=2024-07-{day:02d}")
        os.makedirs(f"{layer}/odd")
    out = operations.prune(spark, cfg, date(2024, 7, 10))
    assert sorted(os.listdir(cfg.bronze)) == [*(f"date=2024-07-{d:02d}" for d in range(7, 11)), "odd"]
    assert (len(os.listdir(cfg.silver)), len(out.removed)) == (11, 6)


def test_retention_without_layers(spark, cfg):
    assert operations.prune(spark, cfg).removed == ()


def test_alert_is_posted(cfg):
    got = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            got.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(200)
            self.end_headers()

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    assert operations.notify_failure(replace(cfg, alert_webhook_url=f"http://127.0.0.1:{server.server_port}"), "step", ValueError("why"))
    assert got == [{"text": "step failed: ValueError: why"}]
    server.shutdown()


def test_alert_never_raises(cfg, caplog):
    assert not operations.notify_failure(cfg, "step", ValueError("why"))
    assert "why" in caplog.text
    assert not operations.notify_failure(replace(cfg, alert_webhook_url="http://127.0.0.1:1"), "step", ValueError("why"))
    assert not operations.notify_failure(replace(cfg, alert_webhook_url="no url"), "step", ValueError("why"))


def kinds(spark, cfg):
    return sorted(r.kind for r in tables.metrics(spark, cfg).collect())


def test_chains(spark, cfg):
    bronze(cfg, [event(str(i)) for i in range(4)])
    assert runner.run_hour(spark, cfg, HOUR).passed
    assert kinds(spark, cfg) == ["ingest", "quality_gate", "transform"]
    built, pruned = runner.run_daily(spark, cfg, HOUR.date())
    assert built.rows_per_mart["event_type_daily"] == 1
    assert pruned.removed == ()
    assert len(kinds(spark, cfg)) == 5


def test_failed_gate_leaves_no_record(spark, cfg):
    bronze(cfg, [event("1")])
    with pytest.raises(QualityGateError):
        runner.run_hour(spark, cfg, HOUR)
    assert kinds(spark, cfg) == ["ingest", "transform"]


def test_a_pass_does_not_outlive_its_rows(spark, cfg):
    """An hour that passed, is written anew and then fails is not among those that passed."""
    bronze(cfg, [event(str(i)) for i in range(4)])
    assert runner.run_hour(spark, cfg, HOUR).passed
    assert tables.only_gated(tables.silver(spark, cfg), tables.metrics(spark, cfg)).count() == 4
    bronze(cfg, [event("1")])
    with pytest.raises(QualityGateError):
        runner.run_hour(spark, cfg, HOUR)
    assert kinds(spark, cfg) == ["ingest", "transform"]
    assert tables.only_gated(tables.silver(spark, cfg), tables.metrics(spark, cfg)).count() == 0


def test_a_pass_goes_with_any_rewrite(spark, cfg):
    """Before the gate has judged the new rows, the old verdict is gone: in the batch of many hours too."""
    bronze(cfg, [event(str(i)) for i in range(4)])
    for rewrite in (lambda: silver.transform_hour(spark, cfg, HOUR), lambda: silver.transform_hours(spark, cfg, [HOUR])):
        runner.run_hour(spark, cfg, HOUR)
        assert "quality_gate" in kinds(spark, cfg)
        rewrite()
        assert "quality_gate" not in kinds(spark, cfg)


def test_backfill(spark, cfg):
    second = HOUR.replace(hour=16)
    bronze(cfg, [event(str(i)) for i in range(4)])
    bronze(cfg, [event("1")], second)
    out = runner.backfill(spark, cfg, HOUR, second)
    assert {h: r.passed for h, r in out.items()} == {HOUR: True, second: False}


def test_backfill_goes_on_without_the_hours_that_fail(spark, cfg):
    """One hour isn't published, one can't be read, one fails the gate: the others are there, and each is told."""
    cfg = replace(cfg, url_template="http://127.0.0.1:1/{date}-{hour}", http_max_attempts=1)
    hours = [HOUR.replace(hour=h) for h in range(10, 15)]
    for h in (hours[0], hours[4]):
        bronze(cfg, [event(str(i)) for i in range(4)], h)
    bronze(cfg, [event("1"), "[broken"], hours[2])
    bronze(cfg, [event("1")], hours[3])
    out = runner.backfill(spark, cfg, hours[0], hours[4])
    assert list(out) == hours
    assert [r.passed for r in out.values()] == [True, False, False, False, True]
    assert [out[h].hard_failures[0].split(":")[0] for h in (hours[1], hours[2])] == ["ingest", "transform"]
    assert {r.hour for r in tables.silver(spark, cfg).select("hour").distinct().collect()} == {"10", "13", "14"}


def test_steps_are_repeated_by_their_policy(cfg):
    def run(step, failures):
        left, slept = [failures], []

        def work():
            left[0] -= 1
            if left[0] >= 0:
                raise OSError("down")
            return "done"

        try:
            return runner.guarded(cfg, step, "", work, runner.POLICIES, slept.append), slept
        except OSError:
            return None, slept

    assert run("ingest", 6) == ("done", [120.0, 240.0, 480.0, 960.0, 1800.0, 1800.0])
    assert run("ingest", 7)[0] is None
    assert run("transform", 3) == ("done", [60.0, 120.0, 240.0])
    assert run("quality_gate", 1) == (None, [])
    assert run("build_gold", 2) == ("done", [120.0, 120.0])
    assert runner.Policy().waits() == []


def test_publish_that_was_cut_off(spark, cfg, tmp_path):
    """Between the two renames of a folder, readers find the old one, and the next run puts it back or clears it."""
    store, target = Store(spark), f"{tmp_path}/gold/mart"
    one, two = (spark.range(n).coalesce(1) for n in (1, 2))
    one.write.parquet(target)
    old = f"{tmp_path}/gold/.mart-old-0"
    os.rename(target, old)  # here it was cut off
    assert store.settled(target).endswith(".mart-old-0")
    assert spark.read.parquet(store.settled(target)).count() == 1
    store.recover(target)
    assert store.settled(target) == target
    assert not os.path.exists(old)
    os.makedirs(old)  # cut off before the old one went
    staged = store.staging(target)
    two.write.parquet(staged)
    store.publish(staged, target)
    assert spark.read.parquet(target).count() == 2
    assert os.listdir(f"{tmp_path}/gold") == ["mart"]
    assert store.settled(f"{tmp_path}/gold/other") is None


def test_a_file_is_replaced_in_one_step(spark, tmp_path):
    store, path = Store(spark), f"{tmp_path}/x/record.json"
    for data in (b"one", b"two"):
        store.write(path, data)
        assert open(path, "rb").read() == data
    assert [x for x in os.listdir(f"{tmp_path}/x") if not x.endswith(".crc")] == ["record.json"]


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.conf.get = staticmethod(lambda key, default=None: "hdfs://x/y/")
    assert shared_folder(Session()) == "hdfs://x/y"
    assert os.path.isdir(shared_folder(spark).removeprefix("file:"))
