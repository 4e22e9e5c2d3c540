import gzip
import http.server
import os
import threading
from dataclasses import replace

import pytest
from lake import HOUR, hidden

from eventlake.sources import bronze

BODY = gzip.compress(b'{"id":"1"}\n' * 200)


@pytest.fixture
def source(cfg):
    """answers: what the server says, one after another (the last again and again); asked: the paths."""
    answers, asked = [], []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            answer = answers.pop(0) if len(answers) > 1 else answers[0]
            if answer == "reset":
                self.connection.close()
                return
            code, body, told = answer if isinstance(answer, tuple) else (answer, b"", None)
            self.send_response(code)
            self.send_header("Content-Length", str(told or len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield replace(cfg, url_template=f"http://127.0.0.1:{server.server_port}/{{date}}-{{hour}}.json.gz"), answers, asked
    server.shutdown()


def test_success_skip_force(spark, source):
    cfg, answers, asked = source
    answers.append((200, BODY, None))
    out = bronze.ingest_hour(spark, cfg, HOUR.replace(hour=5))
    assert (out.skipped, out.bytes_downloaded, asked) == (False, len(BODY), ["/2024-03-05-5.json.gz"])
    assert open(cfg.bronze_file(HOUR.replace(hour=5)), "rb").read() == BODY
    assert bronze.ingest_hour(spark, cfg, HOUR.replace(hour=5)).skipped
    assert len(asked) == 1
    assert not bronze.ingest_hour(spark, cfg, HOUR.replace(hour=5), force=True).skipped
    assert len(asked) == 2
    assert not hidden(cfg.bronze)


@pytest.mark.parametrize(
    ("said", "error", "times"),
    [
        ([404], bronze.HourNotPublishedError, 1),
        ([403], Exception, 1),
        ([500], bronze.TransientDownloadError, 4),
        (["reset"], bronze.TransientDownloadError, 4),
        ([(200, BODY[:-9], None)], bronze.CorruptDownloadError, 4),
        ([(200, b"", None)], bronze.CorruptDownloadError, 4),
        ([(200, BODY[:-9], len(BODY))], bronze.TransientDownloadError, 4),
        ([(200, b"not gzip", None)], bronze.CorruptDownloadError, 4),
    ],
)
def test_failures(spark, source, said, error, times):
    cfg, answers, asked = source
    answers += said
    with pytest.raises(error):
        bronze.ingest_hour(spark, cfg, HOUR, sleep=lambda _: None)
    assert len(asked) == times
    assert not os.path.exists(cfg.bronze_file(HOUR))
    assert not os.path.isdir(cfg.bronze) or not hidden(cfg.bronze)


def test_recovers(spark, source):
    cfg, answers, asked = source
    answers += [500, "reset", (200, BODY, None)]
    waits = []
    bronze.ingest_hour(spark, replace(cfg, http_initial_wait_seconds=1.0), HOUR, sleep=waits.append)
    assert len(asked) == 3
    assert 0.7 < waits[0] < 1.3 < 1.4 < waits[1] < 2.6
