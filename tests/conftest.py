import os
import sys
import time

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["TZ"] = "UTC"
time.tzset()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventlake.config import Config
    from eventlake.session import build

    session = build(
        Config(),
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path):
    from eventlake.config import Config

    return Config(data_root=str(tmp_path / "lake"), quality_min_rows=3, http_initial_wait_seconds=0.0)
