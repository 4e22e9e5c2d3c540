"""The driver's contract, on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from eventlake import queries as lake

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plain(rows, names):
    at = [names.index(n) for n in sorted(names)]
    return sorted(repr([row[i] for i in at]) for row in rows)


@pytest.mark.parametrize("name", lake.queries())
def test_same_as_sql(spark, duck, name):
    df = lake.queries()[name](spark, SF)
    found = duck.execute(lake.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(df.collect(), df.columns) == plain(found.fetchall(), names)


def test_every_lake_query_has_sql():
    assert set(lake.queries()) == set(lake.oracle_sql())


def test_imports_without_the_training_data_part(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for name in os.listdir(root):
        if name not in ("eventlake", "corpus_pipeline.py", ".git", "tests"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "eventlake")
    for name in os.listdir(f"{root}/eventlake"):
        if name != "llm":
            os.symlink(f"{root}/eventlake/{name}", tmp_path / "eventlake" / name)
    code = "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 10; assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
