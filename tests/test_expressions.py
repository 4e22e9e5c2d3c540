from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventlake.functions import expressions as x


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'timestamp_ntz'}" for k, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize(("text", "number"), [("3.7", 4), ("2.5", 3), ("-2.5", -3), ("1e3", 1000), (" 42 ", 42), ("0x10", None), ("1_000", None), ("", None), ("x", None), (None, None), ("9" * 30, None), ("9007199254740993", 9007199254740993)])
def test_lenient_long(spark, text, number):
    assert one(spark, x.lenient_long(F.col("t")), t=text) == number


def test_lenient_int_is_null_beyond_its_range(spark):
    assert one(spark, x.lenient_int(F.col("t")), t=str(2**31)) is None


@pytest.mark.parametrize(("a", "b", "n"), [("00:00:59", "00:01:00", 1), ("00:00:00", "00:00:59", 0), ("00:00:30", "02:00:29", 120), ("01:00:00", "00:59:59", -1)])
def test_minutes_between_counts_boundaries(spark, a, b, n):
    at = lambda t: datetime.fromisoformat(f"2024-01-01T{t}")
    assert one(spark, x.minutes_between(F.col("a"), F.col("b")), a=at(a), b=at(b)) == n


def test_is_bot_takes_brackets_literally_and_minds_case(spark):
    got = [one(spark, x.is_bot(F.col("t")), t=t) for t in ("ci[bot]", "cib", "CI[BOT]", None)]
    assert got == [True, False, False, None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(x.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]
