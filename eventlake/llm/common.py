"""Helpers that every operator of this subpackage shares."""

from __future__ import annotations

import ctypes
import gc
import sys
import time
import types
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import shared_folder

#: Held-out folds are taken by this remainder rule, so that every run and every engine agrees.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read by Spark alone, so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_column: str = "doc_id") -> Column:
    """crc32(id as text) mod 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS


#: Lists that take the tables that written() makes meanwhile.
_TAKING: list[list[DataFrame]] = []


@contextmanager
def tables_made() -> Iterator[list[DataFrame]]:
    """The tables that written() makes inside the with block: a result that is written out no longer needs those it read."""
    made: list[DataFrame] = []
    _TAKING.append(made)
    try:
        yield made
    finally:
        _TAKING.remove(made)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and outlives any executor.

    The folder has a new name each time. Whoever writes the result out may remove it (tables_made); else clearing the checkpoint folder is
    the cluster's own business, since the caller may read the returned DataFrame at any later time.
    """
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    for made in _TAKING:
        made.append(out)
    return out


def remove(df: DataFrame) -> None:
    """Deletes the files of a table made by written(), once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def most_frequent(df: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows with the largest counts, at most `limit`: those over a threshold, which a histogram of a few hundred steps gives.

    A sort with a limit would send that many rows of each partition to the driver.
    """
    step = F.floor(F.log2(F.col(count)) * 16).cast("int")
    steps = sorted(((r["s"], r["n"]) for r in df.where(F.col(count) > 0).groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    least, taken = None, 0
    for s, n in steps:
        taken += n
        if taken > limit:
            break
        least = s
    return df.where((F.col(count) > 0) & (step >= least)) if least is not None else df.limit(0)


#: Bytes that a Python worker gets at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker gets at once by bytes: of long texts, the default of 64 MB is several times that in either process.

    Results are lazy, so the setting has to last; a session that already has a smaller bound keeps its own.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark.conf.get(key).removesuffix("b")
    if not found.isdigit() or not 0 < int(found) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Scratch:
    """Tables of one computation: called as written(), and cleared once its result no longer reads them."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(written(df, name))
        return self.tables[-1]

    def clear(self) -> None:
        for df in self.tables:
            remove(df)
        self.tables.clear()


def per_process(key: Hashable, make: Callable[[], Any]) -> Any:
    """What make() gives, made once in a Python worker and kept for its later tasks, until they ask for something else.

    Functions come to a worker by value, so their own globals are new in each task; this is kept in a module instead. One
    thing is kept at a time: workers outlive queries, and what several operators keep would add up.
    """
    state = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if not hasattr(state, "key") or state.key != key:
        state.key = state.value = None
        trim()
        state.value = make()
        state.key = key
    return state.value


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished jobs that nothing refers to any more.

    Events of a job that listeners have yet to see refer to its plan, so it is looked for again a little later.
    """
    for wait in (0.5, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


def trim() -> None:
    """Gives memory that a worker has freed back to the system, where its C library can: the executor beside it needs it."""
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def forget() -> None:
    """Drops what per_process() keeps: for functions that need the memory and not the thing."""
    per_process(None, lambda: None)
    trim()
